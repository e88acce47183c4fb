"""TF-IDF features with chi-square / mutual-information selection.

Data layout (never densified):

* ``doc_terms``: one row per document, ``terms: array<struct<term, tf>>``,
  counted inside the row (no shuffle).
* vocabulary statistics: ``explode`` + ``groupBy(term)`` with map-side
  partial aggregation (shuffle volume ~ distinct terms per partition).
* model table (``term, term_idx, df, ctf, idf, score, selected, sel_idx``):
  bounded by ``max_features`` and written to the shared checkpoint folder,
  which cuts lineage before transform.
* features: long ``(id, sel_idx, term, value)``, weighed inside the row while
  the vocabulary is within checked bounds, else by a join with it.

Semantics follow the reference's vectoriser and selector: smooth idf
``ln((1+n)/(1+df)) + 1``, raw counts times idf, L2 norm over the whole kept
vocabulary, chi-square on summed values per class, selection of the ``k`` best
with ties at the cut going to the later (alphabetically larger) term, no
re-normalisation after selection.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from .joins import bounded_broadcast, global_index, join_null_safe

@dataclass(frozen=True)
class FeatureConfig:
    max_features: int | None = 1000
    ngram_range: tuple[int, int] = (1, 2)
    min_df: int | float = 1
    max_df: int | float = 0.95
    stop_words: tuple[str, ...] | None = K.CLEANING_STOPWORDS
    lowercase: bool = True
    strip_accents: bool = True
    use_chi2: bool = True
    chi2_k: int = 50
    use_mutual_info: bool = False
    mutual_info_k: int = 50

    def to_json(self) -> str:
        d = asdict(self)
        return json.dumps(d, sort_keys=True)

    @classmethod
    def from_json(cls, s: str) -> "FeatureConfig":
        """The settings that :meth:`to_json` stored, stop words included."""
        d = json.loads(s)
        d["ngram_range"] = tuple(d["ngram_range"])
        d["stop_words"] = None if d["stop_words"] is None else tuple(d["stop_words"])
        return cls(**d)

    @property
    def method(self) -> str | None:
        if self.use_chi2:
            return "chi2"
        if self.use_mutual_info:
            return "mutual_info"
        return None

    @property
    def k(self) -> int | None:
        m = self.method
        return None if m is None else (self.chi2_k if m == "chi2" else self.mutual_info_k)


# Two presets: the live default and the training default.
LIVE_CONFIG = FeatureConfig()
TRAINING_CONFIG = FeatureConfig(max_features=5000, min_df=2, chi2_k=1000, mutual_info_k=1000)


# ---------------------------------------------------------------------------
# Row-local steps
# ---------------------------------------------------------------------------

def grams(df: DataFrame, text_col: str, cfg: FeatureConfig, out: str = "grams") -> DataFrame:
    """Add ``out``: vectoriser tokens -> n-grams. Tokens are projected first so
    the n-gram expression reads a column, not a re-evaluated expression."""
    lo, hi = cfg.ngram_range
    if not (1 <= lo <= hi <= 2):
        raise ValueError("ngram_range supports (1,1), (1,2), (2,2)")
    d = df.withColumn("_tk", T.vectorizer_tokens(text_col, cfg.stop_words, cfg.lowercase, cfg.strip_accents))
    if (lo, hi) == (1, 1):
        g = F.col("_tk")
    elif (lo, hi) == (2, 2):
        g = T.bigrams("_tk")
    else:
        g = T.ngrams_1_2("_tk")
    return d.withColumn(out, g).drop("_tk")


def doc_terms(df: DataFrame, text_col: str, cfg: FeatureConfig, keep: list[str]) -> DataFrame:
    """``keep`` columns + ``terms: array<struct<term, tf>>`` (distinct terms of
    the row with their counts). Pure projections: no shuffle."""
    return gram_terms(grams(df.select(*keep, text_col), text_col, cfg).drop(text_col), keep)


def gram_terms(g: DataFrame, keep: list[str]) -> DataFrame:
    """:func:`doc_terms` of rows that have their :func:`grams`."""
    g = g.withColumn("_s", F.sort_array("grams")).drop("grams")  # native order, no comparator lambda
    g = g.withColumn("_st", T.run_starts("_s"))
    return g.select(*keep, T.term_counts("_s", "_st").alias("terms"))


def exploded_terms(dt: DataFrame, keep: list[str]) -> DataFrame:
    """One row per (document, term). ``inline_outer`` + a null filter instead
    of ``inline``: an inner generator makes the optimizer infer a
    ``size(terms) > 0`` filter and push it below the projections, which would
    re-evaluate the whole term expression inside its lambdas."""
    return dt.select(*keep, F.inline_outer("terms")).where(F.col("term").isNotNull())


# ---------------------------------------------------------------------------
# Vocabulary
# ---------------------------------------------------------------------------

def term_statistics(dt: DataFrame) -> DataFrame:
    """(term, df, ctf): document frequency and corpus count per term."""
    return (exploded_terms(dt, [])
              .groupBy("term")
              .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf")))


def df_bounds(cfg: FeatureConfig, n_docs: int) -> tuple[float, float]:
    lo = cfg.min_df if isinstance(cfg.min_df, int) else cfg.min_df * n_docs
    hi = cfg.max_df if isinstance(cfg.max_df, int) else cfg.max_df * n_docs
    if hi < lo:
        raise ValueError("max_df corresponds to < documents than min_df")
    return float(lo), float(hi)


def prune_vocabulary(stats: DataFrame, cfg: FeatureConfig, n_docs: int) -> DataFrame:
    lo, hi = df_bounds(cfg, n_docs)
    return stats.where((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))


def top_vocabulary(pruned: DataFrame, max_features: int | None) -> DataFrame:
    """Keep the ``max_features`` most frequent terms (corpus count; ties by
    term), then number them alphabetically from 0 (``term_idx``)."""
    if max_features is not None:
        kept = pruned.orderBy(F.desc("ctf"), F.asc("term")).limit(max_features)
        return kept.withColumn("term_idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    # Unbounded vocabulary: number terms without a single-task window.
    return global_index(pruned, [F.col("term")], "term_idx").withColumn("term_idx", F.col("term_idx").cast("int"))


def with_idf(vocab: DataFrame, n_docs: int) -> DataFrame:
    """Smooth idf: ln((1 + n) / (1 + df)) + 1."""
    return vocab.withColumn("idf", F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0)) + 1.0)


# ---------------------------------------------------------------------------
# Weights
# ---------------------------------------------------------------------------

def counted_grams(terms_col: str):
    """Counts back to n-grams: the vectoriser counts them by its own hash map."""
    return F.flatten(F.transform(terms_col, lambda t: F.array_repeat(t["term"], t["tf"].cast("int"))))


# A vocabulary up to both bounds is held by every worker for row-local lookups.
VOCABULARY_TERMS = 200_000
VOCABULARY_BYTES = 32 << 20


def held_vocabulary(vocab: DataFrame, bound: int | None) -> list | None:
    """Rows (term, idf) in ``term_idx`` order when the vocabulary is within both
    bounds; otherwise None, and nothing is collected."""
    if bound is None or bound > VOCABULARY_TERMS:
        return None
    if (vocab.agg(F.sum(F.octet_length("term"))).first()[0] or 0) > VOCABULARY_BYTES:
        return None
    return vocab.select("term_idx", "term", "idf").orderBy("term_idx").collect()


def weight_vectors(df: DataFrame, grams_col: str, rows: list, selected: list[int] | None = None,
                   out: str = "features") -> DataFrame:
    """``df`` + ``out``: the sparse TF-IDF vector of the n-grams, normalised
    over the whole vocabulary ``rows`` and then cut to the term indices
    ``selected``. Row-wise in the JVM: no shuffle."""
    counted = count_vectors(df, grams_col, [r["term"] for r in rows], "_tf")
    return weigh_counts(counted, "_tf", [r["idf"] for r in rows], selected, out).drop("_tf")


def count_vectors(df: DataFrame, grams_col: str, terms: list[str], out: str) -> DataFrame:
    """``df`` + ``out``: how often each of ``terms`` is among the n-grams, a sparse vector."""
    from pyspark.ml.feature import CountVectorizerModel
    return CountVectorizerModel.from_vocabulary(terms, inputCol=grams_col, outputCol=out).transform(df)


def weigh_counts(df: DataFrame, counts_col: str, idf: list[float], selected: list[int] | None = None,
                 out: str = "features") -> DataFrame:
    """``df`` + ``out``: the counts times ``idf``, normalised and then cut to the
    indices ``selected``. A term with idf 0 is no part of the vocabulary: it adds
    nothing to the norm, and its entry is 0."""
    from pyspark.ml.feature import ElementwiseProduct, Normalizer, VectorSlicer
    from pyspark.ml.linalg import Vectors
    steps = [ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=counts_col, outputCol="_w"),
             Normalizer(p=2.0, inputCol="_w", outputCol=out if selected is None else "_n")]
    if selected is not None:
        steps.append(VectorSlicer(indices=selected, inputCol="_n", outputCol=out))
    for step in steps:
        df = step.transform(df)
    return df.drop("_w", "_n")


def tfidf_weights(dt: DataFrame, vocab: DataFrame, id_col: str, keep: list[str], vocab_bound: int | None,
                  selection: DataFrame | None = None, zeros: bool = False, rows: list | None = None,
                  chosen: list[int] | None = None) -> DataFrame:
    """Long TF-IDF table ``keep + (term_idx, value)``, L2-normalised per
    document over the whole vocabulary; only the terms of ``selection``
    (term_idx, ...), a part of ``vocab``, have rows if it is given. ``zeros``: a
    document without any such term keeps one row, with nulls.

    Lookup, norm and selection happen inside the row while the vocabulary is
    held by every worker (:func:`held_vocabulary`), so documents are not
    shuffled; ``dt`` may then hold ``grams`` instead of ``terms`` (``rows``,
    ``chosen``: the held vocabulary and the selected term indices in order, if
    the caller has them). Beyond that the vocabulary is joined
    by term and a window by document sums the squares (sort-based, spills)."""
    rows = rows or held_vocabulary(vocab, vocab_bound)
    if rows is not None:
        if chosen is None and selection is not None:
            chosen = sorted(r[0] for r in selection.select("term_idx").collect())
        if chosen is not None and len(chosen) == len(rows):
            chosen = None
        grams_ = F.col("grams") if "grams" in dt.columns else counted_grams("terms")
        d = dt.select(*keep, F.coalesce(grams_, F.array().cast("array<string>")).alias("_g"))
        d = weight_vectors(d, "_g", rows, chosen, "_x").select(*keep, F.unwrap_udt("_x").alias("_x"))
        d = d.select(*keep, F.col("_x.indices").alias("_i"), F.col("_x.values").alias("value"))
        long = d.select(*keep, F.inline_outer(F.arrays_zip("_i", "value")))
        if not zeros:
            long = long.where(F.col("_i").isNotNull())
        if chosen is None:
            return long.withColumnRenamed("_i", "term_idx")
        at = F.broadcast(dt.sparkSession.createDataFrame(list(enumerate(chosen)), "_i int, term_idx int"))
        return long.join(at, "_i", "left").select(*keep, "term_idx", "value")
    v = bounded_broadcast(vocab.select("term", "term_idx", "idf"), vocab_bound)
    ex = exploded_terms(dt, keep).join(v, "term")
    ex = ex.withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    out = ex.select(*keep, "term_idx", (F.col("w") / norm).alias("value"))
    if selection is not None:
        out = out.join(selection.select("term_idx"), "term_idx").select(*keep, "term_idx", "value")
    if zeros:
        without = join_null_safe(dt.select(*keep), out.select(*keep).distinct(), keep, "left_anti")
        out = out.unionByName(without, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------

def chi2_scores(weights: DataFrame, label_col: str, classes: DataFrame, n_classes: int, n_docs: int) -> DataFrame:
    """(term_idx, score); ``classes``: (label, ``n_y``), documents of each class. observed = sum of values per class, expected = class
    share x term total. Classes where the term never occurs contribute their
    expected value, summed without a terms x classes grid."""
    priors = classes.select(label_col, (F.col("n_y") / F.lit(n_docs)).alias("p"))
    obs = (weights.groupBy("term_idx", label_col).agg(F.sum("value").alias("o"))
                  .join(bounded_broadcast(priors, n_classes), label_col))
    tot = Window.partitionBy("term_idx")
    obs = obs.withColumn("F", F.sum("o").over(tot))
    obs = obs.withColumn("e", F.col("p") * F.col("F"))
    return (obs.groupBy("term_idx")
               .agg((F.sum((F.col("o") - F.col("e")) ** 2 / F.col("e"))
                     + F.first("F") * (F.lit(1.0) - F.sum("p"))).alias("score")))


MI_CLASSES = 64  # classes counted side by side, one column each


def mutual_info_scores(weights: DataFrame, label_col: str, classes: DataFrame, n_classes: int, n_docs: int,
                       vocab: DataFrame) -> DataFrame:
    """(term_idx, score): mutual information (nats) between each term's value
    (as a discrete category; values rounded to 9 decimals) and the label,
    including the implied zero-value cell, clipped at 0.

    With ``h(n) = n ln n`` the score is ``(sum h(n_vy) - sum h(n_v) - sum h(n_y)
    + h(N)) / N`` over all cells, so every aggregate is a plain sum. One grouping
    by (term, value) holds a count per class, combined before its shuffle; what
    remains is one row per term and partition. Classes beyond
    :data:`MI_CLASSES` are counted in blocks, whose rows meet in a second
    grouping by (term, value)."""
    N = float(n_docs)

    def h(n):
        return F.when(n > 0, n * F.log(n.cast("double"))).otherwise(F.lit(0.0))

    width = min(n_classes, MI_CLASSES)
    at = global_index(classes, [F.col(label_col)], "_i").select(
        label_col, F.floor(F.col("_i") / MI_CLASSES).alias("_block"), (F.col("_i") % MI_CLASSES).alias("_slot"), "n_y")
    w = weights.select("term_idx", F.round("value", 9).alias("v"), label_col).join(
        bounded_broadcast(at.drop("n_y"), n_classes), label_col)
    slots = [F.count_if(F.col("_slot") == i).alias(f"_n{i}") for i in range(width)]
    many = n_classes > MI_CLASSES
    cells = w.groupBy("term_idx", "v", *(["_block"] if many else [])).agg(*slots)
    counts = [F.col(f"_n{i}") for i in range(width)]
    cells = cells.withColumn("_nv", sum(counts[1:], counts[0])).withColumn("_h", sum((h(c) for c in counts[1:]), h(counts[0])))
    if many:
        # per (term, class): non-zero documents, from a map-side count
        present = w.groupBy("term_idx", label_col).agg(F.count(F.lit(1)).alias("_nz"))
        cells = cells.groupBy("term_idx", "v").agg(F.sum("_nv").alias("_nv"), F.sum("_h").alias("_h"))
    else:
        totals = [F.sum(c).alias(f"_z{i}") for i, c in enumerate(counts)]
    per_term = cells.groupBy("term_idx").agg(
        F.sum(F.col("_h") - h(F.col("_nv"))).alias("_s"), F.sum("_nv").alias("_nz"),
        *([] if many else totals))
    h_classes = classes.agg(F.sum(h(F.col("n_y")))).first()[0]
    if many:
        # the zero cell of a class without the term is the class itself
        own = bounded_broadcast(classes.select(label_col, F.col("n_y").alias("_ny")), n_classes)
        zero = present.join(own, label_col).groupBy("term_idx").agg(
            F.sum(h(F.col("_ny") - F.col("_nz")) - h(F.col("_ny"))).alias("_z"))
        per_term = per_term.join(zero, "term_idx").withColumn("_z", F.col("_z") + F.lit(h_classes))
    else:
        sizes = {r["_slot"]: r["n_y"] for r in at.collect()}  # at most MI_CLASSES
        zeros = [h(F.lit(sizes[i]) - F.col(f"_z{i}")) for i in range(width)]
        per_term = per_term.withColumn("_z", sum(zeros[1:], zeros[0]))
    score = (F.col("_s") + F.col("_z") - h(F.lit(int(n_docs)) - F.col("_nz")) - F.lit(h_classes)
             + F.lit(N * math.log(N))) / N
    return per_term.select("term_idx", F.greatest(score, F.lit(0.0)).alias("score"))


def select_k_best(scored_vocab: DataFrame, k: int) -> DataFrame:
    """Flag the ``k`` best scores (ties at the cut: later ``term_idx`` wins);
    ``sel_idx`` numbers the selected terms in vocabulary order.

    Top-k is a per-partition top-k plus a merge (no global sort); the ``k``
    selected rows are then numbered and broadcast back (``k`` is checked)."""
    key = F.round(F.coalesce("score", F.lit(float("-inf"))), 9)
    top = scored_vocab.orderBy(key.desc(), F.desc("term_idx")).limit(k).select("term_idx")
    top = top.withColumn("sel_idx", (F.row_number().over(Window.orderBy("term_idx")) - 1).cast("int")) \
             .withColumn("selected", F.lit(True))
    out = scored_vocab.join(bounded_broadcast(top, k), "term_idx", "left")
    return out.withColumn("selected", F.coalesce("selected", F.lit(False)))


# ---------------------------------------------------------------------------
# Model
# ---------------------------------------------------------------------------

@dataclass
class FeatureModel:
    """Fitted extractor: a small model table plus the settings."""
    table: DataFrame
    config: FeatureConfig
    n_docs: int
    n_terms: int
    n_selected: int
    text_col: str = "cleaned_text"
    meta: dict = field(default_factory=dict)

    @property
    def bound(self) -> int:
        return self.n_terms

    def feature_names(self) -> DataFrame:
        """Selected (or all) term names in output order."""
        t = self.table
        if self.config.method is not None:
            return t.where("selected").select("sel_idx", "term").orderBy("sel_idx")
        return t.select(F.col("term_idx").alias("sel_idx"), "term").orderBy("sel_idx")

    def importance(self) -> DataFrame:
        """Selected terms with their own score, best first."""
        if self.config.method is None:
            raise ValueError("No feature selector fitted")
        return (self.table.where("selected").select("term", F.col("score"))
                    .orderBy(F.desc("score"), F.asc("term")))

    def transform(self, df: DataFrame, id_col: str, keep: list[str] | None = None,
                  text_col: str | None = None, zeros: bool = False, held: tuple | None = None) -> DataFrame:
        """Long features ``keep + (sel_idx, term, value)`` of ``df``; unknown
        terms are ignored. Documents without a selected term have no rows, or
        with ``zeros`` one row of nulls. ``held``: :func:`held_model`, if the
        caller has it."""
        return transform(self, df, id_col, keep, text_col, zeros=zeros, held=held)

    def save(self, path: str, mode: str = "overwrite") -> None:
        spark = self.table.sparkSession
        self.table.write.mode(mode).parquet(path.rstrip("/") + "/table")
        meta = {"config": asdict(self.config), "n_docs": self.n_docs, "n_terms": self.n_terms,
                "n_selected": self.n_selected, "text_col": self.text_col}
        spark.createDataFrame([(json.dumps(meta, default=list),)], "meta string") \
             .coalesce(1).write.mode(mode).text(path.rstrip("/") + "/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureModel":
        meta = json.loads(spark.read.text(path.rstrip("/") + "/meta").first()[0])
        c = meta["config"]
        c["ngram_range"] = tuple(c["ngram_range"])
        c["stop_words"] = None if c["stop_words"] is None else tuple(c["stop_words"])
        table = spark.read.parquet(path.rstrip("/") + "/table")
        return cls(table, FeatureConfig(**c), meta["n_docs"], meta["n_terms"], meta["n_selected"],
                   meta["text_col"])


def fit(df: DataFrame, text_col: str = "cleaned_text", label_col: str | None = "sentiment",
        id_col: str = "doc_id", cfg: FeatureConfig = LIVE_CONFIG,
        checkpoint: bool = True, terms: DataFrame | None = None, stats: DataFrame | None = None,
        weigh: Callable[[DataFrame], DataFrame] | None = None) -> FeatureModel:
    """Fit vocabulary, idf and (optionally) the selector on ``df``, or on
    ``terms``, its stored :func:`doc_terms` with id and label (``stats``: their
    :func:`term_statistics`, if the caller has them; ``weigh``: gives the
    :func:`tfidf_weights` for a vocabulary, likewise). A null label is
    an error: its documents would count for idf but not for the scores.

    The driver sees the numbers of documents, classes and terms; class sizes stay
    a table. The model table is checkpointed to the shared checkpoint folder, so
    transforms read a small stored table.
    """
    from pyspark import StorageLevel
    from ..session import ensure_checkpoint_dir
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
    keep = [id_col] + ([label_col] if label_col else [])
    # The per-document term arrays feed three jobs (class counts, vocabulary,
    # scores): persist them (memory, spilling to disk; lost blocks are
    # recomputed from lineage).
    dt = terms if terms is not None else doc_terms(df, text_col, cfg, keep).persist(StorageLevel.MEMORY_AND_DISK)
    if label_col:
        classes = dt.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_y"))
        classes = classes.checkpoint() if checkpoint else classes.persist()
        n_docs, n_classes, nulls = classes.agg(F.sum("n_y"), F.count(F.lit(1)), F.count_if(F.col(label_col).isNull())).first()
        if nulls:
            raise ValueError(f"{label_col} holds nulls in the training input")
        n_docs = n_docs or 0
    else:
        classes, n_classes, n_docs = None, 0, dt.count()
    if n_docs == 0:
        dt.unpersist()
        raise ValueError("empty training input")
    stats = term_statistics(dt) if stats is None else stats
    vocab = with_idf(top_vocabulary(prune_vocabulary(stats, cfg, n_docs), cfg.max_features), n_docs)
    vocab = vocab.checkpoint() if checkpoint else vocab.persist()
    n_terms = vocab.count()
    if n_terms == 0:
        raise ValueError("After pruning, no terms remain. Try a lower min_df or a higher max_df.")
    method = cfg.method
    table = vocab
    n_selected = n_terms
    if method is not None:
        if not label_col:
            raise ValueError("feature selection needs a label column")
        k = min(cfg.k, n_terms)
        weights = tfidf_weights(dt, vocab, id_col, keep, n_terms) if weigh is None else weigh(vocab)
        cached = []
        if method == "mutual_info":  # reads the weights twice: keep them
            weights = weights.persist(StorageLevel.MEMORY_AND_DISK)
            cached = [weights]
        if method == "chi2":
            sc = chi2_scores(weights, label_col, classes, n_classes, n_docs)
        elif method == "mutual_info":
            sc = mutual_info_scores(weights, label_col, classes, n_classes, n_docs, vocab)
        else:
            raise ValueError(f"Unknown selection method: {method}")
        scored = vocab.join(sc, "term_idx", "left")
        if method == "mutual_info":
            scored = scored.withColumn("score", F.coalesce("score", F.lit(0.0)))
        # read twice by the selection (top-k and join back); one row per term
        scored = scored.persist()
        cached.append(scored)
        table = select_k_best(scored, k)
        n_selected = k
    else:
        cached = []
        table = table.withColumn("score", F.lit(None).cast("double")) \
                     .withColumn("selected", F.lit(True)) \
                     .withColumn("sel_idx", F.col("term_idx"))
    table = table.select("term", "term_idx", "df", "ctf", "idf", "score", "selected", "sel_idx")
    if checkpoint:
        table = table.checkpoint()
    else:
        table = table.persist()
        table.count()
    if terms is None:
        dt.unpersist()
    for c in cached + ([classes] if classes is not None and not checkpoint else []):
        c.unpersist()
    return FeatureModel(table, cfg, n_docs, int(n_terms), int(n_selected), text_col)


def held_model(model: FeatureModel) -> tuple[list | None, list[int] | None]:
    """(:func:`held_vocabulary`, selected term indices in order) of a model;
    (None, None) beyond the bounds."""
    rows = held_vocabulary(model.table, model.bound)
    if rows is None:
        return None, None
    chosen = model.table.where("selected").select("term_idx").orderBy("term_idx").collect()
    return rows, [r["term_idx"] for r in chosen]


def transform(model: FeatureModel, df: DataFrame, id_col: str, keep: list[str] | None = None,
              text_col: str | None = None, terms: DataFrame | None = None, zeros: bool = False,
              held: tuple | None = None) -> DataFrame:
    """Long selected features of ``df``, or of ``terms``, its stored
    :func:`doc_terms` with the ``keep`` columns. ``zeros``: as in
    :func:`tfidf_weights`; ``held``: :func:`held_model`, if the caller has it."""
    text_col = text_col or model.text_col
    keep = keep or [id_col]
    if id_col not in keep:
        keep = [id_col] + keep
    vocab = model.table.select("term", "term_idx", "idf")
    sel = model.table.where("selected").select("term_idx", "sel_idx", "term")
    rows, chosen = held or held_model(model)
    if terms is not None:
        dt = terms
    elif rows is not None:
        dt = grams(df.select(*keep, text_col), text_col, model.config).select(*keep, "grams")
    else:
        dt = doc_terms(df, text_col, model.config, keep)
    w = tfidf_weights(dt, vocab, id_col, keep, model.bound, sel, zeros, rows, chosen)
    out = w.join(bounded_broadcast(sel, model.n_selected), "term_idx", "left" if zeros else "inner")
    return out.select(*keep, "sel_idx", "term", "value")


def fit_transform(df: DataFrame, text_col: str = "cleaned_text", label_col: str = "sentiment",
                  id_col: str = "doc_id", cfg: FeatureConfig = LIVE_CONFIG) -> tuple[DataFrame, FeatureModel]:
    m = fit(df, text_col, label_col, id_col, cfg)
    return m.transform(df, id_col, [id_col] + ([label_col] if label_col else [])), m


def feature_vectors(model: FeatureModel, df: DataFrame, id_col: str, text_col: str | None = None,
                    terms: DataFrame | None = None) -> DataFrame:
    """(id, features: SparseVector) for every row of ``df``, or of ``terms``, its
    stored :func:`doc_terms`, as Spark ML would consume them: TF-IDF with L2 norm over the whole vocabulary, cut to the
    selected terms.

    While the vocabulary is held by every worker (:func:`held_vocabulary`) this
    is ``CountVectorizerModel``, idf scaling, ``Normalizer`` and
    ``VectorSlicer``, row-wise in the JVM. A larger one stays a table: the long
    features of :func:`transform` are gathered again, one document a group, and
    ids must be unique."""
    text_col = text_col or model.text_col
    held, chosen = held_model(model)
    if held is not None:
        if terms is None:
            g = grams(df.select(id_col, text_col), text_col, model.config)
        else:
            g = terms.select(id_col, counted_grams("terms").alias("grams"))
        g = g.withColumn("grams", F.coalesce("grams", F.array().cast("array<string>")))  # a null text has none
        x = weight_vectors(g, "grams", held, chosen)
        return x.select(id_col, "features")
    from pyspark.ml.linalg import SparseVector, VectorUDT
    size = model.n_selected
    entries = (transform(model, df, id_col, text_col=text_col, zeros=True, held=(None, None),
                         terms=None if terms is None else terms.select(id_col, "terms"))
               .groupBy(id_col).agg(F.sort_array(F.collect_list(
                   F.when(F.col("sel_idx").isNotNull(), F.struct("sel_idx", "value")))).alias("_e")))
    # Spark has no column function that makes a sparse vector
    sparse = F.udf(lambda i, v: SparseVector(size, i, v), VectorUDT())
    return entries.select(id_col, sparse(F.col("_e.sel_idx"), F.col("_e.value")).alias("features"))
