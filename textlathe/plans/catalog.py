"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB
oracle per key. ``__spark_entry__`` exposes both dictionaries.

Every query reads the driver tables in ``sf_dir`` (or data Spark derives from
them) in full. Floating outputs are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import sqltext as S
from .inputs import LABELLED_DOCS_SQL, LANG_DOCS_SQL, labelled_docs, lang_docs, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(c, 6)


# ---------------------------------------------------------------------------
# Shared SQL pieces
# ---------------------------------------------------------------------------

def processed_sql(src_sql: str) -> str:
    """B3-B15 over a (doc_id, text, sentiment) source, in DuckDB."""
    low = S.lowercase("text")
    return (f"SELECT doc_id, text, sentiment, cleaned, CAST(length(cleaned) AS INTEGER) AS text_length FROM ("
            f"SELECT doc_id, text, sentiment, {S.clean_text('text')} AS cleaned FROM ("
            f"SELECT doc_id, {low} AS text, sentiment FROM ({src_sql}) "
            f"WHERE text IS NOT NULL AND sentiment IS NOT NULL) "
            f"WHERE NOT ({S.is_blank('text')})) WHERE length(cleaned) > 0")


def features_ctes(src: str, max_features: int | None = 1000, min_df: int = 1, max_df: float = 0.95) -> str:
    """CTEs tk, g, tf, nd, stats, vocab, w, nw over a CTE ``src`` with
    (doc_id, sentiment, cleaned)."""
    lim = f"LIMIT {max_features}" if max_features is not None else ""
    return f"""
tk AS (SELECT doc_id, sentiment, {S.vectorizer_tokens('cleaned')} AS tk FROM {src}),
g AS (SELECT doc_id, sentiment, unnest({S.ngrams_1_2('tk')}) AS term FROM tk),
tf AS (SELECT doc_id, sentiment, term, count(*) AS tf FROM g GROUP BY doc_id, sentiment, term),
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {src}),
stats AS (SELECT term, count(*) AS df, sum(tf) AS ctf FROM tf GROUP BY term),
vocab0 AS (SELECT s.* FROM stats s, nd WHERE df >= {float(min_df)} AND df <= CAST({max_df} AS DOUBLE) * nd.n
           ORDER BY ctf DESC, term ASC {lim}),
vocab AS (SELECT term, df, ctf, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_idx,
                 ln((1 + nd.n) / (1 + df)) + 1 AS idf FROM vocab0, nd),
w AS (SELECT tf.doc_id, tf.sentiment, v.term, v.term_idx, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term),
nw AS (SELECT doc_id, sentiment, term, term_idx, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM w)"""


def chi2_ctes(src: str) -> str:
    return f"""
pri AS (SELECT sentiment, count(*) / max(nd.n) AS p FROM {src}, nd GROUP BY sentiment),
obs AS (SELECT term_idx, sentiment, sum(value) AS o FROM nw GROUP BY term_idx, sentiment),
ft AS (SELECT term_idx, sum(o) AS F FROM obs GROUP BY term_idx),
grid AS (SELECT v.term_idx, v.term, p.sentiment, p.p, ft.F, coalesce(o.o, 0) AS o
         FROM vocab v JOIN ft ON ft.term_idx = v.term_idx CROSS JOIN pri p
         LEFT JOIN obs o ON o.term_idx = v.term_idx AND o.sentiment = p.sentiment),
chi AS (SELECT term_idx, term, sum((o - p * F) * (o - p * F) / (p * F)) AS score FROM grid GROUP BY term_idx, term)"""


# ---------------------------------------------------------------------------
# Flagship: documents + labels -> clean -> TF-IDF -> chi-square -> top 50
# ---------------------------------------------------------------------------

def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed labelled documents, persisted: most feature queries read
    them for fitting and again for transforming."""
    from pyspark import StorageLevel
    from ..operators.cleaning import process_data
    return process_data(labelled_docs(spark, sf_dir), timestamp=False).persist(StorageLevel.MEMORY_AND_DISK)


@register("chi2_top_terms", f"""
WITH p AS ({processed_sql(LABELLED_DOCS_SQL)}),
src AS (SELECT doc_id, sentiment, cleaned FROM p),
{features_ctes('src')},
{chi2_ctes('src')}
SELECT term, round(score, 6) AS score FROM chi ORDER BY round(score, 9) DESC, term_idx DESC LIMIT 50""")
def chi2_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.features import LIVE_CONFIG, fit
    model = fit(_processed(spark, sf_dir), "cleaned_text", "sentiment", "doc_id", LIVE_CONFIG)
    return model.importance().select("term", r6("score").alias("score"))


# ---------------------------------------------------------------------------
# B: cleaning
# ---------------------------------------------------------------------------

def _lbl_docs_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, label = quality + toxic (0, 1, 2) where labelled, null
    otherwise: natural nulls and out-of-range labels for the checks."""
    from ..operators.cleaning import spread
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lab = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") + F.col("toxic")).alias("sentiment"))
    return docs.join(lab, "doc_id", "left")


LEFT_DOCS_SQL = ("SELECT d.doc_id, d.text, l.quality + l.toxic AS sentiment "
                 "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")


@register("standardize_columns", "SELECT doc_id, md5(text) AS text_md5, lang AS sentiment FROM documents")
def q_standardize(spark, sf_dir):
    from ..operators.cleaning import standardize_columns
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"), "lang")
    return standardize_columns(d, "body", "lang").select("doc_id", F.md5("text").alias("text_md5"), "sentiment")


@register("drop_null_keys", f"SELECT doc_id, sentiment FROM ({LEFT_DOCS_SQL}) WHERE text IS NOT NULL AND sentiment IS NOT NULL")
def q_drop_null(spark, sf_dir):
    from ..operators.cleaning import drop_null_keys
    return drop_null_keys(_lbl_docs_left(spark, sf_dir)).select("doc_id", "sentiment")


@register("lowercase_text", f"SELECT doc_id, md5({S.lowercase('text')}) AS text_md5, "
                            f"CAST(length({S.lowercase('text')}) AS INTEGER) AS n FROM documents")
def q_lower(spark, sf_dir):
    from ..operators.cleaning import lowercase_text
    d = lowercase_text(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n"))


# documents with some texts blanked, so that the blank branch has rows
BLANKED_SQL = ("(SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN ' ' || chr(9) || chr(10) ELSE text END AS text, "
               "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE lang END AS sentiment FROM documents)")


def _blanked(spark, sf_dir):
    text = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 7 == 1, " \t\n").otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.alias("text"), F.when(F.col("doc_id") % 11 != 0, F.col("lang")).alias("sentiment"))


@register("drop_blank_text", f"SELECT doc_id, md5({S.lowercase('text')}) AS text_md5 FROM {BLANKED_SQL} "
                             f"WHERE NOT ({S.is_blank(S.lowercase('text'))})")
def q_blank(spark, sf_dir):
    from ..operators.cleaning import drop_blank_text, lowercase_text
    return drop_blank_text(lowercase_text(_blanked(spark, sf_dir))).select("doc_id", F.md5("text").alias("text_md5"))


@register("cleaning_report", f"""
SELECT CAST(count(*) AS BIGINT) AS rows_in,
       CAST(count(*) FILTER (WHERE text IS NULL OR sentiment IS NULL) AS BIGINT) AS dropped_null,
       CAST(count(*) FILTER (WHERE text IS NOT NULL AND sentiment IS NOT NULL AND {S.is_blank(S.lowercase('text'))}) AS BIGINT) AS dropped_blank,
       CAST(count(*) FILTER (WHERE text IS NOT NULL AND sentiment IS NOT NULL AND NOT ({S.is_blank(S.lowercase('text'))})) AS BIGINT) AS rows_out
FROM {BLANKED_SQL}""")
def q_cleaning_report(spark, sf_dir):
    from ..operators.cleaning import cleaning_report
    return cleaning_report(_blanked(spark, sf_dir))


@register("strip_special", f"SELECT doc_id, md5({S.strip_special(S.lowercase('text'))}) AS h FROM documents")
def q_strip(spark, sf_dir):
    from ..functions import text as T
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.strip_special(T.lowercase("text"))).alias("h"))


@register("tokenize", f"SELECT doc_id, unnest({S.tokenize(S.strip_special(S.lowercase('text')))}) AS token FROM documents")
def q_tokenize(spark, sf_dir):
    from ..functions import text as T
    from ..operators.cleaning import spread
    d = spread(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.explode(T.tokenize(T.strip_special(T.lowercase("text")))).alias("token"))


@register("remove_stopwords", f"SELECT doc_id, md5(array_to_string({S.remove_stopwords(S.tokenize(S.strip_special(S.lowercase('text'))))}, ' ')) AS tokens_md5 FROM documents")
def q_stop(spark, sf_dir):
    from ..functions import text as T
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(F.array_join(T.remove_stopwords(T.tokenize(T.strip_special(T.lowercase("text")))), " ")).alias("tokens_md5"))


@register("lemmatize", f"""
SELECT lemma, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest({S.clean_tokens('text')}) AS lemma FROM documents) GROUP BY lemma""")
def q_lemma(spark, sf_dir):
    from ..functions import text as T
    from ..operators.cleaning import spread
    d = spread(table(spark, sf_dir, "documents"))
    return (d.select(F.explode(T.clean_tokens("text")).alias("lemma"))
             .groupBy("lemma").agg(F.count(F.lit(1)).alias("n")))


@register("clean_text", f"SELECT doc_id, {S.clean_text('text')} AS cleaned_text FROM documents")
def q_clean(spark, sf_dir):
    from ..functions import text as T
    from ..operators.cleaning import spread
    return spread(table(spark, sf_dir, "documents")).select("doc_id", T.clean_text("text").alias("cleaned_text"))


# A lexicon derived from ``part``: every word of a part name is the form, its
# first three letters the lemma; and two plurals that the rules would cut.
LEXICON_SQL = """SELECT DISTINCT form, substr(form, 1, 3) AS lemma FROM (
  SELECT unnest(string_split(lower(p_name), ' ')) AS form FROM part) WHERE length(form) > 3
  UNION SELECT form, lemma FROM (VALUES ('thes', 'kept'), ('ands', 'both')) AS v(form, lemma)"""


def _lexicon(spark, sf_dir):
    words = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("form"))
    words = words.where("length(form) > 3").distinct().withColumn("lemma", F.substring("form", 1, 3))
    return words.unionByName(spark.createDataFrame([("thes", "kept"), ("ands", "both")], "form string, lemma string"))


@register("lemmatize_lexicon", f"""WITH lx AS ({LEXICON_SQL}),
t AS (SELECT doc_id, {S.clean_tokens(S.lowercase('text'), lemmas=False)} AS tk FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, unnest(tk) AS tok, generate_subscripts(tk, 1) AS pos FROM t),
l AS (SELECT doc_id, pos, coalesce(lemma, {S.lemma_rule('tok')}) AS lem FROM x LEFT JOIN lx ON tok = form)
SELECT doc_id, md5(string_agg(lem, ' ' ORDER BY pos)) AS cleaned_md5, count(*) AS n_tokens FROM l GROUP BY doc_id""")
def q_lemmatize_lexicon(spark, sf_dir):
    """process_data with a lexicon table before the lemma rules."""
    from ..operators.cleaning import process_data
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.lit(1).alias("sentiment"))
    p = process_data(d, lexicon=_lexicon(spark, sf_dir), timestamp=False)
    return p.select("doc_id", F.md5("cleaned_text").alias("cleaned_md5"),
                    F.size(F.split("cleaned_text", " ")).cast("bigint").alias("n_tokens"))


@register("text_length", f"SELECT doc_id, text_length FROM ({processed_sql(LABELLED_DOCS_SQL)})")
def q_text_length(spark, sf_dir):
    return _processed(spark, sf_dir).select("doc_id", "text_length")


@register("process_data", f"SELECT doc_id, sentiment, cleaned AS cleaned_text, text_length FROM ({processed_sql(LANG_DOCS_SQL)})")
def q_process(spark, sf_dir):
    from ..operators.cleaning import process_data
    return process_data(lang_docs(spark, sf_dir)).select("doc_id", "sentiment", "cleaned_text", "text_length")


@register("features_labels", f"SELECT cleaned AS features, sentiment AS label FROM ({processed_sql(LABELLED_DOCS_SQL)})")
def q_features_labels(spark, sf_dir):
    from ..operators.cleaning import features_labels
    return features_labels(_processed(spark, sf_dir))


def _na_tokens():
    from ..functions import constants as K
    return [*K.NA_TOKENS, "nA", " "]  # the last two are ordinary values


@register("normalize_nulls", f"""SELECT doc_id, CASE WHEN list_contains({S.str_list(_na_tokens()[:-2])}, v) THEN NULL ELSE v END AS value
FROM (SELECT doc_id, {S.str_list(_na_tokens())}[CAST(doc_id % {len(_na_tokens())} AS INTEGER) + 1] AS v FROM documents)""")
def q_normalize_nulls(spark, sf_dir):
    """Every missing-value token, and two look-alikes, as a field."""
    from ..operators.cleaning import normalize_nulls
    t = _na_tokens()
    at = (F.col("doc_id") % len(t) + 1).cast("int")
    d = table(spark, sf_dir, "documents").select("doc_id", F.element_at(F.array(*[F.lit(x) for x in t]), at).alias("value"))
    return normalize_nulls(d, ["value"])


# ---------------------------------------------------------------------------
# C: labels
# ---------------------------------------------------------------------------

@register("label_mapping", "SELECT source AS label, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS label_idx "
                           "FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)")
def q_label_mapping(spark, sf_dir):
    from ..operators.labels import label_mapping
    return label_mapping(table(spark, sf_dir, "documents"), "source")


@register("apply_label_mapping", """
WITH m AS (SELECT lang AS label, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_idx
           FROM (SELECT DISTINCT d.lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1)),
j AS (SELECT d.doc_id, m.label_idx FROM documents d LEFT JOIN m ON d.lang = m.label)
SELECT doc_id, CAST(coalesce(label_idx, (SELECT coalesce(max(label_idx), -1) + 1 FROM j)) AS INTEGER) AS sentiment FROM j""")
def q_apply_label_mapping(spark, sf_dir):
    """Mapping fitted on a subset (languages of quality-1 documents) and
    applied to all documents: unmapped labels get max + 1."""
    from ..operators.labels import apply_label_mapping, label_mapping
    docs = table(spark, sf_dir, "documents")
    fit_on = docs.join(table(spark, sf_dir, "labels").where("quality = 1"), "doc_id")
    m = label_mapping(fit_on, "lang")
    return apply_label_mapping(docs.select("doc_id", F.col("lang").alias("sentiment")), m).select("doc_id", "sentiment")


@register("label_distribution", """
WITH m AS (SELECT source AS label, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS label_idx
           FROM (SELECT DISTINCT d.source FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 0)),
j AS (SELECT m.label_idx FROM documents d LEFT JOIN m ON d.source = m.label),
f AS (SELECT CAST(coalesce(label_idx, (SELECT coalesce(max(label_idx), -1) + 1 FROM j)) AS INTEGER) AS label_idx FROM j)
SELECT f.label_idx, coalesce(m.label, 'Unknown_' || CAST(f.label_idx AS VARCHAR)) AS label_name, CAST(count(*) AS BIGINT) AS n
FROM f LEFT JOIN m ON f.label_idx = m.label_idx GROUP BY f.label_idx, m.label""")
def q_label_distribution(spark, sf_dir):
    from ..operators.labels import apply_label_mapping, label_distribution, label_mapping
    docs = table(spark, sf_dir, "documents")
    m = label_mapping(docs.join(table(spark, sf_dir, "labels").where("toxic = 0"), "doc_id"), "source")
    mapped = apply_label_mapping(docs.select("doc_id", F.col("source").alias("sentiment")), m)
    return label_distribution(mapped, m)


# ---------------------------------------------------------------------------
# D: quality
# ---------------------------------------------------------------------------

@register("quality_report", f"""
WITH s AS ({LEFT_DOCS_SQL}),
pc AS (SELECT sentiment, count(*) AS n FROM s GROUP BY sentiment),
a AS (SELECT CAST(count(*) FILTER (WHERE sentiment IS NULL OR sentiment NOT IN (0, 1)) AS DOUBLE) AS bad,
             (count(*) FILTER (WHERE doc_id IS NULL) + count(*) FILTER (WHERE text IS NULL)
              + count(*) FILTER (WHERE sentiment IS NULL)) / (count(*) * 3.0) AS mr,
             CAST(count(*) FILTER (WHERE length(text) < 10) AS DOUBLE) AS short,
             CAST(count(*) FILTER (WHERE length(text) > 1000) AS DOUBLE) AS long,
             (SELECT CAST(count(*) AS DOUBLE) FROM pc WHERE sentiment IS NOT NULL AND n < 10) AS small FROM s)
SELECT * FROM (VALUES ('required_columns', 'error', 0.0::DOUBLE, 0.0::DOUBLE, true)) t("check", severity, value, threshold, passed)
UNION ALL SELECT 'label_numeric', 'error', 1.0, 1.0, true
UNION ALL SELECT 'label_values', 'error', bad, 0.0, bad = 0 FROM a
UNION ALL SELECT 'missing_ratio', 'error', mr, 0.05, mr <= 0.05 FROM a
UNION ALL SELECT 'short_texts', 'warning', short, 10.0, short = 0 FROM a
UNION ALL SELECT 'long_texts', 'warning', long, 1000.0, long = 0 FROM a
UNION ALL SELECT 'small_classes', 'warning', small, 10.0, small = 0 FROM a""")
def q_quality_report(spark, sf_dir):
    from ..operators.quality import quality_report
    return quality_report(_lbl_docs_left(spark, sf_dir), required=("text", "sentiment"))


@register("invalid_labels", f"SELECT sentiment, CAST(count(*) AS BIGINT) AS n FROM ({LEFT_DOCS_SQL}) "
                            "WHERE sentiment IS NULL OR sentiment NOT IN (0, 1) GROUP BY sentiment")
def q_invalid_labels(spark, sf_dir):
    from ..operators.quality import invalid_labels
    return invalid_labels(_lbl_docs_left(spark, sf_dir))


@register("missing_ratio", f"""
SELECT CAST(nc AS BIGINT) AS null_cells, CAST(tc AS BIGINT) AS total_cells, nc / tc AS missing_ratio FROM (
  SELECT CAST(count(*) FILTER (WHERE doc_id IS NULL) + count(*) FILTER (WHERE text IS NULL)
         + count(*) FILTER (WHERE sentiment IS NULL) AS DOUBLE) AS nc, count(*) * 3.0 AS tc FROM ({LEFT_DOCS_SQL}))""")
def q_missing_ratio(spark, sf_dir):
    from ..operators.quality import missing_ratio
    return missing_ratio(_lbl_docs_left(spark, sf_dir))


@register("text_length_bounds", "SELECT CAST(count(*) FILTER (WHERE length(text) < 10) AS BIGINT) AS short_texts, "
                                "CAST(count(*) FILTER (WHERE length(text) > 1000) AS BIGINT) AS long_texts FROM conversations")
def q_text_bounds(spark, sf_dir):
    from ..operators.quality import text_length_bounds
    return text_length_bounds(table(spark, sf_dir, "conversations"))


@register("small_classes", "SELECT source AS sentiment, CAST(count(*) AS BIGINT) AS n FROM documents d JOIN labels l "
                           "ON d.doc_id = l.doc_id WHERE l.toxic = 1 GROUP BY source HAVING count(*) < 10")
def q_small_classes(spark, sf_dir):
    from ..operators.quality import small_classes
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id")
    return small_classes(d.select(F.col("source").alias("sentiment")))


@register("null_summary", f"""
WITH s AS ({LEFT_DOCS_SQL})
SELECT 'doc_id' AS "column", 'bigint' AS dtype, CAST(count(*) FILTER (WHERE doc_id IS NULL) AS BIGINT) AS nulls, CAST(count(*) AS BIGINT) AS total_rows FROM s
UNION ALL SELECT 'text', 'string', count(*) FILTER (WHERE text IS NULL), count(*) FROM s
UNION ALL SELECT 'sentiment', 'int', count(*) FILTER (WHERE sentiment IS NULL), count(*) FROM s""")
def q_null_summary(spark, sf_dir):
    from ..operators.quality import null_summary
    return null_summary(_lbl_docs_left(spark, sf_dir))


@register("class_balance", f"""
SELECT sentiment, CAST(count(*) AS BIGINT) AS n, count(*) / (SELECT count(*) FROM ({LEFT_DOCS_SQL})) AS share
FROM ({LEFT_DOCS_SQL}) WHERE sentiment IS NOT NULL GROUP BY sentiment""")
def q_class_balance(spark, sf_dir):
    from ..operators.quality import class_balance
    return class_balance(_lbl_docs_left(spark, sf_dir))


def _length_stats_sql(expr: str, src: str) -> str:
    return (f"SELECT avg(L) AS mean, stddev_samp(L) AS std, CAST(min(L) AS BIGINT) AS min, CAST(max(L) AS BIGINT) AS max, "
            f"CAST(median(L) AS DOUBLE) AS median FROM (SELECT CAST(length({expr}) AS BIGINT) AS L FROM ({src}) WHERE {expr} IS NOT NULL)")


@register("text_length_stats", _length_stats_sql("text", "SELECT * FROM documents"))
def q_length_stats(spark, sf_dir):
    from ..operators.quality import length_stats
    return length_stats(table(spark, sf_dir, "documents"))


@register("cleaned_length_stats", _length_stats_sql("cleaned", processed_sql(LABELLED_DOCS_SQL)))
def q_cleaned_stats(spark, sf_dir):
    from ..operators.quality import length_stats
    return length_stats(_processed(spark, sf_dir), "cleaned_text")


# ---------------------------------------------------------------------------
# E: splits
# ---------------------------------------------------------------------------

def _approx_mode_sql(name: str, counts: str, col: str, ndraw: str) -> str:
    """CTE ``name``(sentiment, part): largest-remainder draw of ``ndraw``
    rows from per-class ``counts.col`` (ties: label ascending)."""
    return f"""
{name}_c AS (SELECT sentiment, CAST({col} AS DOUBLE) / (SELECT sum({col}) FROM {counts}) * ({ndraw}) AS cont FROM {counts}),
{name}_f AS (SELECT sentiment, floor(cont) AS fl, cont - floor(cont) AS rem FROM {name}_c),
{name} AS (SELECT sentiment, CAST(fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, sentiment) <=
              ({ndraw}) - (SELECT sum(fl) FROM {name}_f) THEN 1 ELSE 0 END AS BIGINT) AS part FROM {name}_f)"""


def split_sql(src: str, share1: str, share2: str, seed: int, names=("train", "test", "val"),
              test_first: bool = False) -> str:
    """CTEs ending in ``assigned``(doc_id, sentiment, split) over CTE ``src``
    (doc_id, sentiment). Two draws as in the Spark operator."""
    n_keep1 = f"(SELECT sum(n) FROM cc) - CAST(ceil(({share1}) * (SELECT sum(n) FROM cc)) AS BIGINT)"
    c2 = "part" if test_first else "r1"  # second draw: over kept rows (test first) or the rest
    n_keep2 = f"(SELECT sum({c2}) FROM d1) - CAST(ceil(({share2}) * (SELECT sum({c2}) FROM d1)) AS BIGINT)"
    if test_first:
        # draw 1 keeps the rest (train+val), its remainder is test; draw 2
        # keeps train, its remainder is val. Rank order: test, val, train.
        q = "q AS (SELECT d1.sentiment, d1.r1 AS c1, d1.r1 + d2.r2 AS c2 FROM d1 JOIN d2 ON d1.sentiment = d2.sentiment)"
    else:
        q = "q AS (SELECT d1.sentiment, d1.part AS c1, d1.part + d2.part AS c2 FROM d1 JOIN d2 ON d1.sentiment = d2.sentiment)"
    return f"""
cc AS (SELECT sentiment, count(*) AS n FROM {src} GROUP BY sentiment),
{_approx_mode_sql('a1', 'cc', 'n', n_keep1)},
d1 AS (SELECT cc.sentiment, a1.part, cc.n - a1.part AS r1 FROM cc JOIN a1 ON cc.sentiment = a1.sentiment),
{_approx_mode_sql('a2', 'd1', c2, n_keep2)},
d2 AS (SELECT d1.sentiment, a2.part, d1.{c2} - a2.part AS r2 FROM d1 JOIN a2 ON d1.sentiment = a2.sentiment),
{q},
ranked AS (SELECT s.doc_id, s.sentiment, row_number() OVER (PARTITION BY s.sentiment
             ORDER BY md5('{seed}:' || CAST(s.doc_id AS VARCHAR)), s.doc_id) AS rk FROM {src} s),
assigned AS (SELECT r.doc_id, r.sentiment, CASE WHEN rk <= c1 THEN '{names[0]}' WHEN rk <= c2 THEN '{names[1]}'
             ELSE '{names[2]}' END AS split FROM ranked r JOIN q ON r.sentiment = q.sentiment)"""


SHARE1 = "0.2::DOUBLE + 0.1::DOUBLE"
SHARE2 = "0.1::DOUBLE / (0.2::DOUBLE + 0.1::DOUBLE)"


def _split_input(spark, sf_dir):
    """Written first: a split reads its input twice."""
    return materialize(_processed(spark, sf_dir).select("doc_id", "sentiment"), "split-input")


SPLIT_SRC = f"src AS (SELECT doc_id, sentiment FROM ({processed_sql(LABELLED_DOCS_SQL)}))"


@register("stratified_split", f"WITH {SPLIT_SRC}, {split_sql('src', SHARE1, SHARE2, 69)} SELECT * FROM assigned")
def q_stratified_split(spark, sf_dir):
    from ..operators.split import stratified_split
    return stratified_split(_split_input(spark, sf_dir))


@register("split_report", f"WITH {SPLIT_SRC}, {split_sql('src', SHARE1, SHARE2, 69)} "
                          "SELECT split, sentiment, CAST(count(*) AS BIGINT) AS n FROM assigned GROUP BY split, sentiment")
def q_split_report(spark, sf_dir):
    from ..operators.split import split_report, stratified_split
    return split_report(stratified_split(_split_input(spark, sf_dir)))


@register("random_split", f"WITH src AS (SELECT doc_id, 0 AS sentiment FROM documents), "
                          f"{split_sql('src', SHARE1, SHARE2, 69)} SELECT doc_id, split FROM assigned")
def q_random_split(spark, sf_dir):
    from ..operators.split import stratified_split
    d = table(spark, sf_dir, "documents").select("doc_id")
    return stratified_split(d, label_col=None, stratify=False).select("doc_id", "split")


@register("reproduce_split", f"WITH src AS (SELECT doc_id, lang AS sentiment FROM documents), "
                             f"{split_sql('src', '0.25::DOUBLE + 0.1::DOUBLE', '0.1::DOUBLE / (0.25::DOUBLE + 0.1::DOUBLE)', 7)} "
                             "SELECT split, sentiment, CAST(count(*) AS BIGINT) AS n, sum(doc_id) AS id_sum FROM assigned GROUP BY split, sentiment")
def q_reproduce_split(spark, sf_dir):
    """Split rebuilt from stored params (val_size missing -> default)."""
    from ..operators.split import reproduce_split
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("sentiment"))
    s = reproduce_split(d, '{"test_size": 0.25, "random_state": 7}')
    return s.groupBy("split", "sentiment").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"))


@register("split_test_first", f"WITH src AS (SELECT doc_id, source AS sentiment FROM documents), "
                              f"{split_sql('src', '0.2::DOUBLE', '0.1::DOUBLE / (1 - 0.2::DOUBLE)', 69, ('test', 'val', 'train'), True)} "
                              "SELECT doc_id, sentiment, split FROM assigned")
def q_split_test_first(spark, sf_dir):
    from ..operators.split import split_test_first
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("sentiment"))
    return split_test_first(d).select("doc_id", "sentiment", "split")


@register("stratified_folds", """
WITH src AS (SELECT doc_id, lang AS sentiment FROM documents),
cc AS (SELECT sentiment, count(*) AS n FROM src GROUP BY sentiment),
off AS (SELECT sentiment, coalesce(sum(n) OVER (ORDER BY sentiment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM cc),
ranked AS (SELECT s.doc_id, s.sentiment, row_number() OVER (PARTITION BY s.sentiment
             ORDER BY md5('69:' || CAST(s.doc_id AS VARCHAR)), s.doc_id) AS rk FROM src s)
SELECT r.doc_id, r.sentiment, CAST((off.o + r.rk - 1) % 5 AS INTEGER) AS fold FROM ranked r JOIN off ON r.sentiment = off.sentiment""")
def q_folds(spark, sf_dir):
    from ..operators.split import stratified_folds
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("sentiment"))
    return stratified_folds(d, 5)


# ---------------------------------------------------------------------------
# F: features
# ---------------------------------------------------------------------------

FEAT_SRC = f"p AS ({processed_sql(LABELLED_DOCS_SQL)}), src AS (SELECT doc_id, sentiment, cleaned FROM p)"


def _fit(spark, sf_dir, **cfg_kw):
    from ..operators.features import LIVE_CONFIG, fit
    from dataclasses import replace
    cfg = replace(LIVE_CONFIG, **cfg_kw)
    return fit(_processed(spark, sf_dir), "cleaned_text", "sentiment", "doc_id", cfg)


@register("tfidf_tokens", f"WITH {FEAT_SRC} SELECT doc_id, md5(array_to_string({S.vectorizer_tokens('cleaned')}, ' ')) AS tokens_md5 FROM src")
def q_tfidf_tokens(spark, sf_dir):
    from ..functions import text as T
    return _processed(spark, sf_dir).select("doc_id", F.md5(F.array_join(T.vectorizer_tokens("cleaned_text"), " ")).alias("tokens_md5"))


@register("ngrams", f"WITH {FEAT_SRC}, tk AS (SELECT doc_id, {S.vectorizer_tokens('cleaned')} AS tk FROM src) "
                    f"SELECT doc_id, CAST(len({S.ngrams_1_2('tk')}) AS INTEGER) AS n_grams, "
                    f"md5(array_to_string({S.ngrams_1_2('tk')}, '|')) AS grams_md5 FROM tk")
def q_ngrams(spark, sf_dir):
    from ..operators.features import LIVE_CONFIG, grams
    g = grams(_processed(spark, sf_dir).select("doc_id", "cleaned_text"), "cleaned_text", LIVE_CONFIG)
    return g.select("doc_id", F.size("grams").alias("n_grams"), F.md5(F.array_join("grams", "|")).alias("grams_md5"))


@register("term_frequency", f"WITH {FEAT_SRC}, {features_ctes('src')} SELECT doc_id, term, tf FROM tf")
def q_tf(spark, sf_dir):
    from ..operators.features import LIVE_CONFIG, doc_terms, exploded_terms
    dt = doc_terms(_processed(spark, sf_dir), "cleaned_text", LIVE_CONFIG, ["doc_id"])
    return exploded_terms(dt, ["doc_id"])


@register("document_frequency", f"WITH {FEAT_SRC}, {features_ctes('src')} SELECT term, df, ctf FROM stats")
def q_df(spark, sf_dir):
    from ..operators.features import LIVE_CONFIG, doc_terms, term_statistics
    return term_statistics(doc_terms(_processed(spark, sf_dir), "cleaned_text", LIVE_CONFIG, ["doc_id"]))


@register("prune_vocabulary", f"WITH {FEAT_SRC}, {features_ctes('src')} "
                              "SELECT term, df FROM stats, nd WHERE df >= 2 AND df <= CAST(0.5 AS DOUBLE) * nd.n")
def q_prune(spark, sf_dir):
    from dataclasses import replace
    from ..operators.features import LIVE_CONFIG, doc_terms, prune_vocabulary, term_statistics
    p = _processed(spark, sf_dir)
    n = p.count()
    st = term_statistics(doc_terms(p, "cleaned_text", LIVE_CONFIG, ["doc_id"]))
    return prune_vocabulary(st, replace(LIVE_CONFIG, min_df=2, max_df=0.5), n).select("term", "df")


@register("top_vocabulary", f"WITH {FEAT_SRC}, {features_ctes('src')} SELECT term, term_idx, ctf FROM vocab")
def q_top_vocab(spark, sf_dir):
    return _fit(spark, sf_dir, use_chi2=False).table.select("term", "term_idx", "ctf")


@register("idf", f"WITH {FEAT_SRC}, {features_ctes('src')} SELECT term, round(idf, 6) AS idf FROM vocab")
def q_idf(spark, sf_dir):
    return _fit(spark, sf_dir, use_chi2=False).table.select("term", r6("idf").alias("idf"))


@register("tfidf", f"WITH {FEAT_SRC}, {features_ctes('src')} SELECT doc_id, term, round(value, 6) AS value FROM nw")
def q_tfidf(spark, sf_dir):
    m = _fit(spark, sf_dir, use_chi2=False)
    out = m.transform(_processed(spark, sf_dir), "doc_id")
    return out.select("doc_id", "term", r6("value").alias("value"))


@register("chi2_scores", f"WITH {FEAT_SRC}, {features_ctes('src')}, {chi2_ctes('src')} "
                         "SELECT term, round(score, 6) AS score FROM chi")
def q_chi2(spark, sf_dir):
    m = _fit(spark, sf_dir, chi2_k=10 ** 9)
    return m.table.select("term", r6("score").alias("score"))


def mi_ctes(src: str) -> str:
    return f"""
cells AS (SELECT term_idx, round(value, 9) AS v, sentiment, count(*) AS n_vy FROM nw GROUP BY term_idx, v, sentiment),
ny AS (SELECT sentiment, count(*) AS n_y FROM {src} GROUP BY sentiment),
nv AS (SELECT term_idx, v, sum(n_vy) AS n_v FROM cells GROUP BY term_idx, v),
nz AS (SELECT term_idx, sentiment, sum(n_vy) AS nz_y FROM cells GROUP BY term_idx, sentiment),
zero AS (SELECT vv.term_idx, ny.n_y, ny.n_y - coalesce(nz.nz_y, 0) AS n0y, nd.n - vv.df AS n0
         FROM vocab vv CROSS JOIN ny CROSS JOIN nd LEFT JOIN nz ON nz.term_idx = vv.term_idx AND nz.sentiment = ny.sentiment),
parts AS (SELECT c.term_idx, c.n_vy / nd.n * ln(nd.n * c.n_vy / (nv.n_v * ny.n_y)) AS x
          FROM cells c JOIN nv ON c.term_idx = nv.term_idx AND c.v = nv.v JOIN ny ON c.sentiment = ny.sentiment CROSS JOIN nd
          UNION ALL
          SELECT term_idx, CASE WHEN n0y > 0 AND n0 > 0 THEN n0y / nd.n * ln(nd.n * n0y / (n0 * n_y)) ELSE 0 END FROM zero CROSS JOIN nd),
mi AS (SELECT term_idx, greatest(sum(x), 0) AS score FROM parts GROUP BY term_idx)"""


@register("mutual_info_scores", f"WITH {FEAT_SRC}, {features_ctes('src')}, {mi_ctes('src')} "
                                "SELECT v.term, round(coalesce(mi.score, 0), 6) AS score FROM vocab v LEFT JOIN mi ON v.term_idx = mi.term_idx")
def q_mi(spark, sf_dir):
    m = _fit(spark, sf_dir, use_chi2=False, use_mutual_info=True, mutual_info_k=10 ** 9)
    return m.table.select("term", r6("score").alias("score"))


@register("select_k_best", f"""WITH {FEAT_SRC}, {features_ctes('src')}, {chi2_ctes('src')},
top AS (SELECT term_idx, term FROM chi ORDER BY round(score, 9) DESC, term_idx DESC LIMIT 50)
SELECT term, CAST(row_number() OVER (ORDER BY term_idx) - 1 AS INTEGER) AS sel_idx FROM top""")
def q_select(spark, sf_dir):
    return _fit(spark, sf_dir).feature_names().select("term", "sel_idx")


@register("feature_names", f"""WITH {FEAT_SRC}, {features_ctes('src')}, {mi_ctes('src')},
sc AS (SELECT v.term_idx, v.term, coalesce(mi.score, 0) AS score FROM vocab v LEFT JOIN mi ON v.term_idx = mi.term_idx),
top AS (SELECT term_idx, term FROM sc ORDER BY round(score, 9) DESC, term_idx DESC LIMIT 50)
SELECT CAST(row_number() OVER (ORDER BY term_idx) - 1 AS INTEGER) AS sel_idx, term FROM top""")
def q_feature_names(spark, sf_dir):
    """Names after mutual-information selection of 50 terms."""
    return _fit(spark, sf_dir, use_chi2=False, use_mutual_info=True).feature_names()


@register("feature_importance", f"""WITH {FEAT_SRC}, {features_ctes('src', 5000, 2)}, {chi2_ctes('src')}
SELECT term, round(score, 6) AS score FROM chi ORDER BY round(score, 9) DESC, term_idx DESC LIMIT 1000""")
def q_importance(spark, sf_dir):
    """Training preset: 5000 features, min_df 2, 1000 best by chi-square."""
    from ..operators.features import TRAINING_CONFIG, fit
    m = fit(_processed(spark, sf_dir), "cleaned_text", "sentiment", "doc_id", TRAINING_CONFIG)
    return m.importance().select("term", r6("score").alias("score"))


def _split_features_sql() -> str:
    return f"""WITH {FEAT_SRC}, {split_sql('src', SHARE1, SHARE2, 69)},
tr AS (SELECT s.doc_id, s.sentiment, s.cleaned FROM src s JOIN assigned a ON s.doc_id = a.doc_id WHERE a.split = 'train'),
{features_ctes('tr')}, {chi2_ctes('tr')},
top AS (SELECT term_idx FROM chi ORDER BY round(score, 9) DESC, term_idx DESC LIMIT 50),
sel AS (SELECT term_idx, CAST(row_number() OVER (ORDER BY term_idx) - 1 AS INTEGER) AS sel_idx FROM top),
atk AS (SELECT a.split, s.doc_id, {S.vectorizer_tokens('s.cleaned')} AS tk FROM src s JOIN assigned a ON s.doc_id = a.doc_id),
ag AS (SELECT split, doc_id, unnest({S.ngrams_1_2('tk')}) AS term FROM atk),
atf AS (SELECT split, doc_id, term, count(*) AS tf FROM ag GROUP BY split, doc_id, term),
aw AS (SELECT atf.split, atf.doc_id, v.term_idx, atf.tf * v.idf AS w FROM atf JOIN vocab v ON atf.term = v.term),
anw AS (SELECT split, doc_id, term_idx, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM aw)"""


@register("features_for_splits", _split_features_sql() + """
SELECT split, sel.sel_idx, CAST(count(*) AS BIGINT) AS n_docs, round(sum(value), 6) AS total
FROM anw JOIN sel ON anw.term_idx = sel.term_idx GROUP BY split, sel.sel_idx""")
def q_features_for_splits(spark, sf_dir):
    """Fit on the train split only; transform train, test and val."""
    from ..plans.prepare import features_for_splits
    from ..operators.split import stratified_split
    splits = stratified_split(materialize(_processed(spark, sf_dir), "processed"))
    feats, _ = features_for_splits(splits)
    return feats.groupBy("split", "sel_idx").agg(F.count(F.lit(1)).alias("n_docs"), r6(F.sum("value")).alias("total"))


@register("transform_unseen", f"""WITH {FEAT_SRC}, {features_ctes('src')}, {chi2_ctes('src')},
top AS (SELECT term_idx FROM chi ORDER BY round(score, 9) DESC, term_idx DESC LIMIT 50),
u AS (SELECT item_id, {S.clean_text('text')} AS cleaned FROM benchmark),
utk AS (SELECT item_id, {S.vectorizer_tokens('cleaned')} AS tk FROM u),
ug AS (SELECT item_id, unnest({S.ngrams_1_2('tk')}) AS term FROM utk),
utf AS (SELECT item_id, term, count(*) AS tf FROM ug GROUP BY item_id, term),
uw AS (SELECT utf.item_id, v.term_idx, utf.tf * v.idf AS w FROM utf JOIN vocab v ON utf.term = v.term),
unw AS (SELECT item_id, term_idx, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS value FROM uw),
sel AS (SELECT unw.item_id, unw.value FROM unw JOIN top ON unw.term_idx = top.term_idx)
SELECT b.item_id, CAST(count(sel.value) AS BIGINT) AS n_features, round(coalesce(sum(sel.value), 0), 6) AS total
FROM benchmark b LEFT JOIN sel ON b.item_id = sel.item_id GROUP BY b.item_id""")
def q_transform_unseen(spark, sf_dir):
    """Extractor fitted on labelled documents, applied to benchmark passages:
    unknown terms ignored; items with no known term report zero."""
    from ..functions import text as T
    m = _fit(spark, sf_dir)
    bench = table(spark, sf_dir, "benchmark").withColumn("cleaned_text", T.clean_text("text"))
    f = m.transform(bench, "item_id", zeros=True)
    return f.groupBy("item_id").agg(F.count("value").alias("n_features"),
                                    r6(F.coalesce(F.sum("value"), F.lit(0.0))).alias("total"))


@register("feature_vectors", f"""WITH {FEAT_SRC}, {features_ctes('src')}, {chi2_ctes('src')},
top AS (SELECT term_idx FROM chi ORDER BY round(score, 9) DESC, term_idx DESC LIMIT 50),
sel AS (SELECT term_idx, CAST(row_number() OVER (ORDER BY term_idx) - 1 AS INTEGER) AS sel_idx FROM top)
SELECT nw.doc_id, sel.sel_idx, round(nw.value, 6) AS value FROM nw JOIN sel ON nw.term_idx = sel.term_idx""")
def q_vectors(spark, sf_dir):
    """Spark ML vectors, unfolded into their non-zero entries."""
    from pyspark.ml.functions import vector_to_array
    from ..operators.features import feature_vectors
    m = _fit(spark, sf_dir)
    v = feature_vectors(m, _processed(spark, sf_dir), "doc_id")
    return v.select("doc_id", F.posexplode(vector_to_array("features")).alias("sel_idx", "_v")) \
        .where("_v <> 0").select("doc_id", "sel_idx", r6(F.col("_v")).alias("value"))


@register("extractor_roundtrip", f"""WITH {FEAT_SRC}, {features_ctes('src')}, {chi2_ctes('src')},
top AS (SELECT term_idx FROM chi ORDER BY round(score, 9) DESC, term_idx DESC LIMIT 50),
sel AS (SELECT term_idx, CAST(row_number() OVER (ORDER BY term_idx) - 1 AS INTEGER) AS sel_idx FROM top)
SELECT nw.doc_id, sel.sel_idx, round(nw.value, 6) AS value FROM nw JOIN sel ON nw.term_idx = sel.term_idx""")
def q_roundtrip(spark, sf_dir):
    """Fit, save the model table to the shared checkpoint folder, load it
    back and transform."""
    import uuid
    from ..operators.features import FeatureModel
    from ..session import scratch_path
    m = _fit(spark, sf_dir)
    path = scratch_path(spark, f"extractor-{uuid.uuid4().hex}")
    m.save(path)
    m2 = FeatureModel.load(spark, path)
    out = m2.transform(_processed(spark, sf_dir), "doc_id")
    return out.select("doc_id", "sel_idx", r6("value").alias("value"))


@register("label_map_roundtrip", "SELECT source AS label, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS label_idx "
                                 "FROM (SELECT DISTINCT source FROM documents)")
def q_label_roundtrip(spark, sf_dir):
    import uuid
    from ..operators.labels import label_mapping, load_label_mapping, save_label_mapping
    from ..session import scratch_path
    path = scratch_path(spark, f"labelmap-{uuid.uuid4().hex}")
    save_label_mapping(label_mapping(table(spark, sf_dir, "documents"), "source"), path)
    return load_label_mapping(spark, path)


# ---------------------------------------------------------------------------
# G: tracking log
# ---------------------------------------------------------------------------

LOG_SQL = """SELECT CAST(user_id AS VARCHAR) AS dataset, event_id AS seq, ts,
  CASE WHEN event_type = 'signup' THEN 'split_params' ELSE event_type END AS artifact_type,
  CASE WHEN event_type = 'signup' THEN '{"train_size": 0.7, "test_size": 0.2, "val_size": 0.1, "random_state": '
       || CAST(CAST(floor(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 50) AS BIGINT) AS VARCHAR) || '}'
       ELSE 'event-' || CAST(event_id AS VARCHAR) END AS value,
  CAST(floor(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 50) AS BIGINT) AS cur_seed
FROM events"""

EXP_SQL = f"""
lg AS ({LOG_SQL}),
a AS (SELECT *, coalesce(count(*) FILTER (WHERE artifact_type = 'split_params') OVER w1, 0) AS g,
             last_value(CASE WHEN artifact_type = 'split_params' THEN value END IGNORE NULLS) OVER w1 AS v
      FROM lg WINDOW w1 AS (PARTITION BY dataset ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, CASE WHEN v IS NOT NULL AND v <> '' AND
                  CAST(json_extract(v, '$.random_state') AS BIGINT) IS DISTINCT FROM cur_seed THEN 1 ELSE 0 END AS d FROM a),
c AS (SELECT *, coalesce(sum(d) OVER (PARTITION BY dataset, g ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS db FROM b),
e AS (SELECT dataset, seq, ts, artifact_type, value,
             CAST(sum(CASE WHEN d = 1 AND db = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY dataset ORDER BY ts, seq
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS exp_id FROM c)"""


def _log(spark, sf_dir):
    from ..operators.tracking import events_as_log
    return events_as_log(table(spark, sf_dir, "events"))


@register("artifact_log", """SELECT CAST(user_id AS VARCHAR) AS dataset, event_id AS seq, ts,
  CASE WHEN event_type = 'signup' THEN 'split_params' ELSE event_type END AS artifact_type,
  CASE WHEN event_type = 'signup' THEN pj ELSE 'event-' || CAST(event_id AS VARCHAR) END AS value, pj AS params
FROM (SELECT *, '{"train_size": 0.7, "test_size": 0.2, "val_size": 0.1, "random_state": '
      || CAST(CAST(floor(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 50) AS BIGINT) AS VARCHAR) || '}' AS pj FROM events)""")
def q_artifact_log(spark, sf_dir):
    """Append the derived log to a table in the shared folder and read it back."""
    import uuid
    from ..session import scratch_path
    path = scratch_path(spark, f"log-{uuid.uuid4().hex}")
    from ..operators.tracking import append_log
    append_log(_log(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("experiment_ids", f"WITH {EXP_SQL} SELECT dataset, seq, exp_id FROM e")
def q_exp_ids(spark, sf_dir):
    from ..operators.tracking import experiment_ids
    return experiment_ids(_log(spark, sf_dir)).select("dataset", "seq", "exp_id")


def _slot_log(spark, sf_dir):
    """The derived log with its other artifacts spread over all eleven slots."""
    from ..operators.tracking import SLOTS
    others = [t for t in SLOTS if t != "split_params"]
    slot = F.element_at(F.array(*[F.lit(t) for t in others]), (F.pmod("seq", F.lit(len(others))) + 1).cast("int"))
    return _log(spark, sf_dir).withColumn(
        "artifact_type", F.when(F.col("artifact_type") == "split_params", "split_params").otherwise(slot))


def _slot_sql():
    from ..operators.tracking import SLOTS
    others = [t for t in SLOTS if t != "split_params"]
    kind = (f"CASE WHEN artifact_type = 'split_params' THEN 'split_params' ELSE "
            f"{others}[CAST(seq % {len(others)} AS INTEGER) + 1] END")
    last = ", ".join(f"arg_max(CASE WHEN slot = '{t}' THEN value END, CASE WHEN slot = '{t}' THEN (ts, seq) END) AS {t}"
                     for t in SLOTS)
    return f"s AS (SELECT *, {kind} AS slot FROM e) SELECT dataset, exp_id, min(ts) AS created_at, {last} FROM s GROUP BY dataset, exp_id"


@register("experiment_index", f"WITH {EXP_SQL}, {_slot_sql()}")
def q_exp_index(spark, sf_dir):
    from ..operators.tracking import experiment_index
    return experiment_index(_slot_log(spark, sf_dir))


@register("dataset_experiments", f"WITH {EXP_SQL} SELECT DISTINCT exp_id FROM e WHERE dataset = '7'")
def q_dataset_exps(spark, sf_dir):
    from ..operators.tracking import dataset_experiments, experiment_index
    return dataset_experiments(experiment_index(_log(spark, sf_dir)), "7").select("exp_id")


@register("list_datasets", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS dataset FROM events")
def q_list_datasets(spark, sf_dir):
    from ..operators.tracking import list_datasets
    return list_datasets(_log(spark, sf_dir))


@register("get_params", f"""WITH {EXP_SQL},
ix AS (SELECT dataset, exp_id, arg_max(CASE WHEN artifact_type = 'split_params' THEN value END,
                                       CASE WHEN artifact_type = 'split_params' THEN ts END) AS sp FROM e GROUP BY dataset, exp_id)
SELECT dataset, exp_id, CAST(json_extract(sp, '$.random_state') AS BIGINT) AS random_state,
       CAST(json_extract(sp, '$.train_size') AS DOUBLE) AS train_size FROM ix""")
def q_get_params(spark, sf_dir):
    from ..operators.tracking import experiment_index, get_params
    p = get_params(experiment_index(_log(spark, sf_dir)))
    return p.select("dataset", "exp_id", F.col("split_params.random_state").alias("random_state"),
                    F.col("split_params.train_size").alias("train_size"))


# ---------------------------------------------------------------------------
# H: run log and registry
# ---------------------------------------------------------------------------

def _runs(spark, sf_dir):
    from ..operators.runs import events_as_runs
    return events_as_runs(table(spark, sf_dir, "events"))


RUNS_SQL = """SELECT event_type AS experiment, CAST(event_id AS VARCHAR) AS run_id, 'user_' || CAST(user_id AS VARCHAR) AS run_name,
  ts AS start_time, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS f1, json_extract_string(props, '$.k') AS k FROM events"""


@register("run_log", """SELECT CAST(event_id AS VARCHAR) AS run_id, 'param' AS kind, 'm_k' AS key, json_extract_string(props, '$.k') AS value FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), 'metric', 'f1', CAST(value AS VARCHAR) FROM events WHERE event_type <> 'error'
UNION ALL SELECT CAST(event_id AS VARCHAR), 'tag', 'user', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), 'artifact', '0', 'event-' || CAST(event_id AS VARCHAR) FROM events""")
def q_run_log(spark, sf_dir):
    from ..operators.runs import run_log_long
    return run_log_long(_runs(spark, sf_dir))


@register("run_artifacts", """SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS artifact FROM events
WHERE event_type <> 'error' AND event_type IS NOT NULL""")
def q_run_artifacts(spark, sf_dir):
    """Runs name the folder of their event type; only some folders were written."""
    from ..operators.runs import artifact_listing, run_log_long
    p = _scratch(spark, "artifacts")
    events = table(spark, sf_dir, "events")
    events.where("event_type <> 'error'").select("event_type", "value").write.partitionBy("event_type").parquet(p)
    at = F.concat(F.lit(p + "/event_type="), F.col("experiment"))
    runs = _runs(spark, sf_dir).withColumn("artifacts", F.array(at, F.concat(at, F.lit("-missing"))))
    log = run_log_long(runs, artifact_listing(spark, p)).where("kind = 'artifact'")
    return log.select("run_id", F.substring_index("value", "=", -1).alias("artifact"))


@register("experiments", """SELECT experiment, created, CAST(row_number() OVER (ORDER BY created, experiment) - 1 AS INTEGER) AS experiment_id
FROM (SELECT event_type AS experiment, min(ts) AS created FROM events GROUP BY event_type)""")
def q_experiments(spark, sf_dir):
    from ..operators.runs import experiments
    return experiments(_runs(spark, sf_dir))


@register("get_or_create_experiments", """SELECT DISTINCT experiment FROM (
  SELECT event_type AS experiment FROM events UNION ALL SELECT 'new-' || CAST(user_id % 3 AS VARCHAR) FROM events)
WHERE experiment NOT IN (SELECT event_type FROM events)""")
def q_get_or_create(spark, sf_dir):
    """Requested names (known ones and new ones) reduced to those to be created."""
    from ..operators.runs import experiments, get_or_create
    runs = _runs(spark, sf_dir)
    new = table(spark, sf_dir, "events").select(F.concat(F.lit("new-"), (F.col("user_id") % 3).cast("string")).alias("experiment"))
    return get_or_create(experiments(runs), runs.select("experiment").unionByName(new))


@register("experiment_runs", f"SELECT run_id, run_name, start_time FROM ({RUNS_SQL}) WHERE experiment = 'purchase'")
def q_exp_runs(spark, sf_dir):
    from ..operators.runs import experiment_runs
    return experiment_runs(_runs(spark, sf_dir), "purchase")


COMPARE_SQL = f"""r AS ({RUNS_SQL}),
k AS (SELECT run_name, arg_min(run_id, (start_time, run_id)) AS run_id FROM r WHERE experiment = '{{exp}}' GROUP BY run_name),
c AS (SELECT r.run_name, r.run_id, coalesce(r.f1, 0.0) AS metric_value, r.k AS param_k, r.f1 AS metric_f1 FROM r JOIN k ON r.run_id = k.run_id AND r.run_name = k.run_name)
SELECT run_name, run_id, metric_value, param_k, metric_f1, CAST(row_number() OVER (ORDER BY metric_value DESC, run_name) AS INTEGER) AS rank FROM c"""


def _flat(compared):
    """Compared runs with the parameter and metric of the derived log as columns."""
    return compared.select("run_name", "run_id", "metric_value", F.col("params")["m_k"].alias("param_k"),
                           F.col("metrics")["f1"].alias("metric_f1"), "rank")


@register("compare_runs", "WITH " + COMPARE_SQL.replace("{exp}", "click"))
def q_compare(spark, sf_dir):
    from ..operators.runs import compare_runs
    return _flat(compare_runs(_runs(spark, sf_dir), "click"))


@register("best_run", "SELECT * FROM (WITH " + COMPARE_SQL.replace("{exp}", "error") + ") WHERE rank = 1")
def q_best(spark, sf_dir):
    """Missing metric on every run: all 0.0, best by name order."""
    from ..operators.runs import best_run, compare_runs
    return _flat(best_run(compare_runs(_runs(spark, sf_dir), "error")))


@register("retain_last_runs", f"""SELECT experiment, run_id, start_time FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rn FROM ({RUNS_SQL})) WHERE rn > 10""")
def q_retain(spark, sf_dir):
    from ..operators.runs import retain_last_runs
    return retain_last_runs(_runs(spark, sf_dir), 10)


@register("remove_old_runs", f"""SELECT experiment, run_id, run_name, start_time FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rn FROM ({RUNS_SQL})) WHERE rn <= 10""")
def q_remove_old(spark, sf_dir):
    """Runs logged to a stored log, old ones removed, the log read back."""
    from ..operators.runs import log_runs, read_runs, remove_old_runs
    p = _scratch(spark, "run-log")
    log_runs(_runs(spark, sf_dir), p)
    remove_old_runs(spark, p, 10)
    return read_runs(spark, p).select("experiment", "run_id", "run_name", "start_time")


REG_SQL = """SELECT 'model_' || event_type AS name, CAST(event_id AS VARCHAR) AS run_id, ts,
  ['Staging', 'Production', 'Archived'][CAST(((floor(value) % 3) + 3) % 3 AS INTEGER) + 1] AS stage
FROM events WHERE event_type IN ('purchase', 'signup')"""
VERS_SQL = f"SELECT *, CAST(row_number() OVER (PARTITION BY name ORDER BY ts, run_id) AS INTEGER) AS version FROM ({REG_SQL})"


@register("model_versions", f"SELECT name, run_id, stage, version FROM ({VERS_SQL})")
def q_versions(spark, sf_dir):
    from ..operators.runs import events_as_registrations, model_versions
    return model_versions(events_as_registrations(table(spark, sf_dir, "events"))).select("name", "run_id", "stage", "version")


@register("latest_stage_version", f"SELECT name, stage, max(version) AS version, arg_max(run_id, version) AS run_id FROM ({VERS_SQL}) GROUP BY name, stage")
def q_latest(spark, sf_dir):
    from ..operators.runs import events_as_registrations, latest_stage_version, model_versions
    return latest_stage_version(model_versions(events_as_registrations(table(spark, sf_dir, "events"))))


# ---------------------------------------------------------------------------
# I: evaluation and training
# ---------------------------------------------------------------------------

PRED_SQL = ("SELECT d.doc_id, l.quality AS label, (d.n_chars % 997) / 997.0 AS score, "
            "CAST((d.n_chars % 997) / 997.0 >= 0.5 AS INTEGER) AS prediction FROM documents d JOIN labels l ON d.doc_id = l.doc_id")


def _pred(spark, sf_dir):
    from ..operators.evaluation import predictions_from_docs
    return predictions_from_docs(table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id"))


@register("confusion_matrix", f"SELECT label, prediction, CAST(count(*) AS BIGINT) AS n FROM ({PRED_SQL}) GROUP BY label, prediction")
def q_confusion(spark, sf_dir):
    from ..operators.evaluation import confusion_matrix
    return confusion_matrix(_pred(spark, sf_dir))


METRICS_SQL = f"""m AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = prediction) AS ok,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn FROM ({PRED_SQL})),
mm AS (SELECT ok / n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM m)"""


@register("classification_metrics", f"WITH {METRICS_SQL} SELECT * FROM mm")
def q_metrics(spark, sf_dir):
    from ..operators.evaluation import classification_metrics
    return classification_metrics(_pred(spark, sf_dir))


@register("roc_auc", f"""WITH p AS ({PRED_SQL}),
per AS (SELECT score AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM p GROUP BY score),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM per)
SELECT sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc FROM r""")
def q_auc(spark, sf_dir):
    from ..operators.evaluation import roc_auc
    return roc_auc(_pred(spark, sf_dir))


@register("threshold_gate", f"""WITH {METRICS_SQL}
SELECT 'accuracy' AS metric, accuracy AS value, 0.8::DOUBLE AS threshold, accuracy >= 0.8 AS passed FROM mm
UNION ALL SELECT 'f1', f1, 0.8::DOUBLE, f1 >= 0.8 FROM mm
UNION ALL SELECT 'precision', precision, 0.75::DOUBLE, precision >= 0.75 FROM mm
UNION ALL SELECT 'recall', recall, 0.75::DOUBLE, recall >= 0.75 FROM mm""")
def q_gate(spark, sf_dir):
    from ..operators.evaluation import classification_metrics, threshold_gate
    return threshold_gate(classification_metrics(_pred(spark, sf_dir)))


def _ml_data(spark, sf_dir):
    """(doc_id, features vector, label double, split, fold) on labelled docs.
    Texts are cleaned once and their n-grams counted once; both are stored."""
    from ..operators.features import feature_vectors
    from ..operators.split import stratified_folds, stratified_split
    from ..plans.prepare import fit_on_train
    p = _stored_docs(spark, sf_dir)
    s = materialize(stratified_split(p), "split")
    terms, model = fit_on_train(s)
    v = feature_vectors(model, s, "doc_id", terms=terms)
    folds = stratified_folds(p.select("doc_id", "sentiment"), 5).select("doc_id", "fold")
    return (s.select("doc_id", "split", F.col("sentiment").cast("double").alias("label"))
             .join(v, "doc_id").join(folds, "doc_id"))


def _train_eval(spark, sf_dir, make):
    """Metrics on the test rows. The fit reads a stored table in as many
    partitions as its rows ask for: every step of a fit is a job over them."""
    from ..operators.training import evaluate, fit_table
    d = fit_table(_ml_data(spark, sf_dir))
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    n = train.count()
    model = make(n).fit(train)
    out = evaluate(model, test)
    return out


@register("train_lr")
def q_train_lr(spark, sf_dir):
    from ..operators.training import logistic_regression
    return _train_eval(spark, sf_dir, lambda n: logistic_regression(n, 1.0, 1000))


@register("train_rf")
def q_train_rf(spark, sf_dir):
    from ..operators.training import random_forest
    return _train_eval(spark, sf_dir, lambda n: random_forest(100, 10))


@register("train_svc")
def q_train_svc(spark, sf_dir):
    from ..operators.training import linear_svc
    return _train_eval(spark, sf_dir, lambda n: linear_svc(n, 1.0))


@register("train_gbt")
def q_train_gbt(spark, sf_dir):
    from ..operators.training import gradient_boosting
    return _train_eval(spark, sf_dir, lambda n: gradient_boosting(100, 0.1, 5))


@register("train_nb", _split_features_sql() + """,
trf AS (SELECT anw.doc_id, sel.sel_idx, anw.value, a.sentiment FROM anw JOIN sel ON anw.term_idx = sel.term_idx
        JOIN assigned a ON a.doc_id = anw.doc_id WHERE anw.split = 'train'),
cls AS (SELECT sentiment, count(*) AS n_c FROM assigned WHERE split = 'train' GROUP BY sentiment),
nsel AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM sel),
fc AS (SELECT sentiment, sel_idx, sum(value) AS fc FROM trf GROUP BY sentiment, sel_idx),
tot AS (SELECT cls.sentiment, coalesce(sum(fc.fc), 0) + 1.0 * (SELECT n FROM nsel) AS denom
        FROM cls LEFT JOIN fc ON cls.sentiment = fc.sentiment GROUP BY cls.sentiment),
nbp AS (SELECT cls.sentiment, ln(n_c / (SELECT sum(n_c) FROM cls)) AS lp, ln(1.0 / tot.denom) AS lu
        FROM cls JOIN tot ON cls.sentiment = tot.sentiment),
lik AS (SELECT fc.sentiment, fc.sel_idx, ln((fc.fc + 1.0) / tot.denom) AS lk FROM fc JOIN tot ON fc.sentiment = tot.sentiment),
te AS (SELECT doc_id, sentiment AS label FROM assigned WHERE split = 'test'),
tef AS (SELECT anw.doc_id, sel.sel_idx, anw.value FROM anw JOIN sel ON anw.term_idx = sel.term_idx WHERE anw.split = 'test'),
xs AS (SELECT doc_id, sum(value) AS x FROM tef GROUP BY doc_id),
seen AS (SELECT tef.doc_id, lik.sentiment, sum(tef.value * (lik.lk - nbp.lu)) AS sv FROM tef JOIN lik ON tef.sel_idx = lik.sel_idx
         JOIN nbp ON nbp.sentiment = lik.sentiment GROUP BY tef.doc_id, lik.sentiment),
sc AS (SELECT te.doc_id, te.label, nbp.sentiment AS c, nbp.lp + coalesce(xs.x, 0) * nbp.lu + coalesce(seen.sv, 0) AS score
       FROM te CROSS JOIN nbp LEFT JOIN xs ON xs.doc_id = te.doc_id
       LEFT JOIN seen ON seen.doc_id = te.doc_id AND seen.sentiment = nbp.sentiment)
SELECT doc_id, label, arg_max(c, (score, -c)) AS prediction FROM sc GROUP BY doc_id, label""")
def q_train_nb(spark, sf_dir):
    """Relational multinomial naive Bayes on the selected TF-IDF features:
    fit on train, (doc_id, label, prediction) on test."""
    from ..operators.split import stratified_split
    from ..operators.training import naive_bayes_fit, naive_bayes_predict
    from ..plans.prepare import features_for_splits
    s = stratified_split(materialize(_processed(spark, sf_dir), "processed")).persist()
    feats, model = features_for_splits(s)
    lab = s.select("doc_id", F.col("sentiment").alias("label"), "split")
    tr = feats.where("split = 'train'")
    classes, lik = naive_bayes_fit(tr, lab.where("split = 'train'"), n_features=model.n_selected)
    te_docs = lab.where("split = 'test'")
    pred = naive_bayes_predict(feats.where("split = 'test'"), te_docs, classes, lik)
    return te_docs.join(pred, "doc_id").select("doc_id", "label", "prediction")


def _stored_docs(spark, sf_dir):
    """(doc_id, sentiment, cleaned_text) of processed labelled documents, written once."""
    from ..operators.cleaning import process_data
    p = process_data(labelled_docs(spark, sf_dir), timestamp=False)
    return materialize(p.select("doc_id", "sentiment", "cleaned_text"), "processed")


def _fold_docs(spark, sf_dir, k):
    """Processed labelled documents outside the test split with stratified folds."""
    from ..operators.split import stratified_folds, stratified_split
    s = stratified_split(_stored_docs(spark, sf_dir)).where("split <> 'test'")
    return materialize(stratified_folds(s.select("doc_id", "sentiment", "cleaned_text"), k), "folds")


@register("cross_validate")
def q_cv(spark, sf_dir):
    """F1 of each fold, with features fitted on the other folds."""
    from ..operators.training import cross_validate_text
    scores = cross_validate_text(_fold_docs(spark, sf_dir, 5), num_folds=5)
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(scores)], "fold int, f1 double")


def _search(spark, sf_dir, candidates):
    """Mean F1 over the declared stratified folds for each candidate, a
    (family, params) of the search space; ``params`` as JSON."""
    import json
    from ..functions import constants as K
    from ..operators.training import search
    avg = search(_fold_docs(spark, sf_dir, K.SEARCH_FOLDS), candidates)
    return spark.createDataFrame([(i, f, json.dumps(c), x) for i, ((f, c), x) in enumerate(zip(candidates, avg))],
                                 "candidate int, family string, params string, avg_f1 double")


@register("grid_search")
def q_grid(spark, sf_dir):
    """Every candidate of every declared family."""
    from ..operators.training import search_space
    return _search(spark, sf_dir, search_space())


@register("random_search")
def q_random(spark, sf_dir):
    """The declared number of draws from all families' candidates together."""
    from ..operators.training import random_draws, search_space
    return _search(spark, sf_dir, random_draws(search_space()))


# ---------------------------------------------------------------------------
# A: sources and sinks (files written to the shared folder, read back)
# ---------------------------------------------------------------------------

def _scratch(spark, name):
    import uuid
    from ..session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("scan_json", "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents")
def q_scan_json(spark, sf_dir):
    from ..sources.readers import scan_json
    from ..sources.writers import write_json
    p = _scratch(spark, "json")
    write_json(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text"), p)
    d = scan_json(spark, p, "doc_id bigint, lang string, source string, n_chars bigint, text string")
    return d.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


@register("scan_json_columns", "SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS total FROM events GROUP BY event_type")
def q_scan_json_columns(spark, sf_dir):
    """Column-form JSON: objects of arrays (a thousand events each), zipped back."""
    from ..sources.readers import scan_json_columns
    p = _scratch(spark, "jsoncols")
    ev = table(spark, sf_dir, "events")
    (ev.groupBy(F.floor(F.col("event_id") / 1000).alias("part"))
       .agg(F.collect_list(F.struct("event_id", "value")).alias("e"))
       .select("e.event_id", "e.value").write.json(p))
    rows = scan_json_columns(spark, p, ["event_id", "value"], "event_id bigint, value double", multiline=False)
    return (ev.select("event_id", "event_type").join(rows, "event_id")
              .groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("value")).alias("total")))


def _write_two_encodings(spark, sf_dir, p):
    """German and French rows that ISO-8859-1 can hold go to its folder, all
    others (also those of unknown language) to the UTF-8 one."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    text = F.concat_ws(" ", "lang", "source", "text")
    latin1 = F.coalesce(F.col("lang").isin("de", "fr"), F.lit(False)) & ~text.rlike("[^\\u0000-\\u00ff]")
    d.where(latin1).write.option("header", True).option("escape", '"').option("encoding", "ISO-8859-1").csv(p + "/latin1")
    d.where(~latin1).write.option("header", True).option("escape", '"').csv(p + "/utf8")


@register("scan_csv", "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents")
def q_scan_csv(spark, sf_dir):
    from ..sources.readers import scan_csv
    p = _scratch(spark, "csv")
    _write_two_encodings(spark, sf_dir, p)
    d = scan_csv(spark, [p + "/latin1", p + "/utf8"], "doc_id bigint, lang string, source string, text string")
    return d.select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@register("scan_csv_split", """SELECT doc_id, lang, source, md5(replace(text, ' the ', chr(10) || '"the", ')) AS text_md5 FROM documents""")
def q_scan_csv_split(spark, sf_dir):
    """Texts with quoted line breaks, quotes and commas, each file read in splits."""
    from ..sources.readers import scan_csv_split
    p = _scratch(spark, "csv-split")
    broken = F.replace("text", F.lit(" the "), F.lit('\n"the", '))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", broken.alias("text"))
    docs.write.option("header", True).option("escape", '"').csv(p)
    d = scan_csv_split(spark, p, "doc_id bigint, lang string, source string, text string")
    return d.select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@register("detect_encoding", """SELECT DISTINCT CASE WHEN lang IN ('de', 'fr') THEN 'latin1' ELSE 'utf8' END AS folder,
  CASE WHEN lang IN ('de', 'fr') THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding FROM documents""")
def q_detect(spark, sf_dir):
    from ..sources.readers import detect_encoding
    p = _scratch(spark, "enc")
    _write_two_encodings(spark, sf_dir, p)
    found = detect_encoding(spark, [p + "/latin1", p + "/utf8"])
    return found.select(F.element_at(F.split("file_path", "/"), -2).alias("folder"), "encoding").distinct()


@register("write_json", f"SELECT doc_id, sentiment, cleaned AS cleaned_text FROM ({processed_sql(LABELLED_DOCS_SQL)})")
def q_write_json(spark, sf_dir):
    from ..sources.writers import write_json
    p = _scratch(spark, "wjson")
    write_json(_processed(spark, sf_dir).select("doc_id", "sentiment", "cleaned_text"), p)
    return spark.read.schema("doc_id bigint, sentiment int, cleaned_text string").json(p)


@register("write_processed", f"SELECT doc_id, sentiment, cleaned AS cleaned_text, text_length FROM ({processed_sql(LABELLED_DOCS_SQL)})")
def q_write_processed(spark, sf_dir):
    from ..sources.writers import write_processed
    p = _scratch(spark, "wproc")
    write_processed(_processed(spark, sf_dir).select("doc_id", "sentiment", "cleaned_text", "text_length"), p, "csv")
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
                 .schema("doc_id bigint, sentiment int, cleaned_text string, text_length int").csv(p))


@register("write_splits", f"WITH {SPLIT_SRC}, {split_sql('src', SHARE1, SHARE2, 69)} "
                          "SELECT doc_id, split FROM assigned")
def q_write_splits(spark, sf_dir):
    from ..operators.split import stratified_split
    from ..sources.writers import write_splits
    p = _scratch(spark, "wsplit")
    write_splits(stratified_split(_split_input(spark, sf_dir)), p)
    return spark.read.parquet(p).select("doc_id", "split")


@register("load_process_save", f"SELECT doc_id, sentiment, cleaned AS cleaned_text, text_length FROM ({processed_sql(LANG_DOCS_SQL)})")
def q_load_process_save(spark, sf_dir):
    """Raw JSON to a stored processed table, read back."""
    from ..sources.writers import write_json
    from .prepare import load_process_save
    raw = _scratch(spark, "raw")
    docs = lang_docs(spark, sf_dir).select("doc_id", "text", "sentiment")
    write_json(docs, raw)
    out = load_process_save(spark, raw, _scratch(spark, "processed"), schema=docs._jdf.schema().toDDL())
    return out.select("doc_id", "sentiment", "cleaned_text", "text_length")


@register("load_and_validate", f"SELECT doc_id, sentiment, text_length FROM ({processed_sql(LABELLED_DOCS_SQL)})")
def q_load_and_validate(spark, sf_dir):
    """A stored processed table that passes the quality checks."""
    from .prepare import load_and_validate
    p = _scratch(spark, "validated")
    _processed(spark, sf_dir).write.parquet(p)
    return load_and_validate(spark, p).select("doc_id", "sentiment", "text_length")


@register("write_splits_json", f"WITH {SPLIT_SRC}, {split_sql('src', SHARE1, SHARE2, 69)} "
                               "SELECT doc_id, split FROM assigned")
def q_write_splits_json(spark, sf_dir):
    """Splits as JSON, one folder each, read back by the JSON scan."""
    from ..operators.split import stratified_split
    from ..sources.readers import scan_json
    from ..sources.writers import write_splits
    p = _scratch(spark, "jsplit")
    write_splits(stratified_split(_split_input(spark, sf_dir)), p, fmt="json")
    return scan_json(spark, p, "doc_id bigint, split string").select("doc_id", "split")


@register("write_features", _split_features_sql() + """
SELECT split, doc_id, sel.sel_idx, round(value, 6) AS value FROM anw JOIN sel ON anw.term_idx = sel.term_idx""")
def q_write_features(spark, sf_dir):
    from ..operators.split import stratified_split
    from ..sources.writers import write_features
    from .prepare import features_for_splits
    p = _scratch(spark, "wfeat")
    feats, _ = features_for_splits(stratified_split(materialize(_processed(spark, sf_dir), "processed")).persist())
    write_features(feats, p)
    return spark.read.parquet(p).select("split", "doc_id", "sel_idx", r6(F.col("value")).alias("value"))


def _sample_sql():
    from ..functions import constants as K
    d = "md5('42:' || CAST(doc_id AS VARCHAR))"
    digit = "(strpos('0123456789abcdef', substr({}, {}, 1)) - 1)"
    coin, pick = digit.format(d, 1) + " % 2", digit.format(d, 2) + " % 8 + 1"
    return (f"SELECT doc_id AS id, CASE WHEN {coin} = 0 THEN {S.str_list(K.SAMPLE_POSITIVE)}[{pick}] "
            f"ELSE {S.str_list(K.SAMPLE_NEGATIVE)}[{pick}] END AS text, "
            f"CASE WHEN {coin} = 0 THEN 1 ELSE 0 END AS sentiment FROM documents")


@register("sample_data", _sample_sql())
def q_sample(spark, sf_dir):
    """Synthetic labelled rows, one per document id."""
    from ..sources.readers import sample_data
    return sample_data(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))).drop("created_at")


@register("prep_summary", _split_features_sql() + f"""
SELECT 'raw_rows' AS stage, CAST(count(*) AS BIGINT) AS value FROM ({LABELLED_DOCS_SQL})
UNION ALL SELECT 'processed_rows', count(*) FROM src
UNION ALL SELECT 'train_rows', count(*) FILTER (WHERE split = 'train') FROM assigned
UNION ALL SELECT 'test_rows', count(*) FILTER (WHERE split = 'test') FROM assigned
UNION ALL SELECT 'val_rows', count(*) FILTER (WHERE split = 'val') FROM assigned
UNION ALL SELECT 'num_features', count(*) FROM sel""")
def q_prep_summary(spark, sf_dir):
    """The whole flow (scan -> clean -> split -> features -> tracking) into the
    shared folder; one row per stage."""
    from .prepare import prepare
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id") \
        .select("doc_id", F.col("text").alias("body"), F.col("quality").alias("y"))
    return prepare(spark, d, _scratch(spark, "prep"), "documents", "body", "y", map_labels=True)


# ---------------------------------------------------------------------------
# Streaming
# ---------------------------------------------------------------------------

@register("stream_clean_text", f"SELECT doc_id, cleaned AS cleaned_text, text_length FROM ("
                               f"SELECT doc_id, {S.clean_text(S.lowercase('text'))} AS cleaned, "
                               f"CAST(length({S.clean_text(S.lowercase('text'))}) AS INTEGER) AS text_length FROM documents "
                               f"WHERE text IS NOT NULL AND NOT ({S.is_blank(S.lowercase('text'))})) WHERE length(cleaned) > 0")
def q_stream_clean(spark, sf_dir):
    """documents read as a file stream, cleaned with the same column
    functions, written by an available-now trigger, read back."""
    from ..streaming.featurize import clean_stream, document_stream, run_available
    out, ck = _scratch(spark, "stream-out"), _scratch(spark, "stream-ck")
    s = clean_stream(document_stream(spark, sf_dir)).select("doc_id", "cleaned_text", "text_length")
    run_available(spark, s, out, ck)
    return spark.read.parquet(out)


@register("stream_features", f"""WITH {FEAT_SRC}, {features_ctes('src')}, {chi2_ctes('src')},
top AS (SELECT term_idx FROM chi ORDER BY round(score, 9) DESC, term_idx DESC LIMIT 50),
u AS (SELECT doc_id, cleaned FROM ({processed_sql(LANG_DOCS_SQL)})),
utk AS (SELECT doc_id, {S.vectorizer_tokens('cleaned')} AS tk FROM u),
ug AS (SELECT doc_id, unnest({S.ngrams_1_2('tk')}) AS term FROM utk),
utf AS (SELECT doc_id, term, count(*) AS tf FROM ug GROUP BY doc_id, term),
uw AS (SELECT utf.doc_id, v.term_idx, utf.tf * v.idf AS w FROM utf JOIN vocab v ON utf.term = v.term),
unw AS (SELECT doc_id, term_idx, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM uw)
SELECT unw.doc_id, CAST(count(*) AS BIGINT) AS n_features, round(sum(value), 6) AS total
FROM unw JOIN top ON unw.term_idx = top.term_idx GROUP BY unw.doc_id""")
def q_stream_features(spark, sf_dir):
    """Extractor fitted on labelled documents; every document streamed
    through cleaning and extractor batch by batch (foreachBatch), features
    read back."""
    from ..streaming.featurize import clean_batch, document_stream, featurize_batches
    m = _fit(spark, sf_dir)
    out, ck = _scratch(spark, "fstream-out"), _scratch(spark, "fstream-ck")
    s = document_stream(spark, sf_dir).select("doc_id", "text")
    q = (s.writeStream.foreachBatch(featurize_batches(m, "doc_id", out, ck, clean_batch))
          .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    f = spark.read.parquet(out)
    return f.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_features"), r6(F.sum("value")).alias("total"))
