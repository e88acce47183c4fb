"""Quality classifier: nearest-neighbour voting in a latent semantic space.

Terms of a text are the three-character shapes of its bytes (letter case,
vowel or consonant, digits, single punctuation marks, white space) and how
often its words, word pairs and lines repeat: a vocabulary of fixed size that
speaks of form in any language. Square-root counts times inverse document
frequency (over all documents) are projected by a truncated SVD of the
labelled sample. The labelled vectors are broadcast; every document is
multiplied with all of them, block by block, and the labels of its nearest
ones vote with weights that fall with cosine distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlathe.llm.common import id_text

CLASSES = 32
GRAMS = CLASSES ** 3
EXTRA = 6   # repetition terms behind the shape terms
TERMS = GRAMS + EXTRA
_PIECE = 1 << 20  # bytes counted at a time


def _byte_classes() -> np.ndarray:
    """Class of each byte. Other letters and controls share a class; UTF-8
    lead and continuation bytes have one each."""
    c = np.full(256, 31, dtype=np.uint16)
    c[[ord(x) for x in "bcdfghjklmnpqrstvwxyz"]] = 1
    c[[ord(x) for x in "aeiou"]] = 2
    c[65:91] = 3
    c[48:58] = 4
    c[[32, 9]] = 5
    c[[10, 13]] = 6
    for i, x in enumerate(".,;:!?'\"()-*#$%&|@/_<=>"):
        c[ord(x)] = 7 + i
    c[128:192] = 30
    c[192:] = 0
    return c


_CLASS = _byte_classes()


def term_counts(text: str | None) -> np.ndarray:
    """Counts of all ``TERMS`` terms of one whole text (null: empty)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(TERMS)
    codes = np.frombuffer(raw, dtype=np.uint8)
    for i in range(0, max(len(codes) - 2, 0), _PIECE):
        c = _CLASS[codes[i:i + _PIECE + 2]]
        out[:GRAMS] += np.bincount((c[:-2] << 10) | (c[1:-1] << 5) | c[2:], minlength=GRAMS)
    words = raw.split()
    lines = raw.split(b"\n")
    following = words[1:]
    out[GRAMS:] = (1.0,  # every text has this term, so that none is the zero vector
                   len(words) - len(set(words)), len(following) - len(set(zip(words, following))),
                   sum(map(eq, words, following)), len(lines) - len(set(lines)),
                   sum(map(bytes.isupper, words)))
    return out


@dataclass(frozen=True)
class Model:
    """What is broadcast: bounded by ``max_labelled`` rows and ``TERMS``."""

    terms: np.ndarray       # term numbers that the sample has
    scale: np.ndarray       # their inverse document frequencies
    projection: np.ndarray  # terms x dims
    vectors: np.ndarray     # labelled x dims, unit length
    labels: np.ndarray
    neighbours: int
    sharpness: float

    def project(self, texts: list[str | None]) -> np.ndarray:
        x = np.empty((len(texts), len(self.terms)), dtype=np.float32)
        for i, t in enumerate(texts):
            x[i] = np.sqrt(term_counts(t)[self.terms]) * self.scale
        y = x @ self.projection
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)

    def vote(self, y: np.ndarray, block: int = 256) -> np.ndarray:
        """Score of each projected row: labels of its nearest neighbours by
        exact cosine, weighted by exp(-sharpness * (1 - cosine))."""
        k = min(self.neighbours, len(self.labels))
        out = np.empty(len(y))
        for i in range(0, len(y), block):
            s = y[i:i + block] @ self.vectors.T
            near = np.argpartition(-s, k - 1, axis=1)[:, :k]
            cos = np.take_along_axis(s, near, 1).astype(np.float64)
            w = np.exp(-self.sharpness * (cos.max(axis=1, keepdims=True) - cos))
            out[i:i + block] = (w * self.labels[near]).sum(1) / w.sum(1)
        return np.clip(out, 0.0, 1.0)


def latent_model(terms: np.ndarray, counts: np.ndarray, labels: np.ndarray, idf: np.ndarray, dims: int,
                 neighbours: int, sharpness: float) -> Model:
    """Truncated SVD of the labelled sample's weighted counts (one column for
    each of ``terms``), through the smaller Gram matrix."""
    scale = idf[terms].astype(np.float32)
    x = np.sqrt(counts).astype(np.float32) * scale
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    value, u = np.linalg.eigh((x @ x.T).astype(np.float64))
    order = np.argsort(value)[::-1][:dims]
    order = order[value[order] > 1e-9 * max(value.max(), 1e-12)]
    projection = (x.T @ (u[:, order] / np.sqrt(value[order]))).astype(np.float32)
    y = x @ projection
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    return Model(terms, scale, projection, y.astype(np.float32), labels.astype(np.float64), neighbours, sharpness)


def _sparse_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            c = term_counts(text.as_py())
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_pydict({"label": pa.array([label], pa.int32()), "terms": [at.astype(np.int32)],
                                              "counts": [c[at]]})


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(TERMS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            total += term_counts(text.as_py()) > 0
            n += 1
    if n:
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": np.append(at, -1).astype(np.int32), "n": np.append(total[at], n)})


def document_frequencies(df: DataFrame, text: str = "text") -> np.ndarray:
    """Smoothed inverse document frequency of every term over all documents;
    at most ``TERMS`` + 1 numbers reach the driver."""
    rows = df.select(F.col(text).cast("string")).mapInArrow(_document_counts, "term int, n long") \
        .groupBy("term").agg(F.sum("n").alias("n")).collect()
    n = sum(r["n"] for r in rows if r["term"] < 0)
    found = np.zeros(TERMS)
    for r in rows:
        if r["term"] >= 0:
            found[r["term"]] = r["n"]
    return np.log((n + 1) / (found + 1)) + 1


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
        max_labelled: int = 2048, dims: int = 32, neighbours: int = 15, sharpness: float = 20.0) -> Model | None:
    """Fit on at most ``max_labelled`` labelled documents, a sample by the hash
    of the key (the documented bound of what is collected and broadcast).

    Labels other than 0 and 1, and null keys, are ignored; of repeated keys the
    smallest label and text count. Document frequencies cover all of ``docs``.
    No labelled document: ``None``.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
             .agg(F.min(label).cast("int").alias("_label")))
    texts = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    sample = known.join(texts.select("_key").distinct(), "_key", "left_semi") \
        .orderBy(F.xxhash64("_key"), "_key").limit(max_labelled)
    chosen = (texts.join(F.broadcast(sample), "_key").groupBy("_key", "_label").agg(F.min("_text").alias("_text"))
              .select("_label", "_text").mapInArrow(_sparse_counts, "label int, terms array<int>, counts array<double>")
              .toPandas())
    if not len(chosen):
        return None
    terms = np.unique(np.concatenate(chosen["terms"].tolist()))
    counts = np.zeros((len(chosen), len(terms)), dtype=np.float32)
    for i, (at, c) in enumerate(zip(chosen["terms"], chosen["counts"])):
        counts[i, np.searchsorted(terms, at)] = c
    order = np.lexsort((chosen["label"].to_numpy(), counts.sum(1)))  # the same rows in any arrival order
    return latent_model(terms, counts[order], chosen["label"].to_numpy()[order], document_frequencies(docs, text),
                        dims, neighbours, sharpness)


def score(docs: DataFrame, model: Model | None, *, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (0..1, higher: label 1 likelier) and ``predicted`` (1 if
    at least ``threshold``) to every row, from the whole text alone. Null and
    empty texts are scored by their constant term. Without a model every score
    is 0.5. Columns of those names are replaced; no shuffle."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    if model is None:
        value = F.lit(0.5)
    else:
        sent = docs.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf("double")
        def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            m = sent.value
            for texts in batches:
                parts = [m.vote(m.project(texts.iloc[i:i + 256].tolist())) for i in range(0, len(texts), 256)]
                yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

        value = vote(F.col(text).cast("string"))
    return docs.select(*keep, value.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int"))


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2):
    """True for keys whose crc32 as text leaves remainder ``part`` (null: of
    the empty text)."""
    return F.crc32(id_text(key).cast("binary")) % parts == part
