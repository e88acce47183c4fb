"""Language-model scoring with a log-frequency Bloom filter (Talbot and
Osborne, "Randomised Language Modelling").

Counts of word pairs are quantised on a log scale; a pair with level ``q`` is
put into a Bloom filter ``q`` times, once with each level. A reader probes
level 1, 2, ... until the first miss, and so gets the level back, never too
low. The filter is cut by hash range into segments of bounded size, as is the
exact table of word counts; segments are broadcast one by one and a worker
holds one at a time, so the model may grow with the corpus.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlathe.llm.common import written

START, END = b" start", b" end"  # cannot be words: they hold a space
CHUNK = 1 << 19                  # tokens counted or scored together
SLICE_BYTES = 6 << 20            # text bytes for each hash range: about a million tokens
SEGMENT_BYTES = 8 << 20          # bytes of one broadcast
BASE = 1.5                       # quantisation: level q holds counts from BASE^(q-1)
BITS = 16                        # filter bits for each inserted (pair, level)

_LOWEST = np.unique(np.ceil(BASE ** np.arange(100) - 1e-9).astype(np.float64))  # smallest count of each level
_MEAN = np.concatenate(([0.0], (_LOWEST[:-1] + _LOWEST[1:] - 1) / 2))           # count that a level stands for


def level(counts: np.ndarray) -> np.ndarray:
    """Quantisation level (from 1) of counts of at least 1."""
    return np.searchsorted(_LOWEST, counts, side="right")


def mix(z: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(32))))


class LogBloom:
    """Register-blocked log-frequency Bloom filter: the five bits of a (key,
    level) lie in one 64-bit word."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def _place(keys: np.ndarray, q: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            z = mix(keys + np.uint64(q) * np.uint64(0xD1B54A32D192ED03))
        at = ((z >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        mask = np.zeros(len(z), dtype=np.uint64)
        for i in range(5):
            mask |= np.uint64(1) << ((z >> np.uint64(6 * i)) & np.uint64(63))
        return at.astype(np.int64), mask

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> LogBloom:
        q = level(counts)
        words = np.zeros(max(1, -(-int(q.sum()) * BITS // 64)), dtype=np.uint64)
        for k in range(1, int(q.max(initial=0)) + 1):
            at, mask = cls._place(keys[q >= k], k, len(words))
            np.bitwise_or.at(words, at, mask)
        return cls(words)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key (0: not held), by repeated probes."""
        out = np.zeros(len(keys), dtype=np.int64)
        live = np.arange(len(keys))
        for k in range(1, len(_MEAN)):
            at, mask = self._place(keys[live], k, len(self.words))
            live = live[(self.words[at] & mask) == mask]
            if not len(live):
                break
            out[live] = k
        return out


@dataclass
class Tokens:
    """Token hashes of some texts, each text between a start and an end."""

    words: np.ndarray    # distinct hashes
    place: np.ndarray    # their place in ``words``, for every start, word and end
    starts: np.ndarray   # index of each text's start

    @classmethod
    def of(cls, texts: list[bytes]) -> Tokens:
        index: dict[bytes, int] = {START: 0, END: 1}
        place = array("i")
        starts = []
        for t in texts:
            starts.append(len(place))
            place.append(0)
            place.extend([index.setdefault(w, len(index)) for w in t.lower().split()])
            place.append(1)
        digest = xxhash.xxh64_intdigest
        words = np.array([digest(w) for w in index], dtype=np.uint64)
        return cls(words, np.frombuffer(place, dtype=np.int32), np.array(starts, dtype=np.int64))

    def pairs(self) -> np.ndarray:
        """Key of the pair that ends at each token but the starts."""
        h = self.words[self.place]
        keys = pair_keys(h[:-1], h[1:])
        return keys[self.place[1:] != 0]


def _chunks(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t) // 6 + 2
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _raw(x) -> bytes:
    return (x.as_py() or "").encode("utf-8", "surrogatepass")


def _count(slices: int):
    shift = np.uint64(64 - (slices.bit_length() - 1)) if slices > 1 else None

    def cut(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        edges = np.searchsorted(keys >> shift, np.arange(slices + 1, dtype=np.uint64)) if shift is not None \
            else np.array([0, len(keys)])
        full = np.flatnonzero(np.diff(edges))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(full), kind, dtype=np.int32)), pa.array(full.astype(np.int32)),
             pa.array([keys[edges[i]:edges[i + 1]].tobytes() for i in full], pa.binary()),
             pa.array([counts[edges[i]:edges[i + 1]].astype(np.uint32).tobytes() for i in full], pa.binary())],
            names=["kind", "slice", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _chunks(_raw(x) for b in batches for x in b.column(0)):
            t = Tokens.of(texts)
            n = np.bincount(t.place, minlength=len(t.words))
            n[0] = 0  # a start is a context, not a token
            order = np.argsort(t.words, kind="stable")
            order = order[n[order] > 0]
            yield cut(0, t.words[order], n[order])
            keys, counts = np.unique(t.pairs(), return_counts=True)
            yield cut(1, keys, counts)
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (kind, slice): one output row for each."""
    held: list[tuple[bytes, bytes]] = []
    at: tuple[int, int] | None = None

    def close() -> pa.RecordBatch:
        keys = np.concatenate([np.frombuffer(k, dtype=np.uint64) for k, _ in held])
        counts = np.concatenate([np.frombuffer(c, dtype=np.uint32) for _, c in held]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        total, once = int(counts.sum()), int((counts == 1).sum())
        if at[0] == 0:
            body, extra = keys.tobytes(), counts.tobytes()
        else:
            body, extra = LogBloom.build(keys, counts).words.tobytes(), b""
        return pa.RecordBatch.from_pydict({"kind": pa.array([at[0]], pa.int32()), "slice": pa.array([at[1]], pa.int32()),
                                           "distinct": [len(keys)], "total": [total], "once": [once],
                                           "body": pa.array([body], pa.binary()), "extra": pa.array([extra], pa.binary())})

    for batch in batches:
        for kind, part, keys, counts in zip(*(batch.column(i) for i in range(4))):
            here = (kind.as_py(), part.as_py())
            if at is not None and here != at:
                yield close()
                held = []
            at = here
            held.append((keys.as_py(), counts.as_py()))
    if held:
        yield close()


@dataclass
class Model:
    """Broadcast segments, each at most ``SEGMENT_BYTES`` and one slice, and
    four totals over all training text."""

    slices: int
    tokens: int         # N
    distinct: int       # V
    documents: int
    novelty: float      # share of pair occurrences whose pair occurs once
    counts: list[Broadcast]
    pairs: list[Broadcast]

    @property
    def floor(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)


def fit(train: DataFrame, text: str = "text") -> Model:
    """Count words and word pairs of all rows of ``train`` and build the model.

    Every task counts chunks of bounded size and sends its distinct hashes,
    summed, to their hash range; so a word that is a third of all text is one
    entry a chunk. Hash ranges are sized by the bytes of the corpus, so a merge
    task holds about a million tokens' worth of entries. A null text counts as
    an empty one.
    """
    spark = train.sparkSession
    texts = train.select(F.col(text).cast("string").alias("text"))
    size, documents = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    slices = 1 << max(0, int((size or 0) // SLICE_BYTES).bit_length())
    counted = texts.mapInArrow(_count(slices), "kind int, slice int, keys binary, counts binary")
    merged = counted.repartition(2 * slices, "kind", "slice").sortWithinPartitions("kind", "slice").mapInArrow(
        _merge, "kind int, slice int, distinct long, total long, once long, body binary, extra binary")
    table = written(merged, "lm-slices")
    totals = {r["kind"]: r for r in table.groupBy("kind").agg(
        F.sum("distinct").alias("distinct"), F.sum("total").alias("total"), F.sum("once").alias("once")).collect()}
    segments: dict[int, list[Broadcast]] = {0: [], 1: []}
    for kind in segments:
        held, weight = [], 0
        rows = table.where(F.col("kind") == kind).select("slice", "body", "extra")
        rows = rows.repartitionByRange(max(1, slices // 4), "slice").sortWithinPartitions("slice")
        for r in rows.toLocalIterator():  # a few slices in the driver at a time
            held.append((r["slice"], bytes(r["body"]), bytes(r["extra"])))
            weight += len(r["body"]) + len(r["extra"])
            if weight >= SEGMENT_BYTES:
                segments[kind].append(spark.sparkContext.broadcast(held))
                held, weight = [], 0
        if held:
            segments[kind].append(spark.sparkContext.broadcast(held))
    words, pairs = totals.get(0), totals.get(1)
    return Model(slices, words["total"] if words else 0, words["distinct"] if words else 0, documents,
                 pairs["once"] / pairs["total"] if pairs else 1.0, segments[0], segments[1])


def _look_up(keys: np.ndarray, model: Model, parts: list[Broadcast], find) -> np.ndarray:
    """``find(keys, body, extra)`` for sorted keys, slice by slice; a worker
    keeps one broadcast value at a time."""
    out = np.zeros(len(keys), dtype=np.int64)
    if model.slices > 1:
        shift = np.uint64(64 - (model.slices.bit_length() - 1))
        edges = np.searchsorted(keys >> shift, np.arange(model.slices + 1, dtype=np.uint64))
    else:
        edges = np.array([0, len(keys)])
    for part in parts:
        for k, body, extra in part.value:
            if edges[k + 1] > edges[k]:
                out[edges[k]:edges[k + 1]] = find(keys[edges[k]:edges[k + 1]], body, extra)
        vars(part).pop("_value", None)  # read again from the executor's copy when needed
    return out


def _exact(keys: np.ndarray, body: bytes, extra: bytes) -> np.ndarray:
    known, counts = np.frombuffer(body, dtype=np.uint64), np.frombuffer(extra, dtype=np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, counts[at], 0)


def _levels(keys: np.ndarray, body: bytes, extra: bytes) -> np.ndarray:
    return LogBloom(np.frombuffer(body, dtype=np.uint64)).levels(keys)


def score_texts(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text: tokens, known tokens, base score, model score."""
    t = Tokens.of(texts)
    order = np.argsort(t.words, kind="stable")
    counts = np.empty(len(t.words), dtype=np.int64)
    counts[order] = _look_up(t.words[order], model, model.counts, _exact)
    context = counts.copy()
    context[0], counts[0] = model.documents, 0
    token = t.place != 0
    c = counts[t.place[token]]
    uni = (c + 0.5) / model.floor
    h = context[t.place[:-1][token[1:]]]  # count of the word before each token
    keys, back = np.unique(t.pairs(), return_inverse=True)
    pair = _MEAN[_look_up(keys, model, model.pairs, _levels)][back]
    seen = np.minimum(pair / np.maximum(h, 1), 1.0)
    p = np.where(h > 0, (1 - model.novelty) * seen + model.novelty * uni, uni)
    starts = t.starts - np.arange(len(t.starts))  # without the starts themselves
    ends = np.append(starts[1:], len(c))
    base, own = np.log10(uni), np.log10(np.maximum(p, 1e-300))
    return (ends - starts, np.add.reduceat((c > 0).astype(np.int64), starts), np.add.reduceat(base, starts),
            np.add.reduceat(own, starts))


def score(df: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens, n_known, base_score, score)`` for every row.

    ``base_score`` is the sum over tokens of log10 of the add-half unigram
    probability, from exact counts. ``score`` interpolates pair and word
    probability by linear discounting: a pair counts ``1 - novelty`` of its
    relative frequency and a word ``novelty`` of its probability, where
    ``novelty`` is the share of training pairs that occur once. After a word
    that training never saw, the word probability stands alone. Null and empty
    texts have one token, the end. No shuffle; a worker holds one chunk and one
    segment. Extra columns are not carried.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            got = score_texts([_raw(x) for x in t["text"]], model)
            return pa.RecordBatch.from_arrays([t["key"].combine_chunks(), *[pa.array(x) for x in got]],
                                              names=["key", "n_tokens", "n_known", "base_score", "score"])

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                held.append(part)
                size += part.nbytes // 6 + 2 * part.num_rows
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return source.mapInArrow(run, f"key {kind}, n_tokens long, n_known long, base_score double, score double") \
        .withColumnRenamed("key", key)


def fit_and_score(df: DataFrame, trains: Column, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the rows where ``trains`` is true and score all rows; adds
    ``train_tokens``."""
    model = fit(df.where(trains), text)
    return score(df, model, key=key, text=text).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
