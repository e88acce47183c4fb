"""Alignment of two tokenizers' tokens over the same text.

Every text is tokenised whole by a byte-level BPE file (A, with a space put
before the text) and by a sentencepiece model (B, which adds that space itself).
Both token sequences spell the same bytes. Where a token of each ends at the
same byte and the next token of each begins with a space, the text is cut into
windows, mostly of one word; a window's alignment depends on nothing but its
two id tuples, so it is worked out once and remembered. Alignments of windows
are then counted over the corpus: in how many texts an id pair is linked.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlathe.llm.bpe_stream import byte_characters
from textlathe.llm.common import written
from textlathe.operators.joins import bounded_broadcast

REMEMBERED = 400_000   # window alignments a worker remembers (about 400 bytes each); an eighth more pass through
LONGEST = 64           # ids of a window that is remembered, at most
MARK = 1 << 24         # added to B's ids in a remembered window, so that A's end where B's begin
SHIFT = 32             # an id pair is one number: A id * 2^32 + B id
MAX_PAIRS = 1_000_000  # counted pairs that are broadcast (about 60 bytes each); more are joined by shuffle
ROWS = 256             # texts of an output batch, at most
HELD = 1 << 20         # links of an output batch at which it is closed early


class ByteLevelTokens:
    """A: ids of ``" " + text`` by a byte-level BPE file; special strings are
    plain text. The file's ids are in merge order, so they serve as ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in enumerate(byte_characters())}
        special = {t["content"] for t in spec["added_tokens"]}
        self.bytes = {i: bytes([back[c] for c in t]) for t, i in spec["model"]["vocab"].items() if t not in special}
        self.encoding = tiktoken.Encoding("byte level", pat_str=pattern, special_tokens={},
                                          mergeable_ranks={b: i for i, b in self.bytes.items()})

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class PieceTokens:
    """B: ids by a sentencepiece model, which adds the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else \
                b"" if self.model.is_control(i) else piece.replace("▁", " ").encode("utf-8")

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Spelling:
    """What the ids of a tokenizer spell: lengths and leading spaces as arrays."""

    def __init__(self, tokens):
        self.tokens = tokens
        n = max(tokens.bytes) + 1
        self.text = [tokens.bytes.get(i, b"") for i in range(n)]
        self.name = [str(i) for i in range(n)]
        self.length = np.array([len(t) for t in self.text], dtype=np.int64)
        self.spaced = np.array([t[:1] == b" " for t in self.text], dtype=bool)

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.text.__getitem__, ids))


class Aligner:
    """Tokenises texts with both tokenizers and aligns them window by window.
    ``memory`` holds what comes first, mostly what is frequent; when it is full,
    the rest passes through ``late``, which is emptied whenever it is full."""

    def __init__(self, a, b, remembered: int = REMEMBERED):
        self.a, self.b = Spelling(a), Spelling(b)
        self.memory, self.late, self.remembered = {}, {}, remembered

    def align_windows(self, a: list[bytes], b: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Alignment of windows, given by their A ids and B ids (int32 bytes): the
        text of their groups (``a1,a2|b1;a3|b2``) and the linked pairs in order
        (int64 bytes). Windows laid end to end are aligned together, since both
        sequences end where a window ends."""
        last_a = np.cumsum([len(x) // 4 for x in a])
        a, b = (np.frombuffer(b"".join(x), dtype=np.int32) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        # a stretch without a token end inside belongs to one token of each: a link
        stretch = np.union1d(ends_a, ends_b)
        in_a, in_b = np.searchsorted(ends_a, stretch), np.searchsorted(ends_b, stretch)
        links = ((a[in_a].astype(np.int64) << SHIFT) | b[in_b]).tobytes()
        shared = (ends_a[in_a] == stretch) & (ends_b[in_b] == stretch)
        group_a, group_b = (in_a[shared] + 1).tolist(), (in_b[shared] + 1).tolist()
        last_link = np.searchsorted(stretch, ends_a[last_a - 1], side="right")
        last_group = np.cumsum(shared)[last_link - 1]
        say_a, say_b = list(map(self.a.name.__getitem__, a.tolist())), list(map(self.b.name.__getitem__, b.tolist()))
        groups, from_a, from_b = [], 0, 0
        for to_a, to_b in zip(group_a, group_b):
            if to_a - from_a == 1 and to_b - from_b == 1:
                groups.append(say_a[from_a] + "|" + say_b[from_b])
            else:
                groups.append(",".join(say_a[from_a:to_a]) + "|" + ",".join(say_b[from_b:to_b]))
            from_a, from_b = to_a, to_b
        out, link, group = [], 0, 0
        for to_link, to_group in zip((8 * last_link).tolist(), last_group.tolist()):
            out.append((";".join(groups[group:to_group]).encode(), links[link:to_link]))
            link, group = to_link, to_group
        return out

    def windows(self, ids_a: np.ndarray, ids_b: np.ndarray) -> list[tuple[bytes, bytes]]:
        """Alignments of a text's windows, remembered or worked out together."""
        cut_a, cut_b = self._cuts(ids_a, ids_b)
        raw_a, raw_b = ids_a.tobytes(), (ids_b + MARK).tobytes()
        to_a, to_b = (4 * cut_a).tolist(), (4 * cut_b).tolist()
        from_a, from_b = [0, *to_a], [0, *to_b]
        keys = [raw_a[i:j] + raw_b[k:m] for i, j, k, m in zip(from_a, to_a, from_b, to_b)]
        found = list(map(self.memory.get, keys))
        if None in found:
            plain_b, late = ids_b.tobytes(), self.late.get
            gaps = [i for i, x in enumerate(found) if x is None]
            unknown = {}
            for i in gaps:
                found[i] = late(keys[i])
                if found[i] is None:
                    unknown.setdefault(keys[i], i)
            if unknown:
                new = self.align_windows([raw_a[from_a[i]:to_a[i]] for i in unknown.values()],
                                         [plain_b[from_b[i]:to_b[i]] for i in unknown.values()])
                new = dict(zip(unknown, new))
                for key, x in new.items():
                    self._remember(key, x)
                for i in gaps:
                    if found[i] is None:
                        found[i] = new[keys[i]]
        return found

    def _remember(self, key: bytes, value: tuple[bytes, bytes]) -> None:
        if len(key) > 4 * LONGEST:
            return
        if len(self.memory) < self.remembered:
            self.memory[key] = value
        else:
            if len(self.late) > self.remembered // 8:
                self.late.clear()
            self.late[key] = value

    def texts(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """Per text: A tokens, B tokens, groups, the groups' digest, and every
        link in order. Zeros and ``''`` for a text that has no tokens."""
        nothing = (0, 0, 0, "", np.empty(0, dtype=np.int64))
        for text, a, b in zip(texts, self.a.tokens(texts), self.b.tokens(texts)):
            if not text:
                yield nothing
                continue
            spelt = b" " + text.encode("utf-8")
            if self.a.spell(a) != spelt or self.b.spell(b) != spelt:
                yield nothing
                continue
            parts, links = zip(*self.windows(np.array(a, dtype=np.int32), np.array(b, dtype=np.int32)))
            groups = b";".join(parts)
            yield (len(a), len(b), groups.count(b"|"), sha256(groups).hexdigest(),
                   np.frombuffer(b"".join(links), dtype=np.int64))

    def _cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the windows, as numbers of A and B tokens."""
        ends_a, ends_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        # candidates: ends of A before a space-marked token, verified against B's ends and marks
        starts = np.flatnonzero(self.a.spaced[a[1:]])
        place = np.searchsorted(ends_b, ends_a[starts])
        place = np.minimum(place, len(b) - 1)
        shared = (ends_b[place] == ends_a[starts]) & (place + 1 < len(b))
        shared &= self.b.spaced[b[np.minimum(place + 1, len(b) - 1)]]
        return np.append(starts[shared] + 1, len(a)), np.append(place[shared] + 1, len(b))


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str, pattern: str) -> Aligner:
    return Aligner(ByteLevelTokens(a_path, pattern), PieceTokens(b_path))


def align(df: DataFrame, a_path: str, b_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``key, row`` (a number of its own), ``n_a, n_b,
    n_groups, n_links, groups_sha256``, and ``pairs`` / ``times``: each distinct
    linked pair and how often it is linked. Written in the shared folder, since
    counting reads it again.

    A null or empty text, and one that either tokenizer does not spell back, has
    zeros, no pairs and the empty digest. Repeated rows stay. A worker holds an
    input batch, the links of one text and its remembered windows. ``pattern``
    splits text into A's words.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, row = aligner(a_path, b_path, pattern), TaskContext.get().partitionId() << 40
        for batch in batches:
            keys, texts = batch.column(0), [t.as_py() or "" for t in batch.column(1)]
            at = 0
            while at < len(texts):
                size, end = 0, at
                while end < len(texts) and end - at < ROWS and (end == at or size < HELD):
                    size += len(texts[end])
                    end += 1
                rows, pairs, times, ends = [], [], [], [0]
                for n_a, n_b, n_groups, digest, links in work.texts(texts[at:end]):
                    distinct, n = np.unique(links, return_counts=True)
                    rows.append((row, n_a, n_b, n_groups, len(links), digest))
                    pairs.append(distinct)
                    times.append(n.astype(np.int32))
                    ends.append(ends[-1] + len(distinct))
                    row += 1
                numbers = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:5]]
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, end - at), *numbers, pa.array([r[5] for r in rows], pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pairs), pa.int64())),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times), pa.int32()))],
                    names=["key", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
                at = end

    out = source.mapInArrow(run, f"key {kind}, row long, n_a long, n_b long, n_groups long, n_links long, "
                                 "groups_sha256 string, pairs array<long>, times array<int>")
    return written(out.withColumnRenamed("key", key), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, a, count, best)``: texts that hold the id pair linked, and
    whether no other pair of the same A id has a higher count."""
    counts = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair")
                     .agg(F.count(F.lit(1)).alias("count"))
                     .withColumn("a", F.shiftright("pair", SHIFT)), "pair-counts")
    top = counts.groupBy("a").agg(F.max("count").alias("top"))  # one row per A id
    return counts.join(top, "a").select("pair", "a", "count", (F.col("count") == F.col("top")).alias("best"))


def score(aligned: DataFrame) -> DataFrame:
    """``row, n_best, count_sum`` for every text with links: links whose pair is
    a best one of its A id, and the sum of the counts over all links."""
    counts = written(pair_counts(aligned), "pair-best").select("pair", "count", "best")
    pairs = aligned.select("row", F.inline(F.arrays_zip("pairs", "times")))
    joined = pairs.join(bounded_broadcast(counts, counts.count(), MAX_PAIRS), F.col("pairs") == F.col("pair"))
    return joined.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                     F.sum(F.col("times") * F.col("count")).alias("count_sum"))
