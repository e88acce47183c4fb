"""Token-ID files: independent zstandard frames, a trailing index and seek
table, a checksum per frame.

File layout (a valid zstandard stream in the published seekable format):

* data frames, each holding whole documents: ``u32`` document count, ``u32``
  bytes of an id; per document ``u32`` key bytes (0xFFFFFFFF: null key) and
  ``u32`` id count; the UTF-8 keys; the ids, little-endian ``u16`` or ``u32``;
* an index in a skippable frame: per document ``u32`` frame number, ``u32``
  key bytes, key;
* the seek table in a skippable frame: per frame compressed size, decompressed
  size, low 32 bits of XXH64 of the content; then frame count, descriptor and
  magic number.

A reader opens the end of the file, and decompresses only the frames it needs.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlathe.llm.bpe_stream import WHITE, Remembered, byte_characters
from textlathe.llm.common import row_digest, written
from textlathe.session import scratch_path

# FIXED VALUES: magic numbers of zstandard's skippable frames and seekable format.
INDEX_MAGIC, SEEK_MAGIC, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
# FIXED VALUE: the byte-level word pattern of the vocabulary (its \s is the White_Space property).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NULL_KEY = 0xFFFFFFFF
FRAME_IDS = 1 << 16  # a frame is closed at this many ids; a longer document has a frame of its own
CACHED = 900_000     # parts of text whose ids a worker remembers (about 200 bytes each)
TOGETHER = 1 << 20   # characters of documents that are encoded together

_NOT_SINGLE = ["  ", *(c for c in WHITE if c != " ")]


class LibraryEncoder:
    """Ids of whole texts by the ``tokenizers`` library, each distinct word
    encoded once while it is remembered.

    A byte-level pre-tokeniser never joins a character and the white space
    behind it, so a text is cut there into parts: a space or none, then other
    characters, or white space alone. A part that is not remembered is cut into
    the vocabulary's words, and the library's own BPE model encodes those that
    are not remembered either; that is the costly step of the library without
    its bookkeeping of offsets, which costs more than the merges. Whole texts
    that hold a special string go to the library's ``encode``.
    """

    def __init__(self, path: str, remembered: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on every core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # a run of white space before a word: all but its last character, then that one (a space joins the word)
        self.parts = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?=[{WHITE}][^{WHITE}])|[{WHITE}](?=[^{WHITE}])|[{WHITE}]+").findall
        self.split = regex.compile(BYTE_LEVEL.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]")
                                   .replace(r"\s", f"[{WHITE}]")).findall
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model.tokenize
        self.symbols = {b: ord(c) for b, c in enumerate(byte_characters())}
        self.known = Remembered(remembered)
        self.size = self.library.get_vocab_size()

    def _words(self, part: str) -> list[str]:
        """The part cut into the vocabulary's words. Letters behind at most one
        space are a word, and so is one ASCII mark behind them; white space alone
        is one; anything else is left to the vocabulary's pattern."""
        body = part[1:] if part[:1] == " " else part
        if body.isalpha() or part[-1] in WHITE:
            return [part]
        if body[-1] in ",.;:!?" and body[:-1].isalpha():
            return [part[:-1], part[-1]]
        return self.split(part)

    def _word(self, word: str) -> bytes:
        """Ids of one word of the vocabulary's pattern by the library's model."""
        plain = word if word.isascii() else word.encode("utf-8").decode("latin-1")
        return array("i", [t.id for t in self.model(plain.translate(self.symbols))]).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of a part that is not remembered; it and its words are from now on."""
        known, words, out = self.known, self._words(part), []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = known[w] = self._word(w)  # kept if it is short
            out.append(ids)
        if len(words) == 1:
            return out[0]
        known[part] = ids = b"".join(out)
        return ids

    def _all(self, parts: list[str]) -> list[bytes]:
        """Ids of each part."""
        found = list(map(self.known.main.get, parts))
        if None in found:
            get, part = self.known.get, self._part
            for i, ids in enumerate(found):
                if ids is None:
                    ids = get(parts[i])
                    found[i] = part(parts[i]) if ids is None else ids
        return found

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        parts, ends, whole = [], [], {}
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                whole[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, dtype=np.int32)
            elif any(map(t.__contains__, _NOT_SINGLE)):
                parts += self.parts(t)
            elif t:  # white space is single spaces, so the text may be cut before each
                first, *rest = t.split(" ")
                if first:
                    parts.append(first)
                parts += [" " + w for w in rest]
            ends.append(len(parts))
        found = self._all(parts)
        out = [np.frombuffer(b"".join(found[i:j]), dtype=np.int32) for i, j in zip([0, *ends], ends)]
        return [whole.get(i, ids) for i, ids in enumerate(out)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]


@lru_cache(maxsize=4)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file in shared storage."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of Spark's file system, so that a folder without
    one is the cluster's default storage and not a worker's own disk."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


class TokenFileWriter:
    """Writes documents to one open binary stream."""

    def __init__(self, stream, width: int = 4, level: int = 3, frame_ids: int = FRAME_IDS):
        self.stream, self.width, self.frame_ids = stream, width, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int, int]] = []
        self.index = bytearray()
        self.keys: list[bytes | None] = []
        self.ids: list[np.ndarray] = []
        self.held = self.documents = self.total = 0

    def add(self, key: str | None, ids: np.ndarray) -> None:
        self.keys.append(None if key is None else key.encode("utf-8"))
        self.ids.append(ids)
        self.held += len(ids)
        self.documents += 1
        self.total += len(ids)
        if self.held >= self.frame_ids:
            self._frame()

    def _frame(self) -> None:
        if not self.keys:
            return
        n = len(self.keys)
        head = np.empty((n, 2), dtype="<u4")
        head[:, 0] = [NULL_KEY if k is None else len(k) for k in self.keys]
        head[:, 1] = [len(x) for x in self.ids]
        body = np.concatenate(self.ids).astype("<u2" if self.width == 2 else "<u4").tobytes()
        plain = struct.pack("<II", n, self.width) + head.tobytes() + b"".join(k or b"" for k in self.keys) + body
        for k in self.keys:
            self.index += struct.pack("<II", len(self.frames), NULL_KEY if k is None else len(k)) + (k or b"")
        packed = self.zstd.compress(plain)
        self.stream.write(packed)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.keys, self.ids, self.held = [], [], 0

    def close(self) -> None:
        self._frame()
        index = struct.pack("<II", INDEX_MAGIC, len(self.index)) + bytes(self.index)
        self.stream.write(index)
        rows = [*self.frames, (len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        table = b"".join(struct.pack("<III", *r) for r in rows)
        self.stream.write(struct.pack("<II", SEEK_MAGIC, len(table) + 9) + table
                          + struct.pack("<IBI", len(rows), CHECKSUM_FLAG, SEEKABLE_MAGIC))


class TokenFileReader:
    """Reads one file that can seek (``size()``, ``seek``, ``read``)."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        count, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        table = np.frombuffer(self._at(size - 9 - 12 * count, 12 * count), dtype="<u4").reshape(count, 3)
        ends = np.cumsum(table[:, 0].astype(np.int64))
        self.frames = [(int(e - c), int(c), int(d), int(x)) for e, (c, d, x) in zip(ends, table)]
        self.zstd = zstandard.ZstdDecompressor()

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.frames) - 1  # the last is the index

    def keys(self) -> list[tuple[int, str | None]]:
        """(frame, key) of every document, from the index alone."""
        start, n, _, _ = self.frames[-1]
        raw = self._at(start, n)
        magic, _ = struct.unpack_from("<II", raw)
        if magic != INDEX_MAGIC:
            raise ValueError("no index before the seek table")
        out, at = [], 8
        while at < len(raw):
            frame, k = struct.unpack_from("<II", raw, at)
            at += 8
            key = None if k == NULL_KEY else raw[at:at + k].decode("utf-8")
            at += 0 if k == NULL_KEY else k
            out.append((frame, key))
        return out

    def frame(self, k: int) -> Iterator[tuple[str | None, np.ndarray]]:
        """Documents of one frame: (key, ids)."""
        start, n, plain_size, checksum = self.frames[k]
        plain = self.zstd.decompress(self._at(start, n), max_output_size=plain_size)
        if len(plain) != plain_size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k}: wrong checksum")
        docs, width = struct.unpack_from("<II", plain)
        head = np.frombuffer(plain, dtype="<u4", count=2 * docs, offset=8).reshape(docs, 2)
        at = 8 + 8 * docs
        keys = []
        for size in head[:, 0].tolist():
            if size == NULL_KEY:
                keys.append(None)
            else:
                keys.append(plain[at:at + size].decode("utf-8"))
                at += size
        ids = np.frombuffer(plain, dtype="<u2" if width == 2 else "<u4", offset=at).astype("<u4")
        ends = np.cumsum(head[:, 1].astype(np.int64))
        for key, end, size in zip(keys, ends.tolist(), head[:, 1].tolist()):
            yield key, ids[end - size:end]

    def documents(self, wanted: Iterable[str] | None = None) -> Iterator[tuple[str | None, np.ndarray]]:
        """All documents in order, or those with a wanted key: only frames that
        hold one are read and decompressed."""
        if wanted is None:
            for k in range(len(self)):
                yield from self.frame(k)
            return
        wanted = set(wanted)
        for k in sorted({f for f, key in self.keys() if key in wanted}):
            yield from ((key, ids) for key, ids in self.frame(k) if key in wanted)


def together(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts (null: empty) of a batch, ``TOGETHER`` characters or one
    text at a time."""
    keys, texts, size = [], [], 0
    for k, t in zip(batch.column(0), batch.column(1)):
        keys.append(k.as_py())
        texts.append(t.as_py() or "")
        size += len(texts[-1])
        if size >= TOGETHER:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def write_token_files(df: DataFrame, path: str, *, out_dir: str, end_id: int | None = None, key: str = "doc_id",
                      text: str = "text", frame_ids: int = FRAME_IDS,
                      make_encoder: Callable[[str], LibraryEncoder] = library_encoder) -> DataFrame:
    """Encode every whole text and write one file per range of keys to
    ``out_dir`` (shared storage). Returns the manifest: ``part, file, n_docs,
    n_ids, first_key, last_key`` with one row per file.

    Documents are range partitioned and sorted by key (nulls first; equal keys
    by md5 of key and text), so ids stand in ascending key order over the
    files in ``part`` order. A null text is empty; every document gets
    ``end_id`` if it is given. Each attempt of a task writes a file of its own
    name and the manifest, written once, names those of finished tasks, so lost
    or repeated tasks leave the result whole. An empty table gives an empty
    manifest.
    """
    out_dir = qualified(df.sparkSession, out_dir)
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"),
                       row_digest(key, text).alias("digest"))
    ordered = (source.repartitionByRange(F.col("key").asc_nulls_first(), F.col("digest"))
               .sortWithinPartitions(F.col("key").asc_nulls_first(), "digest")
               .select(F.col("key").cast("string").alias("key"), "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make_encoder(path)
        width = 2 if max(encoder.size, (end_id or 0) + 1) <= 1 << 16 else 4
        tail = np.array([] if end_id is None else [end_id], dtype=np.int32)
        part, writer, first, last = TaskContext.get().partitionId(), None, None, None
        fs, folder = filesystem(out_dir)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tokens.zst"
        stream = None
        for batch in batches:
            for keys, texts in together(batch):
                if writer is None:
                    fs.create_dir(folder, recursive=True)
                    stream = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    writer = TokenFileWriter(stream, width, frame_ids=frame_ids)
                    first = keys[0]
                last = keys[-1]
                for k, ids in zip(keys, encoder.encode_many(texts)):
                    writer.add(k, np.concatenate([ids, tail]))
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "file": [f"{out_dir.rstrip('/')}/{name}"], "n_docs": [writer.documents],
                 "n_ids": [writer.total], "first_key": pa.array([first], pa.string()),
                 "last_key": pa.array([last], pa.string())})

    kind = "part int, file string, n_docs long, n_ids long, first_key string, last_key string"
    manifest = ordered.mapInArrow(write, kind.replace("part int", "part long"))
    return written(manifest, "token-manifest")


def read_token_files(manifest: DataFrame, key_type: str = "long") -> DataFrame:
    """Every document of the files: ``key``, ``start`` (ids of all documents
    before it), ``ids`` (little-endian unsigned 32-bit, binary). One task reads
    a few files; frame checksums are verified."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))
    spark = manifest.sparkSession
    files = files.select("file", "start").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = row["start"]
                fs, name = filesystem(row["file"])
                with fs.open_input_file(name) as f:
                    reader = TokenFileReader(f)
                    for k in range(len(reader)):
                        keys, starts, ids = [], [], []
                        for key, x in reader.frame(k):
                            keys.append(key)
                            starts.append(at)
                            ids.append(x.tobytes())
                            at += len(x)
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(starts, pa.int64()),
                                                          pa.array(ids, pa.binary())], names=["key", "start", "ids"])

    return files.mapInArrow(read, "key string, start long, ids binary").withColumn("key", F.col("key").cast(key_type))


def read_requested(manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, ids)`` of the requested keys only: each key is matched to the
    files whose range holds it, and only the frames that hold a requested
    document are decompressed. Keys must compare as integers."""
    k = keys.select(F.col(key).cast("long").alias("key")).where("key IS NOT NULL").distinct()
    m = manifest.where("last_key IS NOT NULL").select(
        "file", F.coalesce(F.col("first_key").cast("long"), F.lit(-(1 << 63))).alias("low"),
        F.col("last_key").cast("long").alias("high"))
    hits = k.join(m, (F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high"))).select("file", "key")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[str, set[str]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                wanted.setdefault(row["file"], set()).add(str(row["key"]))
        for file, some in wanted.items():
            fs, name = filesystem(file)
            with fs.open_input_file(name) as f:
                for doc, ids in TokenFileReader(f).documents(some):
                    yield pa.RecordBatch.from_pydict({"key": [int(doc)], "ids": pa.array([ids.tobytes()], pa.binary())})

    return hits.repartition("file").mapInArrow(fetch, "key long, ids binary")


def token_folder(spark: SparkSession) -> str:
    """A new output folder under the shared folder."""
    return scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
