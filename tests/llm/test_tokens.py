"""Streaming BPE and token files, against the tokenizers library."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from textlathe.llm import bpe_stream, token_files

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "aAbcdeE'sStrevlmd0123 \t\n.,!<|>-\x1c\x85\u00e9\u0301\u03a3\u03c2\u0130\u00df\ufb01\u212b\u0e00\uac00" \
    "\u1161\u11a8\u65e5\u672c\u3000\U0001f600"


def texts(n=800, seed=1):
    rng = random.Random(seed)
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 1, 5, 60, 400]))) for _ in range(n)]
    return out + ["", "<|endoftext|>a<|startoftext|> x", "a<|endoftext|", " a", "a  ", "a\n \nb", "the don't We'RE"]


def long_words():
    rng = random.Random(4)
    return ["".join(rng.choice("abcdeinthgr") for _ in range(150000)), "a" * 140000, "!" * 70000 + "'s" * 70000,
            "th" * 70000 + "\u00e9" * 70000, "x" * 66000 + "<|endoftext|>" + "'" * 66000 + "re",
            "".join(rng.choice(LETTERS.replace(" ", "").replace("\t", "").replace("\n", "")) for _ in range(150000))]


@pytest.mark.parametrize("some", [texts(), long_words()], ids=["short", "long"])
def test_transducer_equals_the_library(some):
    library, mine, back = Tokenizer.from_file(WORD), bpe_stream.StreamEncoder(WORD), bpe_stream.StreamDecoder(WORD)
    for t in some:
        ids = np.frombuffer(b"".join(mine.encode(t)), dtype=np.int32)
        want = library.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want
        pieces = [back.feed(ids[i:i + 7]) for i in range(0, len(ids), 7)] + [back.feed(ids[:0], final=True)]
        assert "".join(pieces) == library.decode(want, skip_special_tokens=False)


def test_word_transducer_holds_bounded_symbols():
    e = bpe_stream.StreamEncoder(WORD)
    w, most, out = bpe_stream.WordTransducer(e.merges), 0, []
    rng = random.Random(9)
    symbols = [rng.choice("abcdeinthgr") for _ in range(40000)]
    for i in range(0, len(symbols), 100):
        out += w.feed(symbols[i:i + 100])
        most = max(most, len(w.held))
    out += w.finish()
    assert most <= 2 * e.merges.lookahead + 64 + 200
    assert out == e.merges.merge(symbols[:-1] + [symbols[-1] + "</w>"])


def test_byte_decoder_is_incremental():
    library, back = Tokenizer.from_file(BYTE), bpe_stream.StreamDecoder(BYTE)
    text = "h\u00e9llo \U0001f600 \u65e5\u672c <|endoftext|>"
    ids = np.array(library.encode(text).ids)
    assert "".join([back.feed(ids[i:i + 1]) for i in range(len(ids))] + [back.feed(ids[:0], final=True)]) == text


def test_library_encoder_equals_whole_texts():
    library, mine = Tokenizer.from_file(BYTE), token_files.LibraryEncoder(BYTE)
    rng = random.Random(5)
    some = texts() + ["".join(rng.choice("ab'\n .") for _ in range(20)) for _ in range(2000)]
    assert [t for t in some if mine.encode(t).tolist() != library.encode(t, add_special_tokens=False).ids] == []


DOCS = [(5, "b a"), (1, "hello world"), (3, None), (4, ""), (2, "x " * 3000), (2, "x " * 3000), (None, "no id"),
        (9, "last")]


def test_token_files_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS file")
    manifest = token_files.write_token_files(df, BYTE, out_dir=tmpdir_path, end_id=2, frame_ids=100)
    got = token_files.read_token_files(manifest).orderBy("start").collect()
    library, at = Tokenizer.from_file(BYTE), 0
    for r, (key, text) in zip(got, sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0)), strict=True):
        ids = np.array(library.encode(text or "").ids + [2], dtype="<u4")
        assert (r["key"], r["start"], bytes(r["ids"])) == (key, at, ids.tobytes())
        at += len(ids)
    some = spark.createDataFrame([(2,), (9,), (77,), (None,)], "doc_id long")
    wanted = token_files.read_requested(manifest, some).collect()
    assert sorted(r["key"] for r in wanted) == [2, 2, 9]
    empty = token_files.write_token_files(df.limit(0), BYTE, out_dir=tmpdir_path)
    assert empty.count() == 0 and token_files.read_token_files(empty).count() == 0


def test_file_is_seekable_zstandard_and_checksums_are_checked(tmp_path):
    import pyarrow as pa
    name = tmp_path / "a.zst"
    with open(name, "wb") as f:
        w = token_files.TokenFileWriter(f, width=4, frame_ids=10)
        for i in range(30):
            w.add(str(i), np.arange(i, dtype=np.int32))
        w.close()
    raw = name.read_bytes()
    assert struct.unpack("<IBI", raw[-9:]) [1:] == (0x80, 0x8F92EAB1)
    plain = b"".join(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read(1 << 20) for _ in [0])
    assert plain  # any zstandard reader takes the frames and skips index and table
    reader = token_files.TokenFileReader(pa.OSFile(str(name)))
    assert [(k, x.tolist()) for k, x in reader.documents(["7", "29"])] == [("7", list(range(7))), ("29", list(range(29)))]
    start, n, _, _ = reader.frames[2]
    bad = bytearray(raw)
    bad[start:start + n] = zstandard.ZstdCompressor().compress(b"x" * 9)[:n].ljust(n, b"\0")
    (tmp_path / "b.zst").write_bytes(bad)
    broken = token_files.TokenFileReader(pa.OSFile(str(tmp_path / "b.zst")))
    list(broken.frame(1))
    with pytest.raises(Exception):
        list(broken.frame(2))


def test_transcode_column_forms(spark):
    df = spark.createDataFrame([(1, "Hello there"), (None, None), (2, ""), (2, "")], "doc_id long, text string") \
        .selectExpr("*", "1 AS ids", "2 AS decoded")
    got = sorted(((r["doc_id"] or 0, list(r["ids"]), r["decoded"]) for r in bpe_stream.transcode(df, WORD).collect()))
    ids = Tokenizer.from_file(WORD).encode("Hello there", add_special_tokens=False).ids
    assert got == [(0, [], ""), (1, ids, "hello</w> there</w>"), (2, [], ""), (2, [], "")]
    assert bpe_stream.transcode(df.limit(0), WORD).count() == 0
    assert zlib.crc32(b"") == 0


def test_word_tables_are_bounded_in_bytes():
    import public_tokenizers
    encoder = bpe_stream.StreamEncoder(public_tokenizers.path("word_bpe_49k.json"))
    short = b"".join(encoder.encode("a short word"))
    for k in range(20):
        assert b"".join(encoder.encode(f"{'ab' * 5000}{k} {chr(0x4e00 + k) * 10000}"))
    for t in (encoder.words, encoder.pieces):
        assert max(map(len, [*t.main, *t.late])) <= bpe_stream.LONGEST
    assert encoder.words.get("short") and b"".join(encoder.encode("a short word")) == short
    held = bpe_stream.Remembered(1 << 18, 10_000)
    for k in range(1000):
        held[f"{k:0200d}"] = b"1234"
        assert held.get(f"{k:0200d}") == b"1234"
        assert sum(4 * len(w) + len(v) for t in (held.main, held.late) for w, v in t.items()) <= 13_000


def test_every_word_that_is_not_remembered_comes_from_the_transducer(spark, monkeypatch):
    import textlathe.llm.bpe_stream as B
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    encoder, finished, fed = B.StreamEncoder(WORD), [], []
    feed, finish = B.WordTransducer.feed, B.WordTransducer.finish
    monkeypatch.setattr(B.WordTransducer, "feed", lambda self, s: fed.append(len(s)) or feed(self, s))
    monkeypatch.setattr(B.WordTransducer, "finish", lambda self: finished.append(1) or finish(self))
    library = Tokenizer.from_file(WORD)
    for t in docs:
        ids = np.frombuffer(b"".join(encoder.encode(t)), dtype=np.int32).tolist()
        assert ids == library.encode(t, add_special_tokens=False).ids
    kept = len(encoder.pieces.main) + len(encoder.pieces.late)
    assert len(finished) >= kept > 1000 and len(fed) >= len(finished)


def test_tokens_are_emitted_before_the_word_ends():
    e = bpe_stream.StreamEncoder(WORD)
    assert e.merges.lookahead == max(e.merges.need.values())
    rng, early = random.Random(3), 0
    for hold in (2, 5, 64):
        for k in range(40):
            symbols = [rng.choice("abcdeinthgr'!Ġ") for _ in range(rng.randint(1, 300 if k else 6000))]
            w, out = bpe_stream.WordTransducer(e.merges, hold), []
            for s in symbols:
                out += w.feed([s])
            early += len(out)
            out += w.finish()
            assert out == e.merges.merge(symbols[:-1] + [symbols[-1] + "</w>"])
    assert early > 1000


def test_registered_token_files_hold_the_library_ids(spark):
    from textlathe.llm.catalog import QUERIES
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    library, at, want = Tokenizer.from_file(BYTE), 0, []
    for key, text in docs:
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], dtype="<u4")
        want.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = QUERIES["op4_token_files"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want


def test_token_folder_is_on_the_default_file_system(spark):
    assert token_files.qualified(spark, "/some/where") == "file:/some/where"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://localhost:9/")  # named only, never contacted
    try:
        assert token_files.qualified(spark, "/some/where").startswith("hdfs://localhost:9/")
        assert token_files.qualified(spark, "file:/some/where") == "file:/some/where"
    finally:
        conf.set("fs.defaultFS", before)
