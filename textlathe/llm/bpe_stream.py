"""BPE encoding as a streaming transducer with bounded lookahead, and decoding
by an incremental state machine.

Sufficient lookahead (after Berglund and van der Merwe, "Formalizing BPE
Tokenization"): a token's right end ``e`` can only be undone by a merge across
``e``. Such a merge joins a piece on the right spine of the token with a piece
of ``k`` symbols after ``e``, and it happens or not depending on merges of
smaller rank across *its* right end, and so on. Ranks fall strictly along that
chain, so one pass over the merge list in rank order bounds its length. A
token followed by that many known symbols is final: it is emitted and its
symbols are forgotten, so a word of any length is encoded in constant memory.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: the characters with the Unicode White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SPLIT_WHITE = re.compile(f"[{WHITE}]+")
ODD_SPACE = re.compile("[\x1c-\x1f]")  # str.split() takes these for white space, Unicode does not

CHUNK = 1 << 16    # characters looked at together
CACHED = 1 << 18   # words whose ids are remembered in a worker, at most
LONGEST = 256      # characters of a word that is remembered, at most
HELD = 1 << 26     # bytes of remembered words and ids (four a character) at which a table is full
HOLD = 64          # symbols that the transducer holds before it looks for final tokens
ROWS = 256         # rows of an output batch, at most
BYTES = 1 << 26    # bytes at which an output batch is closed early


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes stand for themselves, the others are
    numbered from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [], 0
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


class Remembered:
    """Ids of words, bounded by entries and by bytes. What comes first, mostly
    what is frequent, stays in ``main``; when that is full, the rest passes
    through ``late``, which is emptied whenever it holds an eighth as much.
    Words of more than ``LONGEST`` characters are not kept."""

    def __init__(self, most: int, held: int = HELD):
        self.most, self.main, self.late = most, {}, {}
        self.held, self.main_bytes, self.late_bytes = held, 0, 0

    def get(self, key):
        got = self.main.get(key)
        return got if got is not None else self.late.get(key)

    def __setitem__(self, key, value) -> None:
        if len(key) > LONGEST:
            return
        size = 4 * len(key) + len(value)
        if len(self.main) < self.most and self.main_bytes + size <= self.held:
            self.main[key] = value
            self.main_bytes += size
        else:
            if len(self.late) > self.most // 8 or self.late_bytes > self.held // 8:
                self.late.clear()
                self.late_bytes = 0
            self.late[key] = value
            self.late_bytes += size


class MergeList:
    """Vocabulary and ranked merges of one tokenizer file, with the sufficient
    lookahead in symbols."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.symbols = byte_characters()
        self.need = self._needs(merges)
        self.lookahead = max(self.need.values(), default=0)

    def _length(self, token: str) -> int:
        return len(token.removesuffix(self.suffix)) if self.suffix else len(token)

    def _needs(self, merges: list[tuple[str, str]]) -> dict[str, int]:
        """Symbols that must be known behind a token before it is final: the
        longest chain of merges across its right end that a piece on its right
        spine may take part in. Tokens that are missing need none."""
        right_part = {a + b: b for a, b in reversed(merges)}
        reach_of_left: dict[str, int] = {}  # symbols to the right that a merge with this left piece depends on
        for a, b in merges:
            reach_of_left[a] = max(reach_of_left.get(a, 0), self._spine(b, right_part, reach_of_left) + self._length(b))
        return {t: n for t in {x for m in merges for x in (*m, m[0] + m[1])}
                if (n := self._spine(t, right_part, reach_of_left))}

    @staticmethod
    def _spine(piece: str, right_part: dict[str, str], reach: dict[str, int]) -> int:
        longest = reach.get(piece, 0)
        while piece in right_part:
            piece = right_part[piece]
            longest = max(longest, reach.get(piece, 0))
        return longest

    def merge(self, symbols: list[str]) -> list[str]:
        """Tokens of a symbol sequence: the pair of smallest rank, leftmost
        first, is merged until none is left."""
        rank = self.rank
        if len(symbols) > 64:
            return self._merge_long(symbols)
        tokens = list(symbols)
        while len(tokens) > 1:
            best, at = None, -1
            for i in range(len(tokens) - 1):
                r = rank.get((tokens[i], tokens[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            tokens[at:at + 2] = [tokens[at] + tokens[at + 1]]
        return tokens

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap of pairs over a linked list."""
        n = len(symbols)
        token, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1)
                if (r := self.rank.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)

        def push(i: int, j: int) -> None:
            r = self.rank.get((token[i], token[j]))
            if r is not None:
                heapq.heappush(heap, (r, i, token[i], token[j]))

        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or token[i] != a or token[j] != b:
                continue
            token[i], alive[j], after[i] = a + b, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return [t for t, x in zip(token, alive) if x]


class WordTransducer:
    """Symbols of one word in, tokens out as soon as they are final: every token
    waits for the lookahead that its own right end needs. Symbols are taken in
    until ``HOLD`` of them are held, so a word is merged in pieces of bounded
    length; what was not final stays for the next piece."""

    def __init__(self, merges: MergeList, hold: int = HOLD):
        self.merges, self.hold, self.held, self.next = merges, hold, [], hold

    def feed(self, symbols: list[str]) -> list[str]:
        """Tokens that are final after these symbols. The last symbol may still
        turn out to end the word."""
        self.held += symbols
        known = len(self.held) - 1
        if known < self.next:
            return []
        out, end, need = [], 0, self.merges.need
        for t in self.merges.merge(self.held[:known]):
            if end + len(t) + need.get(t, 0) > known:
                break
            end += len(t)
            out.append(t)
        del self.held[:end]
        # tokens that wait need more symbols: look again when there are as many new ones
        self.next = max(self.hold, 2 * (len(self.held) - 1) if not end else self.hold)
        return out

    def finish(self) -> list[str]:
        """The word ends: the rest of its tokens. Ready for the next word."""
        last, self.held, self.next = self.held, [], self.hold
        if last:
            last[-1] += self.merges.suffix
        return self.merges.merge(last)


class StreamEncoder:
    """Text -> ids exactly as the ``tokenizers`` library encodes with a file of
    the ``word_bpe`` kind: NFC, lower case, words by the file's pattern, byte
    symbols, word ends. ``words`` and ``pieces`` remember at most ``CACHED``
    words of at most ``LONGEST`` characters and ``HELD`` bytes each, and an
    eighth more; longer words pass through."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"]:
            raise ValueError("not a tokenizer file of the word BPE kind")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = MergeList(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.vocab = model["vocab"]
        # the pattern's \s is the White_Space property
        self.pattern = regex.compile(pre[0]["pattern"]["Regex"].replace(r"\s", WHITE))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.pieces, self.words = Remembered(CACHED), Remembered(CACHED)
        self.word = WordTransducer(self.merges)

    def ids(self, tokens: list[str]) -> bytes:
        vocab = self.vocab
        return array("i", [vocab[t] for t in tokens]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """One match of the pattern, remembered or through the transducer."""
        got = self.pieces.get(piece)
        if got is None:
            symbols, word, out = self.merges.symbols, self.word, []
            raw = piece.encode("utf-8")
            for i in range(0, len(raw), HOLD):
                out += word.feed([symbols[b] for b in raw[i:i + HOLD]])
            out += word.finish()
            got = self.ids(out)
            self.pieces[piece] = got  # kept if it is short
        return got

    @staticmethod
    def normal(text: str) -> str:
        """NFC, then lower case letter by letter (no final-sigma rule)."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _word(self, word: str) -> bytes:
        """A run without white space of at most CHUNK characters."""
        if self.cut_special is not None and "<" in word:
            out = []
            for k, part in enumerate(self.cut_special.split(word)):
                if k % 2:
                    out.append(array("i", [self.special[part]]).tobytes())
                elif part:
                    out += [self._piece(p) for p in self.pattern.findall(self.normal(part))]
            return b"".join(out)
        word = self.normal(word)
        if word.isascii() and word.isalpha():
            return self._piece(word)
        return b"".join([self._piece(p) for p in self.pattern.findall(word)])

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids (native int32) of the text in stable order, chunk by chunk."""
        words, at, n = self.words, 0, len(text)
        split = SPLIT_WHITE.split if ODD_SPACE.search(text) else str.split
        known = words.main.get
        while at < n:
            end = min(at + CHUNK, n)
            if end < n:  # cut behind the last white space, if there is one
                last = None
                for last in SPLIT_WHITE.finditer(text, at, end):
                    pass
                if last is None:
                    stop = SPLIT_WHITE.search(text, end)
                    stop = stop.start() if stop else n
                    yield from self._long_word(text, at, stop)
                    at = stop
                    continue
                end = last.end()
            parts = split(text[at:end])
            out = list(map(known, parts))
            if None in out:
                for i in [i for i, got in enumerate(out) if got is None]:
                    got = words.get(parts[i])
                    if got is None:
                        got = words[parts[i]] = self._word(parts[i])  # kept if it is short
                    out[i] = got
            yield b"".join(out)
            at = end

    def _long_word(self, text: str, at: int, stop: int) -> Iterator[bytes]:
        """A run without white space of any length, in constant memory."""
        while at < stop:
            found = self.cut_special.search(text, at, stop) if self.cut_special else None
            yield from self._stream(text, at, found.start() if found else stop)
            if not found:
                break
            yield array("i", [self.special[found.group()]]).tobytes()
            at = found.end()

    def _stream(self, text: str, at: int, stop: int) -> Iterator[bytes]:
        held = ""
        open_word: WordTransducer | None = None  # a run of one class that began before ``held``
        open_class = ""
        while at < stop or held:
            end = min(at + CHUNK, stop)
            while end < stop and not starts_anew(text[end]):
                end += 1
            held += self.normal(text[at:end])
            at, final = end, end >= stop
            done = 0
            if open_word is not None:
                while done < len(held) and self._class(held[done]) == open_class:
                    done += 1
                yield self._feed(open_word, held[:done])
                if done < len(held) or final:
                    yield self.ids(open_word.finish())
                    open_word = None
            if open_word is None:
                for m in self.pattern.finditer(held, done):
                    if m.end() > len(held) - 2 and not final:  # may go on, or be a contraction
                        if len(m.group()) > 4:  # a run: feed it and stay inside it
                            open_word, open_class = WordTransducer(self.merges), self._class(m.group()[-1])
                            yield self._feed(open_word, m.group())
                            done = m.end()
                        break
                    yield self._piece(m.group())
                    done = m.end()
            held = held[done:]
            if final:
                break

    def _feed(self, word: WordTransducer, part: str) -> bytes:
        symbols, raw, out = self.merges.symbols, part.encode("utf-8"), []
        for i in range(0, len(raw), 1024):
            out += word.feed([symbols[b] for b in raw[i:i + 1024]])
        return self.ids(out)

    @staticmethod
    def _class(c: str) -> str:
        k = unicodedata.category(c)[0]
        return k if k in "LN" else "other"


def starts_anew(c: str) -> bool:
    """Text may be cut before ``c`` without changing its NFC form: ``c`` is no
    mark and no Hangul vowel or tail that composes with what precedes it."""
    return unicodedata.category(c)[0] in "LNPSZ" and not unicodedata.combining(c) \
        and not (0x1160 <= ord(c) <= 0x11FF or 0xD7B0 <= ord(c) <= 0xD7FF)


class StreamDecoder:
    """Ids in, text out as soon as it is certain. With a byte-level decoder
    token characters become bytes and bytes become text by an incremental
    UTF-8 machine; without one (the file's ``decoder`` is null) token strings
    are joined by one space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokens = dict(spec["model"]["vocab"])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens.update(special)
        self.byte_level = (spec["decoder"] or {}).get("type") == "ByteLevel"
        back = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        table: list = [None] * (max(tokens.values()) + 1)
        for t, i in tokens.items():
            whole = self.byte_level and t not in special
            table[i] = b"".join(back[c] for c in t) if whole else t.encode("utf-8") if self.byte_level else t
        self.table = np.array(table, dtype=object)
        self.reset()

    def reset(self) -> None:
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: np.ndarray, final: bool = False) -> str:
        parts = self.table[ids].tolist()
        if self.byte_level:
            text = self.machine.decode(b"".join(parts), final)
        else:
            text = (" " if self.begun and parts else "") + " ".join(parts)
            self.begun = self.begun or bool(parts)
        if final:
            self.reset()
        return text


@lru_cache(maxsize=4)
def encoder(path: str) -> StreamEncoder:
    return StreamEncoder(path)


@lru_cache(maxsize=4)
def decoder(path: str) -> StreamDecoder:
    return StreamDecoder(path)


def transcode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids array<int>, decoded string)`` for every row: the whole text
    encoded, and its ids decoded again. Null texts count as empty and give no
    ids. One output row per input row, no shuffle; a worker holds one input
    batch, one output batch and its bounded word tables. Extra columns are not
    carried.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, dec = encoder(path), decoder(path)
        for batch in batches:
            ids, ends, decoded, begun, size = [], [0], [], 0, 0
            for row, t in enumerate(batch.column(1)):
                flat = b"".join(enc.encode(t.as_py() or ""))
                ids.append(flat)
                ends.append(ends[-1] + len(flat) // 4)
                decoded.append(dec.feed(np.frombuffer(flat, dtype=np.int32), final=True))
                size += len(flat) + len(decoded[-1])
                if len(ids) == ROWS or size >= BYTES or row + 1 == batch.num_rows:
                    values = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                    keys = batch.column(0).slice(begun, len(ids))
                    yield pa.RecordBatch.from_arrays([keys, lists, pa.array(decoded, pa.string())],
                                                     names=["key", "ids", "decoded"])
                    ids, ends, decoded, begun, size = [], [0], [], row + 1, 0

    return source.mapInArrow(run, f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)


def ids_text(ids: str = "ids"):
    """Decimal ids joined by one space."""
    return F.array_join(F.col(ids).cast("array<string>"), " ")
