"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Normalising lower-cases A-Z and keeps words of ASCII letters, digits and characters beyond ASCII. Every distinct word of
the items becomes a few characters, each from an alphabet of its own, so that a match starts and ends at words; a word
of no item becomes others. However many words there are, the alphabets stay narrow, and so do the automaton's nodes.

Items are cut into blocks of ``(window + 1) // 2`` words one after the other: any ``window`` consecutive words of an item
hold a whole block. The automaton's patterns are the blocks, and all of an item shorter than a window, so it has about
one path per item word, some 20 bytes for a byte of item text. Texts are scanned once; around a block the windows that
hold it are looked up among the items' windows, which are kept as sorted hashes and compared word by word. A match ends
at a word number, and for the spans returned word numbers are mapped to code points of the original text.

One automaton serves ``block_bytes`` of item text (24 MB, half a GB in a worker). A larger test set is cut into parts by
a hash, long items first into overlapping pieces, and each part is a scan of its own; the results add up to the same rows.
Nothing about documents reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import LOWER, annotate, col, struct_array, written
from docketry.sources.scratch import mark, release

WINDOW = 13
BLOCK_BYTES = 24 << 20
# Bytes of an item's words that stay together when a test set is cut into parts.
PIECE_BYTES = 1 << 20

_KEPT = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in LOWER)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("words", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ]
)


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_KEPT).split()


def code(number: int, digits: int) -> str:
    """``digits`` characters for a word number, from alphabets of 64 that follow each other."""
    return "".join(chr(0x40 * (i + 1) + (number >> 6 * (digits - 1 - i) & 63)) for i in range(digits))


class Matcher:
    """The automaton over one part of the test set, and its windows."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], size: int):
        self.size, self.block = size, (size + 1) // 2
        listed = [(item_id, words_of(text)) for item_id, text in items]
        numbers: dict[bytes, int] = {}
        for _, words in listed:
            for w in words:
                numbers.setdefault(w, len(numbers))
        digits = 3
        while 64**digits < len(numbers):
            digits += 1
        self.digits, self.codes, self.other = digits, {w: code(n, digits) for w, n in numbers.items()}, "\0" * digits
        self.ids = sorted({i for i, _ in listed if i is not None})
        place, owner_of = {i: n for n, i in enumerate(self.ids)}, {}
        self.automaton, texts, hashes, starts, owners, at = ahocorasick.Automaton(), [], [], [], [], 0
        for item_id, words in listed:
            coded = "".join([self.codes[w] for w in words])
            owner = -1 if item_id is None else place[item_id]
            if 0 < len(words) < size:
                owner_of.setdefault(coded, set()).add(owner)
            elif words:
                self._add_blocks(coded, len(words))
                made = self._hashes(coded, range(len(words) - size + 1))
                hashes.append(made)
                starts.append(np.arange(at, at + len(made), dtype=np.int64))
                owners.append(np.full(len(made), owner, np.int32))
                texts.append(coded)
                at += len(words)
        for coded, who in owner_of.items():
            # A short item may also be a block.
            self.automaton.add_word(coded, (len(coded) // digits, coded in self.automaton, tuple(sorted(who))))
        self.text = "".join(texts)
        self._keep_windows(*(np.concatenate(x) if x else np.array([], t) for x, t in ((hashes, np.uint64), (starts, np.int64), (owners, np.int32))))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def _add_blocks(self, coded: str, words: int) -> None:
        step = self.block * self.digits
        for a in range(0, words * self.digits - step + 1, step):
            self.automaton.add_word(coded[a : a + step], (self.block, True, ()))

    def _hashes(self, coded: str, places) -> np.ndarray:
        raw, d, n = coded.encode("utf-16-le"), 2 * self.digits, 2 * self.digits * self.size
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(raw[d * i : d * i + n]) for i in places), np.uint64, len(places))

    def _keep_windows(self, hashes: np.ndarray, starts: np.ndarray, owners: np.ndarray) -> None:
        """Distinct windows by hash, each with a place in ``text`` and its range of ``owners``; windows of one hash must be equal."""
        order = np.lexsort((owners, hashes))
        hashes, starts, owners = hashes[order], starts[order], owners[order]
        first = np.ones(len(hashes), bool)
        first[1:] = hashes[1:] != hashes[:-1]
        again = np.flatnonzero(~first)
        if any(self._window(starts[i]) != self._window(starts[i - 1]) for i in again.tolist()):
            raise ValueError("two windows have one hash")
        self.hashes, self.starts = hashes[first], starts[first]
        fresh = first.copy()
        fresh[1:] |= owners[1:] != owners[:-1]
        self.owners = owners[fresh]
        self.ranges = np.r_[np.searchsorted(np.flatnonzero(fresh), np.flatnonzero(first)), len(self.owners)]

    def _window(self, start: int) -> str:
        return self.text[start * self.digits : (start + self.size) * self.digits]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges ``[start, end)`` inside occurrences, merged, and the items that occur."""
        if self.empty or not words:
            return [], set()
        find, other, size = self.codes.get, self.other, self.size
        coded = "".join([find(w, other) for w in words])
        ranges, owners, wanted = [], set(), set()
        for at, (length, block, who) in self.automaton.iter(coded):
            end = (at + 1) // self.digits
            if who:
                ranges.append((end - length, end))
                owners.update(who)
            if block:
                wanted.update(range(max(0, end - size), min(end - self.block, len(words) - size) + 1))
        if wanted:
            places = sorted(wanted)
            hashes = self._hashes(coded, places)
            at = np.searchsorted(self.hashes, hashes)
            at[at == len(self.hashes)] = 0
            seen = set()
            for i in np.flatnonzero(self.hashes[at] == hashes).tolist():
                start, known = places[i], int(at[i])
                if coded[start * self.digits : (start + size) * self.digits] == self._window(int(self.starts[known])):
                    ranges.append((start, start + size))
                    seen.add(known)
            for known in seen:
                owners.update(self.owners[self.ranges[known] : self.ranges[known + 1]].tolist())
        return merged(ranges), {self.ids[o] for o in owners if o >= 0}


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(raw: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as ranges of code points in the original text."""
    if not ranges:
        return []
    words = [m.span() for m in _WORD.finditer(raw)]
    at, seen, out = 0, 0, []
    for a, b in ranges:
        pair = []
        for byte in (words[a][0], words[b - 1][1]):
            seen += len(raw[at:byte].decode("utf-8", "replace"))
            at = byte
            pair.append(seen)
        out.append((pair[0], pair[1]))
    return out


# The matcher of the block a worker process is busy with, by block.
_built: dict[str, Matcher] = {}


def _pass(df: DataFrame, text_col: str, items, key: str, size: int, name: str, carry: list[str] | None, before: bool) -> DataFrame:
    """One scan of all texts against one block; ``before`` adds to the struct ``name`` of earlier blocks."""

    def start():
        if key not in _built:
            _built.clear()
            _built[key] = Matcher(items.value, size)
        matcher = _built[key]

        def score(texts: list[bytes | None], earlier: list[dict | None]) -> pa.StructArray:
            n_words, n_hit, ids, ranges, places = [], [], [], [], []
            for raw, old in zip(texts, earlier):
                words = words_of(raw)
                found, named = matcher.find(words)
                if old:
                    found = merged(found + [(x["start"], x["end"]) for x in old["words"]])
                    named = named | set(old["item_ids"])
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in found))
                ids.append(sorted(named))
                ranges.append([{"start": a, "end": b} for a, b in found])
                places.append([{"start": a, "end": b} for a, b in original_spans(raw or b"", found)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return struct_array(
                n_words=pa.array(n_words, pa.int64()),
                n_hit=pa.array(n_hit, pa.int64()),
                item_ids=pa.array(ids, pa.list_(pa.string())),
                words=pa.array(ranges, kind),
                spans=pa.array(places, kind),
            )

        return score

    return annotate(df, [text_col, col(name) if before else F.lit(None).cast("int")], name, RESULT, start, carry)


def _pieces(items: DataFrame, size: int, piece_bytes: int) -> DataFrame:
    """Items as normalised words, long ones in pieces that overlap by a word less than a window, so that no window is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                ends = np.cumsum([len(w) + 1 for w in words]) if words else np.array([], np.int64)
                a = 0
                while a < len(words):
                    b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + piece_bytes)), a + size)
                    # What is left must be a window at least, else a short rest would be an item of its own.
                    b = len(words) if len(words) - b < size else b
                    yield pa.RecordBatch.from_arrays([pa.array([item_id], pa.string()), pa.array([b" ".join(words[a:b])], pa.binary())], names=["id", "text"])
                    a = b if b == len(words) else b - size + 1

    return items.mapInArrow(run, "id string, text binary").distinct()


def contamination(
    docs: DataFrame,
    bench: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    name: str = "contamination",
    carry: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its ``carry`` columns) with a struct ``name``.

    Its fields: ``n_words``; ``n_hit``, the words inside an occurrence of a window; ``item_ids``, the items with
    occurring windows as sorted strings; ``words`` and ``spans``, the hit ranges as word numbers and as code
    points of the original. A null or empty text has no words. Items without words match nothing; an item
    without an id marks words but is not listed; repeated items count once. An empty test set hits nothing, and an
    empty table gives an empty result. Repeated rows are judged each; items and texts of any length are taken
    whole. A column called ``name`` gives way, others pass through whatever their names.
    """
    spark, begun = docs.sparkSession, mark()
    items = bench.select(col(item_col).cast("string").alias("id"), col(item_text_col).cast("binary").alias("text"))
    pieces, pieces_path = written(_pieces(items, window, min(PIECE_BYTES, block_bytes)), "test-items")
    total = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    out, needed = docs, []
    for i in range(blocks):
        part = pieces.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == i)
        rows = spark.sparkContext.broadcast([(r["id"], bytes(r["text"])) for r in part.collect()])
        last = i == blocks - 1
        keep = carry if last else [*dict.fromkeys([*(docs.columns if carry is None else carry), text_col])]
        out = _pass(out, text_col, rows, uuid4().hex, window, name, keep, i > 0)
        if not last:
            out, path = written(out, "contamination")
            needed = [path]
        release(spark, begun, keep=[*needed, *([] if last else [pieces_path])])
    return out
