"""Line dedup with two Bloom filters, exact on the lines they suspect.

A line's key is the line without white space at its ends, A-Z lower-cased; a key is known by its 128-bit XXH3 hash.
Two Bloom filters over the hashes, one for keys seen once and one for keys seen again, tell which keys may repeat:
tasks send the places their keys set, as sorted numbers by segment of the filter, and a place that two documents set
is set in the second filter. Only keys all of whose places are set there are suspected, and only those are shuffled,
as hash, row and line number: counted exactly, with their first occurrence. Lines seen once stay where they are, and
so do all texts: the lines to drop come back to them in one small table per task that has written rows.

The second filter goes to every task; it has ``filter_bits`` bits (64 MB) whatever the input. When it fills up, more
lines are suspected and shuffled, none is lost: with n different keys the share of single ones suspected is about
``(1 - exp(-HASHES * n / filter_bits)) ** HASHES``, 0.1 % at ten million keys and 18 % at 150 million.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import CHUNK, LOWER, Marks, annotate, col, join_marks, struct_array, write_marks, written
from docketry.sources.scratch import mark, materialise, release

SPACES = b" \t\n\x0b\x0c\r"
FILTER_BITS = 1 << 29
HASHES = 2
# Bits of a segment of the filters, which one task merges at a time.
SEGMENT = 1 << 20
# Places a task holds before it sends them.
HELD = 1 << 21
NO_KEY = bytes(16)

KEYS = T.StructType([T.StructField("digests", T.BinaryType())])
RESULT = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("text", T.StringType())])


def digests(raw: bytes | None, min_chars: int = 1) -> bytes:
    """16 bytes for each line of a text: the hash of its key, or zeros for a key under ``min_chars`` code points."""
    out, digest = [], xxhash.xxh3_128_digest
    for line in (raw or b"").translate(LOWER).split(b"\n"):
        key = line.strip(SPACES)
        short = len(key) < min_chars or (min_chars > 1 and len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars)
        out.append(NO_KEY if short else digest(key))
    return b"".join(out)


def _own_keys(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The different keys of a text as rows of two numbers, and the line where each stands first."""
    pairs = np.frombuffer(raw, np.uint64).reshape(-1, 2)
    lines = np.flatnonzero(pairs.any(axis=1))
    # Sorted by the first number; equal ones are told apart by the second.
    order = lines[np.lexsort((lines, pairs[lines, 1], pairs[lines, 0]))]
    first = np.ones(len(order), bool)
    first[1:] = (pairs[order[1:]] != pairs[order[:-1]]).any(axis=1)
    return pairs[order[first]], order[first]


def _places(keys: np.ndarray, filter_bits: int) -> np.ndarray:
    """``HASHES`` places in the filter for each key."""
    step = keys[:, 1] | np.uint64(1)
    return np.stack([(keys[:, 0] + np.uint64(i) * step) & np.uint64(filter_bits - 1) for i in range(HASHES)], axis=1)


def _sent_places(stored: DataFrame, filter_bits: int) -> DataFrame:
    """Per task and segment the places set by its documents' keys, and those set by two or more of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent() -> pa.RecordBatch:
            places, times = np.unique(np.concatenate(held) if held else np.array([], np.uint64), return_counts=True)
            segments = (places // SEGMENT).astype(np.int64)
            kinds, starts = np.unique(segments, return_index=True)
            offsets, rows = (places % SEGMENT).astype(np.uint32), []
            for k, a, b in zip(kinds.tolist(), starts.tolist(), [*starts[1:].tolist(), len(places)]):
                rows.append((k, offsets[a:b].tobytes(), offsets[a:b][times[a:b] > 1].tobytes()))
            kept = [list(x) for x in zip(*rows)] or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(kept[0], pa.int32()), pa.array(kept[1], pa.binary()), pa.array(kept[2], pa.binary())], names=["segment", "once", "again"])

        for batch in batches:
            for raw in batch.column(0).to_pylist():
                # A key sets each of its places once per document.
                held.append(np.unique(_places(_own_keys(raw)[0], filter_bits), axis=None))
                size += len(held[-1])
                if size >= HELD:
                    yield sent()
                    held, size = [], 0
        yield sent()

    return stored.select("__keys.digests").mapInArrow(run, "segment int, once binary, again binary")


def _merged(sent: DataFrame) -> DataFrame:
    """The second filter by segment: places set in two messages, or twice in one. Messages stream, so a task holds one segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, again = None, np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"segment": pa.array([now], pa.int32()), "bits": pa.array([zlib.compress(np.packbits(again, bitorder="little").tobytes(), 1)], pa.binary())})

        for batch in batches:
            for segment, seen, twice in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if segment != now:
                    if now is not None:
                        yield closed()
                    now = segment
                    once[:], again[:] = False, False
                places = np.frombuffer(seen, np.uint32)
                again[places[once[places]]] = True
                again[np.frombuffer(twice, np.uint32)] = True
                once[places] = True
        if now is not None:
            yield closed()

    return sent.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, "segment int, bits binary")


# The filter a worker process looks into, by run.
_opened: dict[str, np.ndarray] = {}


def _suspects(stored: DataFrame, bits, run_id: str, filter_bits: int) -> DataFrame:
    """The keys of each row (``__row``, hash in two longs, first line) whose places are all set in the second filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if run_id not in _opened:
            _opened.clear()
            whole = np.zeros(filter_bits // 8, np.uint8)
            for segment, packed in bits.value:
                part = np.frombuffer(zlib.decompress(packed), np.uint8)
                whole[segment * (SEGMENT // 8) :][: len(part)] = part
            _opened[run_id] = whole
        again = _opened[run_id]
        for batch in batches:
            rows, keys, lines = [], [], []
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own, first = _own_keys(raw)
                places = _places(own, filter_bits)
                hit = ((again[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
                rows.append(np.full(int(hit.sum()), row, np.int64))
                keys.append(own[hit])
                lines.append(first[hit])
            if rows:
                pairs = np.concatenate(keys).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), pa.array(np.concatenate(lines).astype(np.int64))], names=["row", "a", "b", "line"])

    return stored.select("__row", "__keys.digests").mapInArrow(run, "row long, a long, b long, line long")


def dedup(
    df: DataFrame,
    text_col: str = "text",
    min_docs: int = 2,
    min_chars: int = 1,
    keep_first: bool = True,
    filter_bits: int = FILTER_BITS,
    name: str = "lines",
    carry: list[str] | None = None,
) -> DataFrame:
    """``df`` (or its ``carry`` columns) with a struct ``name``: ``n_lines`` before dropping, ``n_dropped``, ``text``.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose their lines; with
    ``keep_first`` the first line of the first row stays. Each row is a document, so repeated rows are copies and
    count each; a key that repeats in one document alone is in one document. The first row is the first of the
    table as it is read, which settles ties. A null or empty text is one empty line, which has no key and stays.
    Texts of any length are worked line by line. An empty table gives an empty result; a column called ``name``
    gives way, all others pass through whatever their names.

    What tasks hold: a batch of texts, the places of ``HELD`` keys, one segment or the second filter.
    """
    spark, begun = df.sparkSession, mark()
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() != name.lower()]
    inside = {c: f"__column_{i}" for i, c in enumerate(kept)}
    source = df.select(*[col(c).alias(n) for c, n in inside.items()], col(text_col).cast("string").alias("__text"), F.monotonically_increasing_id().alias("__row"))

    def start():
        return lambda texts: struct_array(digests=pa.array([digests(t, min_chars) for t in texts], pa.binary()))

    stored, stored_path = written(annotate(source, ["__text"], "__keys", KEYS, start), "line-keys")
    parts = [(r["segment"], bytes(r["bits"])) for r in _merged(_sent_places(stored, filter_bits)).collect()]
    bits = spark.sparkContext.broadcast(parts)
    suspects = materialise(_suspects(stored, bits, uuid4().hex, filter_bits), "line-suspects")
    counted = suspects.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("row", "line")).alias("first")).filter(F.col("docs") >= min_docs)
    frequent = materialise(counted, "line-keys-frequent")
    gone = join_marks(suspects, frequent, ["a", "b"], "docs", suspects.count()).select("row", "a", "b", (F.col("row") == F.col("first.row")).alias("first"))
    marks_path, marks_uri = write_marks(gone, "line-gone")

    def left():
        marks = _Gone(marks_uri)

        def score(texts: list[bytes | None], keys: list[bytes], rows: list[int]) -> pa.StructArray:
            sizes, dropped, out = [], [], []
            for raw, hashed, row in zip(texts, keys, rows):
                lines = (raw or b"").split(b"\n")
                sizes.append(len(lines))
                if gone := marks.of(row):
                    stay = []
                    for i, line in enumerate(lines):
                        key = hashed[16 * i : 16 * i + 16]
                        if key not in gone:
                            stay.append(line)
                        elif keep_first and gone[key]:
                            gone[key] = False
                            stay.append(line)
                    lines = stay
                dropped.append(sizes[-1] - len(lines))
                out.append(b"\n".join(lines))
            return struct_array(n_lines=pa.array(sizes, pa.int64()), n_dropped=pa.array(dropped, pa.int64()), text=pa.array(out, pa.binary()).cast(pa.string()))

        return score

    made = annotate(stored, ["__text", F.col("__keys.digests"), F.col("__row")], "__lines", RESULT, left, list(inside.values()))
    release(spark, begun, keep=[stored_path, marks_path])
    return made.select(*[col(n).alias(c) for c, n in inside.items()], F.col("__lines").alias(name))


class _Gone(Marks):
    """The keys that rows lose."""

    def __init__(self, uri: str):
        super().__init__(uri, ("a", "b", "first"))

    def of(self, row: int) -> dict[bytes, bool]:
        """The keys of a row, with whether its first line of the key is the first of all."""
        if self.open(row >> CHUNK):
            self.keys = np.stack(self.columns[:2], axis=1).tobytes()
        a, b = np.searchsorted(self.rows, [row, row + 1]).tolist()
        return {self.keys[16 * i : 16 * i + 16]: bool(self.columns[2][i]) for i in range(a, b)}
