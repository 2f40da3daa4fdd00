"""Byte-level BPE encoding by a public rank file, and decoding.

A text is pre-tokenised in chunks of ``chunk`` characters that overlap by ``overlap``. The pattern looks only
ahead, so from a common boundary on, two chunks agree: the chunk before is followed up to the first boundary
that the next chunk also has, and the next chunk from there. Where a pre-token outruns the overlap, the seam is
read from the text itself until the boundaries meet. The pieces are then merged by rank; equal pieces of a
worker are merged once. Decoding joins the bytes of the tokens.

Texts of one chunk are encoded where they are. The chunks of longer texts are dealt out to all tasks for
pre-tokenising and come back to their text for the seams, so one very long text does not keep one task busy
with the pattern.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import annotate, col, struct_array
from docketry.sources.scratch import materialise

CHUNK = 1 << 16
OVERLAP = 256
# Characters the pattern may look at beyond the end of a pre-token.
AHEAD = 3
# Distinct pieces in a generation of what a worker remembers; it keeps two.
REMEMBERED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge neighbours of the lowest rank, leftmost first, until none can; O(n log n)."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, size = heapq.heappop(queue)
        left = part[i]
        j = after[i]
        if left is None or j >= n or len(left) + len(part[j]) != size:
            continue
        part[i], part[j] = left + part[j], None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(part[i] + part[k])) is not None:
                heapq.heappush(queue, (r, i, len(part[i]) + len(part[k])))
        if (h := before[i]) >= 0 and (r := ranks.get(part[h] + part[i])) is not None:
            heapq.heappush(queue, (r, h, len(part[h]) + len(part[i])))
    return [ranks[p] for p in part if p is not None]


def chunk_starts(length: int, chunk: int) -> range:
    return range(0, max(length, 1), chunk)


def chunk_ends(text: str, pattern, last: bool) -> list[int]:
    """Ends of the pre-tokens of one chunk that what follows it cannot change."""
    ends = [m.end() for m in pattern.finditer(text)]
    return ends if last else [e for e in ends if e <= len(text) - AHEAD]


def stitch(text: str, starts: list[int], ends: list[list[int]], pattern) -> list[int]:
    """Ends of the pre-tokens of ``text`` from those of its overlapping chunks, all in positions of the text."""
    out = [e for e in ends[0]]
    for start, own in zip(starts[1:], ends[1:]):
        known = {start, *own}
        # Drop what lies behind the first common boundary at or after the start of this chunk.
        at = int(np.searchsorted(out, start))
        meet = next((i for i in range(at, len(out)) if out[i] in known), None)
        if meet is not None:
            here = out[meet]
            del out[meet + 1 :]
        else:
            here = out[-1] if out else 0
            limit = own[-1] if own else start
            while here not in known and here < limit:
                here = pattern.match(text, here).end()
                out.append(here)
            if here not in known:
                # The chunk has no boundary of its own left: the next one starts from here.
                continue
        out += own[int(np.searchsorted(own, here, side="right")) :]
    while (here := out[-1] if out else 0) < len(text):
        out.append(pattern.match(text, here).end())
    return out


def pretokens(text: str, pattern, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """The pre-tokens of ``text``, through overlapping chunks where it is longer than one."""
    if len(text) <= chunk:
        return pattern.findall(text)
    starts = list(chunk_starts(len(text), chunk))
    ends = [[s + e for e in chunk_ends(text[s : s + chunk + overlap], pattern, s + chunk + overlap >= len(text))] for s in starts]
    return cut(text, stitch(text, starts, ends, pattern))


def cut(text: str, ends: list[int]) -> list[str]:
    return [text[a:b] for a, b in zip(chain([0], ends), ends)]


class Encoder:
    """Encodes and decodes; remembers the tokens of recent pieces as text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.text_of = {str(rank): token for token, rank in ranks.items()}
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def written(self, pieces: list[str]) -> str:
        """The ids of the pieces in decimal, joined by single spaces."""
        young, old = self.young, self.old
        for p in set(pieces):
            if p not in young:
                young[p] = old.get(p) or " ".join(map(str, merge(p.encode(), self.ranks)))
        written = " ".join([young[p] for p in pieces])
        if len(young) > REMEMBERED:
            # Frequent pieces come back from the old generation, so only rare ones are merged again.
            self.old, self.young = young, {}
        return written

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.written(pretokens(text, self.pattern)).split()]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def digests(self, pieces: list[str]) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of the written ids, SHA-256 of the bytes they decode to."""
        written = self.written(pieces)
        ids = written.split(" ") if written else []
        decoded = b"".join(map(self.text_of.__getitem__, ids))
        return len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


_encoders: dict[str, Encoder] = {}


def _encoder(shared, key: str) -> Encoder:
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(*shared.value)
    return _encoders[key]


DIGESTS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
TOKENS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])


def _results(encoder: Encoder, rows: list[list[str]], kind: T.StructType) -> pa.StructArray:
    """The fields of ``kind`` for rows of pre-tokens."""
    made: dict[str, pa.Array] = {}
    if "n_tokens" in kind.names:
        digests = [encoder.digests(pieces) for pieces in rows]
        for i, (name, dtype) in enumerate((("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()))):
            made[name] = pa.array([d[i] for d in digests], dtype)
    if "ids" in kind.names:
        made["ids"] = pa.array([np.fromstring(encoder.written(pieces), np.int32, sep=" ") for pieces in rows], pa.list_(pa.int32()))
    return struct_array(**made)


def _encode(
    df: DataFrame, text_col: str, ranks_path: str, pattern: str, name: str, carry: list[str] | None, result: T.StructType, chunk: int, overlap: int
) -> DataFrame:
    spark: SparkSession = df.sparkSession
    # The rank file has a fixed number of entries, whatever the corpus.
    ranks = read_ranks(ranks_path)
    shared, key = spark.sparkContext.broadcast((ranks, pattern)), f"{ranks_path}\n{pattern}"
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() != name.lower()]
    text = F.coalesce(col(text_col), F.lit(""))
    source = df.select(*[col(c) for c in kept], text.alias("__text"))

    def start():
        encoder = _encoder(shared, key)
        return lambda texts: _results(encoder, [encoder.pattern.findall(t) for t in texts], result)

    short = annotate(source.filter(F.length("__text") <= chunk), [F.col("__text")], name, result, start, kept)
    at = F.sequence(F.lit(0), F.floor((F.length("__text") - 1) / chunk).cast("int"))
    chunks = (
        source.filter(F.length("__text") > chunk)
        .withColumn("__row", F.monotonically_increasing_id())
        .select(*[col(c) for c in kept], "__row", "__text", F.explode(at).alias("__chunk"))
        .select(
            # What belongs to the whole row travels with its first chunk.
            *[F.when(F.col("__chunk") == 0, col(c)).alias(c) for c in kept],
            "__row",
            "__chunk",
            (F.length("__text") <= (F.col("__chunk") + 1) * chunk + overlap).alias("__last"),
            F.substring("__text", F.col("__chunk") * chunk + 1, F.lit(chunk + overlap)).alias("__text"),
        )
    )
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in source.schema.fields[: len(kept)]], T.StructField(name, result)])
    # Written before it is dealt out, so that row numbers stay when a task runs again.
    dealt = materialise(chunks.repartition("__row", "__chunk"), "bpe-chunks")
    n = len(kept)

    def start_ends():
        encoder = _encoder(shared, key)

        def ends(texts: list[str], last: list[bool]) -> pa.StructArray:
            found = [chunk_ends(t, encoder.pattern, x) for t, x in zip(texts, last)]
            return struct_array(ends=pa.array(found, pa.list_(pa.int32())))

        return ends

    marked = annotate(dealt, [F.col("__text"), F.col("__last")], "__found", T.StructType([T.StructField("ends", T.ArrayType(T.IntegerType()))]), start_ends)
    together = marked.repartition("__row").sortWithinPartitions("__row", "__chunk")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, key)
        row, head, texts, ends = None, None, [], []

        def close() -> pa.RecordBatch:
            starts = [i * chunk for i in range(len(texts))]
            whole = "".join([t[:chunk] for t in texts[:-1]] + texts[-1:])
            placed = [[s + e for e in own] for s, own in zip(starts, ends)]
            pieces = cut(whole, stitch(whole, starts, placed, encoder.pattern))
            return pa.RecordBatch.from_arrays([*[head.column(i) for i in range(n)], _results(encoder, [pieces], result)], names=[*kept, name])

        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                if (number := one.column(n)[0].as_py()) != row:
                    if row is not None:
                        yield close()
                    row, head, texts, ends = number, one, [], []
                texts.append(one.column(n + 3)[0].as_py())
                ends.append(one.column(n + 4).field("ends")[0].as_py())
        if row is not None:
            yield close()

    columns = [*[col(c).alias(f"__kept_{i}") for i, c in enumerate(kept)], F.col("__row"), F.col("__chunk"), F.col("__last"), F.col("__text"), F.col("__found")]
    return short.unionByName(together.select(*columns).mapInArrow(join, schema))


def encode(
    df: DataFrame,
    text_col: str,
    ranks_path: str,
    pattern: str,
    name: str = "tokens",
    carry: list[str] | None = None,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    digests: bool = False,
) -> DataFrame:
    """``df`` (or its ``carry`` columns) with a struct ``name`` whose ``ids`` are the tokens of the whole text.

    With ``digests`` the fields of :func:`round_trip` come before them. A null text counts as empty and has no
    tokens; repeated rows stay; an empty table gives an empty result. The order of rows is not kept. A column
    called ``name`` gives way.
    """
    kind = T.StructType([*(DIGESTS.fields if digests else []), *TOKENS.fields])
    return _encode(df, text_col, ranks_path, pattern, name, carry, kind, chunk, overlap)


def round_trip(df: DataFrame, text_col: str, ranks_path: str, pattern: str, name: str = "tokens", carry: list[str] | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """As :func:`encode`, with ``n_tokens`` and SHA-256 digests of the ids, in decimal and joined by one space, and of the bytes they decode to."""
    return _encode(df, text_col, ranks_path, pattern, name, carry, DIGESTS, chunk, overlap)


def decode(df: DataFrame, ids: str, ranks_path: str, name: str = "decoded", carry: list[str] | None = None) -> DataFrame:
    """``df`` with a struct ``name`` whose ``bytes`` are the raw bytes of the tokens; null ids decode to nothing.

    ``text`` is the same as UTF-8, null where the bytes are not valid.
    """
    shared, key = df.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), "")), f"{ranks_path}\n"

    def start():
        encoder = _encoder(shared, key)

        def score(rows: list[list[int] | None]) -> pa.StructArray:
            raw = [encoder.decode(r or []) for r in rows]
            texts = []
            for r in raw:
                try:
                    texts.append(r.decode())
                except UnicodeDecodeError:
                    texts.append(None)
            return struct_array(bytes=pa.array(raw, pa.binary()), text=pa.array(texts, pa.string()))

        return score

    return annotate(df, [col(ids)], name, T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("text", T.StringType())]), start, carry)
