"""Near-duplicate groups by SimHash fingerprints and BK-trees.

A text's fingerprint has a bit set where more than half of its shingles' 64-bit hashes have it. Two
fingerprints link when they differ in at most ``radius`` bits; groups are the connected components.

Search. The 64 bits are cut into ``radius + 2`` blocks. Two fingerprints within the radius agree in at
least two blocks, so every distinct fingerprint goes into one shard per pair of blocks, chosen by its bits
there, and no link is lost. A shard holds a BK-tree over its members: the first member is the root and each
child hangs on the edge named by its Hamming distance to the parent. A group grows from one member: its newest members
descend the tree together, at a node only those within the radius of an edge follow it (triangle inequality), and
members that have joined a group are closed to further searches, so thousands of variants of one template are soon
out of the way. A shard returns links that span its groups, not all pairs. Shards are reached by a shuffle: a broadcast
of all trees would grow with the corpus. Copies cost nothing there, because shards hold distinct fingerprints, 8 bytes
each. A large shard is cut into blocks, and each pair of blocks is searched by a task of its own.

Components come from alternating large and small stars over the links, written to the shared folder after
each round.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import LOWER, Marks, annotate, col, join_marks, struct_array, write_marks, written
from docketry.sources.scratch import mark, materialise, release

SEED = 42
# Members up to which a node of the tree is a list compared as a whole, and queries compared with it at a time.
LEAF, QUERIES_AT_ONCE = 256, 1024
# Members without a link that are searched for one by one.
LONELY = 32
# Members of a shard that are searched by one task, and tasks that pairs of such blocks are dealt to at most.
BLOCK, MOST_TASKS = 1 << 14, 1 << 16


def shingle_hashes(raw: bytes | None, words: int) -> list[int]:
    """XXH64 of each run of ``words`` words joined by single spaces; one hash of all words if there are fewer."""
    tokens = (raw or b"").translate(LOWER).split()
    if not tokens:
        return []
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) < words:
        return [digest(joined, SEED)]
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]


def fingerprint(raw: bytes | None, words: int = 4) -> int:
    """Bits set in over half of the shingle hashes; 0 without a word."""
    hashes = shingle_hashes(raw, words)
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    for at in range(0, len(values), 1 << 14):
        ones += np.unpackbits(values[at : at + (1 << 14)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text_col: str, words: int = 4, carry: list[str] | None = None, name: str = "simhash") -> DataFrame:
    """``df`` with a struct column ``name`` whose field ``bits`` is the fingerprint as a signed long."""

    def start():
        def score(texts: list[bytes | None]) -> pa.StructArray:
            bits = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            return struct_array(bits=pa.array(bits))

        return score

    return annotate(df, [text_col], name, T.StructType([T.StructField("bits", T.LongType())]), start, carry)


class Shard:
    """The members of one shard in a BK-tree, and the links found so far."""

    def __init__(self, members: np.ndarray, radius: int):
        self.members, self.radius = members, radius
        self.open = np.ones(len(members), bool)

    def tree(self, which: np.ndarray):
        """Nested (root, {distance: subtree}); a small set of members stays an array."""
        if len(which) <= LEAF:
            return which
        root, rest = which[0], which[1:]
        distance = np.bitwise_count(self.members[rest] ^ self.members[root])
        return root, {int(d): self.tree(rest[distance == d]) for d in np.unique(distance)}

    def near(self, node, queries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Open members below ``node`` within the radius of a query, each once, with one such query; they are closed then."""
        if not len(queries):
            return
        if isinstance(node, tuple):
            root, children = node
            distance = np.bitwise_count(self.members[queries] ^ self.members[root]).astype(np.int16)
            if self.open[root] and (distance <= self.radius).any():
                self.open[root] = False
                yield int(queries[distance.argmin()]), np.array([root])
            for edge, child in children.items():
                yield from self.near(child, queries[np.abs(distance - edge) <= self.radius])
            return
        left = node[self.open[node]]
        for at in range(0, len(queries), QUERIES_AT_ONCE):
            if not len(left):
                return
            some = queries[at : at + QUERIES_AT_ONCE]
            close = np.bitwise_count(self.members[left][:, None] ^ self.members[some][None, :]) <= self.radius
            found = close.any(axis=1)
            if found.any():
                hit, by = left[found], some[close[found].argmax(axis=1)]
                self.open[hit] = False
                left = left[~found]
                for q in np.unique(by).tolist():
                    yield q, hit[by == q]

    def paired(self, node, queries: np.ndarray, out: np.ndarray) -> None:
        """Mark in ``out`` the members below ``node`` with another query within the radius; every member must be a query."""
        if isinstance(node, tuple):
            root, children = node
            distance = np.bitwise_count(self.members[queries] ^ self.members[root]).astype(np.int16)
            out[root] = (distance <= self.radius).sum() > 1
            for edge, child in children.items():
                self.paired(child, queries[np.abs(distance - edge) <= self.radius], out)
            return
        found = np.zeros(len(node), np.int64)
        for at in range(0, len(queries), QUERIES_AT_ONCE):
            some = queries[at : at + QUERIES_AT_ONCE]
            found += (np.bitwise_count(self.members[node][:, None] ^ self.members[some][None, :]) <= self.radius).sum(axis=1)
        out[node] = found > 1

    def links(self) -> list[tuple[int, int]]:
        """Links that span the groups: each group grows from one member, and what has joined a group is not searched for again.

        When ``LONELY`` members in a row have had no link, those that are left and have none are found in one descent.
        """
        out, lonely = [], 0
        node = self.tree(np.arange(len(self.members)))
        for first in range(len(self.members)):
            if not self.open[first]:
                continue
            self.open[first] = False
            front, before = np.array([first]), len(out)
            while len(front):
                made = list(self.near(node, front))
                out += [(q, m) for q, found in made for m in found.tolist()]
                front = np.concatenate([found for _, found in made]) if made else front[:0]
            lonely = lonely + 1 if len(out) == before else 0
            if lonely == LONELY:
                left, some = np.flatnonzero(self.open), np.zeros(len(self.members), bool)
                node = self.tree(left)
                self.paired(node, left, some)
                self.open &= some
                node = self.tree(np.flatnonzero(self.open))
        return out


def shard_links(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Both ends of the links that span the groups of a shard."""
    if len(members) <= LEAF:
        # A tree that is one leaf: most shards have a few members and no link.
        if not (np.bitwise_count(members[:, None] ^ members[None, :]) <= radius).sum() > len(members):
            return members[:0], members[:0]
    ends = np.array(Shard(members, radius).links(), np.int64).reshape(-1, 2)
    return members[ends[:, 0]], members[ends[:, 1]]


def _blocks(radius: int) -> list[tuple[int, int]]:
    cuts = [round(i * 64 / (radius + 2)) for i in range(radius + 3)]
    return list(zip(cuts, cuts[1:]))


def _bits(value: Column, lo: int, hi: int) -> Column:
    return F.shiftrightunsigned(value, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))


def near_links(nodes: DataFrame, bits_col: str, radius: int, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that span every group within the radius.

    A shard's members arrive sorted and stream through the task. A shard of more than ``block`` members leaves as blocks of
    that size, and each pair of its blocks is searched by a task of its own, so no task holds more than two blocks.
    """
    if not 0 <= radius <= 14:
        raise ValueError("radius must be 0 to 14")
    bits = col(bits_col)
    keys = [
        F.struct(F.lit(i).alias("table"), F.shiftleft(_bits(bits, *x), y[1] - y[0]).bitwiseOR(_bits(bits, *y)).alias("part"))
        for i, (x, y) in enumerate(combinations(_blocks(radius), 2))
    ]
    sharded = (
        nodes.filter(bits.isNotNull())
        .select(bits.alias("bits"), F.explode(F.array(*keys)).alias("key"))
        .select("key.table", "key.part", "bits")
        .repartition("table", "part")
        .sortWithinPartitions("table", "part", "bits")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, size, blocks = None, [], 0, 0

        def closed(left: list, right: list, cut: list) -> None:
            if blocks and size:
                cut.append((*key, blocks, np.concatenate(members).tobytes()))
            elif size > 1:
                a, b = shard_links(np.unique(np.concatenate(members)), radius)
                left.append(a)
                right.append(b)

        for batch in batches:
            table, part, bits = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            change = np.flatnonzero((np.diff(table) != 0) | (np.diff(part) != 0)) + 1
            starts, ends = np.r_[0, change].tolist(), np.r_[change, len(table)].tolist()
            left, right, cut = [], [], []
            for a, b in zip(starts, ends) if len(table) else ():
                if (int(table[a]), int(part[a])) != key:
                    closed(left, right, cut)
                    key, members, size, blocks = (int(table[a]), int(part[a])), [], 0, 0
                for at in range(a, b, block):
                    if size >= block:
                        cut.append((*key, blocks, np.concatenate(members).tobytes()))
                        members, size, blocks = [], 0, blocks + 1
                    members.append(bits[at : min(b, at + block)].view(np.uint64))
                    size += len(members[-1])
            yield _found(left, right, cut)
        left, right, cut = [], [], []
        closed(left, right, cut)
        yield _found(left, right, cut)

    found, _ = written(sharded.mapInArrow(run, "a long, b long, table int, part long, block int, members binary"), "simhash-shards")
    blocks = found.filter("members IS NOT NULL").select("table", "part", "block", "members")
    ends = blocks.groupBy("table", "part").agg(F.max("block").alias("last"))
    # Block i meets every block j from it on; each pair of them has a key of its own.
    pairs = blocks.join(ends, ["table", "part"]).select(
        "table", "part", "members", F.explode(F.expr("transform(sequence(0, last), j -> struct(least(block, j) AS i, greatest(block, j) AS j))")).alias("pair")
    )
    wanted = ends.agg(F.sum((F.col("last") + 1) * (F.col("last") + 2) / 2)).first()[0] or 1
    met = pairs.select("table", "part", "pair.i", "pair.j", "members").repartition(int(min(max(wanted, 1), MOST_TASKS)), "table", "part", "i", "j")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []
        for batch in batches:
            left, right = [], []
            for *this, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if this != key:
                    if members:
                        a, b = shard_links(np.unique(np.concatenate(members)), radius)
                        left.append(a)
                        right.append(b)
                    key, members = this, []
                members.append(np.frombuffer(raw, np.uint64))
            yield _found(left, right, []).select(["a", "b"])
        if members:
            a, b = shard_links(np.unique(np.concatenate(members)), radius)
            yield _found([a], [b], []).select(["a", "b"])

    across = met.sortWithinPartitions("table", "part", "i", "j").mapInArrow(join, "a long, b long")
    return found.filter("members IS NULL").select("a", "b").unionByName(across).distinct()


def _found(left: list, right: list, cut: list) -> pa.RecordBatch:
    """Links, and blocks of shards that were too large."""
    a, b = (np.concatenate(x).view(np.int64) if x else np.array([], np.int64) for x in (left, right))
    table, part, block, members = zip(*cut) if cut else ((), (), (), ())
    none, n = len(cut), len(a)
    columns = [pa.array([*a.tolist(), *[None] * none], pa.int64()), pa.array([*b.tolist(), *[None] * none], pa.int64())]
    for values, kind in ((table, pa.int32()), (part, pa.int64()), (block, pa.int32()), (members, pa.binary())):
        columns.append(pa.array([*[None] * n, *values], kind))
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "table", "part", "block", "members"])


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected links ``(a, b)``; the root is the smallest node.

    Large star: every node hands its larger neighbours to its smallest one. Small star: every node hands
    its smaller neighbours to the smallest. Both keep the components; when nothing changes, each node hangs
    on its root. Minima combine before the shuffle, and each round is a table in the shared folder.
    """
    spark = links.sparkSession
    edges = materialise(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        found = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(found) == state or not found["n"]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct() if found["n"] else spark.createDataFrame([], "node long, root long")
        state = tuple(found)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialise(small.select("e.a", "e.b").filter("a != b").distinct(), "links")


def _stored(df: DataFrame, kept: list[str], id_col: str, text_col: str, words: int) -> tuple[DataFrame, str]:
    """``kept`` columns, ``__id``, a row number and the fingerprint, written once, and where: the texts are read once."""
    text = [] if text_col in kept else [col(text_col)]
    source = df.select(*[col(c) for c in kept], *text, col(id_col).alias("__id"), F.monotonically_increasing_id().alias("__row"))
    return written(fingerprints(source, text_col, words, [*kept, "__id", "__row"]), "simhash")


def _labels(stored: DataFrame, radius: int) -> DataFrame:
    """For each fingerprint its rows (``__n``), its first row, the root of its links if it has any, and the component's first row.

    The first row is the one with the smallest id, rows without an id last, then the smallest row number.
    """
    place = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    nodes = stored.groupBy(F.col("simhash.bits").alias("__bits")).agg(F.min(place).alias("__first"), F.count(F.lit(1)).alias("__n"))
    roots = components(near_links(nodes, "__bits", radius)).select(F.col("node").alias("__bits"), F.col("root").alias("__linked"))
    placed, _ = written(nodes.join(roots, "__bits", "left").withColumn("__root", F.coalesce("__linked", "__bits")), "simhash-placed")
    smallest, _ = written(placed.groupBy("__root").agg(F.min("__first").alias("__least"), F.count(F.lit(1)).alias("__members")), "simhash-least")
    # One component may hold a large share of the fingerprints.
    return join_marks(placed, smallest, ["__root"], "__members", placed.count()).select("__bits", "__n", "__linked", "__least")


def near_duplicate_groups(df: DataFrame, id_col: str, text_col: str, words: int = 4, radius: int = 4, carry: list[str] | None = None) -> DataFrame:
    """Every row of ``df`` (or its ``carry`` columns) with a struct ``simhash``: ``bits``, ``component_id``, ``first``.

    ``component_id`` is the smallest id among the rows whose fingerprints are reachable over links; ``first``
    marks one row of each component, one with that id. A null or wordless text has fingerprint 0 and links
    like any other; a null id is never the smallest, so a group of null ids only has a null component; repeated
    rows and ids keep their rows; of equal ids the row read first counts. Texts of any length are taken whole. An empty
    table gives an empty result. A column called ``simhash`` gives way.

    Rows of a fingerprint that many share meet its component without a shuffle.
    """
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() != "simhash"]
    begun = mark()
    stored, path = _stored(df, kept, id_col, text_col, words)
    labels, labels_path = written(_labels(stored, radius).select("__bits", "__n", "__least"), "simhash-labels")
    release(df.sparkSession, begun, keep=[path, labels_path])
    marks = F.struct(F.col("__bits").alias("bits"), F.col("__least.id").alias("component_id"), (F.col("__row") == F.col("__least.row")).alias("first"))
    rows = stored.withColumn("__bits", F.col("simhash.bits"))
    return join_marks(rows, labels, ["__bits"], "__n", stored.count()).select(*[col(c) for c in kept], marks.alias("simhash"))


def keep_one(df: DataFrame, id_col: str, text_col: str, words: int = 4, radius: int = 4) -> DataFrame:
    """One row of each near-duplicate group, one with its smallest id; the columns are those of ``df``.

    Nulls, ties, repeated rows and empty texts count as in ``near_duplicate_groups``; an empty table gives an empty result, and
    columns of any name pass through. Only fingerprints and row numbers are joined and shuffled: the numbers of the rows that
    go come back to the tasks that read the rows, so no text is moved, whatever the size of a group.
    """
    renamed = {c: f"__column_{i}" for i, c in enumerate(df.columns)}
    begun = mark()
    stored, path = _stored(df.select(*[col(c).alias(n) for c, n in renamed.items()]), list(renamed.values()), renamed[id_col], renamed[text_col], words)
    shared = _labels(stored, radius).filter("__n > 1 OR __linked IS NOT NULL")
    shared, _ = written(shared.select("__bits", "__n", F.col("__least.row").alias("__keep")), "simhash-shared")
    rows = stored.select(F.col("simhash.bits").alias("__bits"), F.col("__row").alias("row"))
    gone, uri = write_marks(join_marks(rows, shared, ["__bits"], "__n", rows.count()).filter("row != __keep").select("row"), "simhash-gone")
    release(df.sparkSession, begun, keep=[path, gone])
    names = list(renamed.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(uri)
        for batch in batches:
            stay = ~marks.has(batch.column(len(names)).to_numpy())
            yield pa.RecordBatch.from_arrays(batch.columns[: len(names)], names=names).filter(pa.array(stay))
        pa.default_memory_pool().release_unused()

    kept = stored.select(*names, "__row").mapInArrow(run, stored.select(*names).schema)
    return kept.select(*[F.col(n).alias(c) for c, n in renamed.items()])


def hex_bits(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
