"""Hard negatives by an inverted multi-index with certified windows.

Vectors are cut into two halves. Each half has a codebook of ``k`` centroids, fitted on a bounded sample; the pair of the
nearest ones is a vector's cell, so there are ``k * k`` cells. Every row is in the index. For a query q the score of
any row of cell (i, j) lies within ``q1*c1[i] + q2*c2[j] +- (|q1|*r1[i] + |q2|*r2[j])``, where the radii are the largest
distances of rows to their half centroids. Half scores with radii are sorted per half, and a heap over the two
sorted lists (multi-sequence) yields the cells by falling upper bound, whatever their number.

A query has windows of scores and wants the best ``k`` rows in each. It visits its cells in rounds of growing length;
a window is certified when its k-th score is above the upper bound of the next cell, or that bound is below the window.
Cells that cannot hold a row of an open window are passed over. Queries whose windows are all certified are done; the
others go on until no cell is left, so the result is exact whatever the codebooks are worth.

Rows of a cell are packed in pieces of about ``PIECE`` rows by a hash, however many the cell has. A round brings the
visited pieces and the queries that visit them into the same partition, the piece first, and the queries stream past
it; of queries there are ``QUERIES`` at most per copy of a piece. What a task holds is one piece and one batch. Only the
sample, the codebooks and figures per cell go through the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import col, place, small_batches, written
from docketry.llm.vectors import largest, number_type, usable, whole
from docketry.sources.scratch import mark, release

# Rows that the codebooks are fitted on, about.
SAMPLE = 8192
PIECE = 4096
QUERIES = 1 << 16
# Queries scored against a piece at a time.
AT_ONCE = 256
# Cells visited by the end of the first round, and how the number grows.
FIRST, GROWTH = 4, 4
MOST_CODES = 256
LOWEST, HIGHEST = -(1 << 62), 1 << 62

FOUND = "array<struct<w: int, score: bigint, noid: boolean, id: bigint>>"
WINDOWS = "array<struct<w: int, lo: bigint, hi: bigint>>"


@dataclass
class Index:
    """The codebooks with their radii and the number of rows in each cell; at most ``MOST_CODES`` squared numbers."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    kind: type
    piece: int = PIECE

    def pieces(self, rows: int) -> int:
        """Pieces of a cell with so many rows."""
        return -(-rows // self.piece)

    def visits(self, q: np.ndarray) -> Iterator[tuple[int, float, float]]:
        """Cells with rows by falling upper bound, as (cell, lower bound, upper bound)."""
        half = q.shape[0] // 2
        k = len(self.books[0])
        middle, reach = [], []
        for part, book, radius in zip((q[:half], q[half:]), self.books, self.radii):
            part = part.astype(float)
            middle.append(book @ part)
            reach.append(np.sqrt(part @ part) * radius)
        upper = [m + r for m, r in zip(middle, reach)]
        order = [np.argsort(-u, kind="stable") for u in upper]
        # Room for rounding in the bounds.
        room = 1.0 + 1e-9 * sum(float(np.abs(m).max() + r.max()) for m, r in zip(middle, reach))
        heap, seen = [(-(upper[0][order[0][0]] + upper[1][order[1][0]]), 0, 0)], {(0, 0)}
        while heap:
            bound, a, b = heapq.heappop(heap)
            i, j = int(order[0][a]), int(order[1][b])
            if self.counts[i, j]:
                low = middle[0][i] - reach[0][i] + middle[1][j] - reach[1][j]
                yield i * k + j, low - room, room - bound
            for x, y in ((a + 1, b), (a, b + 1)):
                if x < k and y < k and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (-(upper[0][order[0][x]] + upper[1][order[1][y]]), x, y))


def codebook(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` centroids of half vectors; centroids that lose all rows stay. Any codebook gives right results."""
    book = sample[np.linspace(0, len(sample) - 1, k).astype(int)].astype(float)
    for _ in range(rounds):
        near = nearest(sample, book)
        for c in np.unique(near):
            book[c] = sample[near == c].mean(axis=0)
    return book


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(axis=1)[None, :] - 2 * (x @ book.T)).argmin(axis=1)


def _index(rows: DataFrame, n: int, dims: int, piece: int) -> tuple[Index, DataFrame, str]:
    """The index over ``rows`` and the table of packed pieces (with its path)."""
    spark, half = rows.sparkSession, dims // 2
    kind = number_type(largest(rows, "v"), dims)
    share = min(1.0, SAMPLE / n)
    sample = np.array([r["v"] for r in rows.filter(place(F.col("row")) < share).select("v").collect()] or [rows.first()["v"]], float)
    k = int(min(MOST_CODES, max(4, round((n / 1024) ** 0.5))))
    books = (codebook(sample[:, :half], k), codebook(sample[:, half:], k))
    sent = spark.sparkContext.broadcast(books)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in batches:
            x = batch.column(4).flatten().to_numpy().reshape(-1, dims)
            codes, gaps = [], []
            for part, book in zip((x[:, :half].astype(float), x[:, half:].astype(float)), books):
                codes.append(nearest(part, book))
                gaps.append(np.sqrt(((part - book[codes[-1]]) ** 2).sum(axis=1)))
            cells = (codes[0] * len(books[0]) + codes[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(5)], pa.array(cells), *[pa.array(g) for g in gaps]], names=["row", "id", "label", "anchor", "v", "cell", "r1", "r2"])

    cells, cells_path = written(rows.select("row", "id", "label", "anchor", "v").mapInArrow(celled, "row long, id long, label long, anchor boolean, v array<long>, cell int, r1 double, r2 double"), "negatives-cells")
    counts, radii = np.zeros((k, k), np.int64), (np.zeros(k), np.zeros(k))
    for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect():
        i, j = divmod(r["cell"], k)
        counts[i, j] = r["n"]
        radii[0][i], radii[1][j] = max(radii[0][i], r["r1"]), max(radii[1][j], r["r2"])
    index = Index(books, tuple(r * (1 + 1e-9) + 1e-6 for r in radii), counts, kind, piece)
    subs = spark.createDataFrame([(c, index.pieces(int(m))) for c, m in enumerate(counts.ravel()) if m], "cell int, subs int")
    dealt = cells.join(F.broadcast(subs), "cell").withColumn("sub", F.pmod(F.xxhash64("row"), F.col("subs")).cast("int"))
    # Rows of a piece stand by id, those without one last, so that the first of equal scores is the one wanted.
    ordered = dealt.select("cell", "sub", "row", "id", "label", "v").repartition(max(8, -(-n // (16 * piece))), "cell", "sub").sortWithinPartitions("cell", "sub", F.col("id").asc_nulls_last(), "row")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def closed() -> pa.RecordBatch:
            whole_piece = pa.Table.from_batches(parts).combine_chunks()
            ids = whole_piece.column("id")
            blobs = [
                whole_piece.column("row").to_numpy().tobytes(),
                ids.fill_null(0).to_numpy().tobytes(),
                ids.is_null().to_numpy().tobytes(),
                whole_piece.column("label").to_numpy().tobytes(),
                whole_piece.column("v").combine_chunks().flatten().to_numpy().astype(np.int32).tobytes(),
            ]
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), *[pa.array([b], pa.binary()) for b in blobs]], names=["cell", "sub", "rows", "ids", "noid", "labels", "vectors"])

        for batch in batches:
            cell, sub = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            change = np.flatnonzero((np.diff(cell) != 0) | (np.diff(sub) != 0)) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), len(cell)]):
                if a == b:
                    continue
                if (key := (int(cell[a]), int(sub[a]))) != now:
                    if parts:
                        yield closed()
                    now, parts = key, []
                parts.append(batch.slice(a, b - a))
        if parts:
            yield closed()

    pieces, path = written(ordered.mapInArrow(packed, "cell int, sub int, rows binary, ids binary, noid binary, labels binary, vectors binary"), "negatives-pieces")
    return index, pieces, path


def best_in_windows(scores: np.ndarray, fits: np.ndarray, windows: list[tuple[int, int, int]], k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each window the places of its best ``k`` fitting scores; of equal scores the earlier place comes first."""
    lowest, highest = min(w[1] for w in windows), max(w[2] for w in windows)
    there = np.flatnonzero(fits & (scores >= lowest) & (scores <= highest))
    if len(there):
        there = there[np.argsort(-scores[there], kind="stable")]
        ranked = -scores[there]
        for w, lo, hi in windows:
            a, b = np.searchsorted(ranked, -hi, "left"), np.searchsorted(ranked, -lo, "right")
            if a < b:
                yield w, there[a : min(b, a + k)]


def _visit(open_queries: DataFrame, sent, begin: int, end: int, k: int, blocks: int) -> DataFrame:
    """One row per query and piece for the cells in places ``[begin, end)`` that may hold something for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            cells, subs, queries, places = [], [], [], []
            for at, (v, windows, found) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                wanted = _wanted(windows, found, k)
                for number, (cell, low, high) in enumerate(index.visits(np.array(v, np.int64))):
                    if number >= end:
                        break
                    if number >= begin and any(high >= lo and low <= hi for _, lo, hi in wanted):
                        for sub in range(index.pieces(int(index.counts.flat[cell]))):
                            cells.append(cell)
                            subs.append(sub)
                            queries.append(at)
            taken = batch.take(pa.array(queries, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(subs, pa.int32()), *taken.columns], names=["cell", "sub", "row", "label", "v", "windows", "found"])

    made = open_queries.select("row", "label", "v", "windows", "found").mapInArrow(run, f"cell int, sub int, row long, label long, v array<long>, windows {WINDOWS}, found {FOUND}")
    return made.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))


def _wanted(windows: list[dict], found: list[dict], k: int) -> list[tuple[int, int, int]]:
    """Windows as (number, lowest, highest), cut off at the k-th score that is already there."""
    scores: dict[int, list[int]] = {}
    for f in found:
        scores.setdefault(f["w"], []).append(f["score"])
    return [(w["w"], max(w["lo"], min(scores[w["w"]])) if len(scores.get(w["w"], ())) >= k else w["lo"], w["hi"]) for w in windows]


def _candidates(pieces: DataFrame, visits: DataFrame, sent, dims: int, k: int, same: bool, blocks: int, tasks: int) -> DataFrame:
    """The best rows of each visited piece per query and window."""
    cells = F.broadcast(visits.select("cell").distinct())
    copies = pieces.join(cells, "cell", "left_semi").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    here = ["cell", "sub", "block"]
    blobs = ["rows", "ids", "noid", "labels", "vectors"]
    own = ["row", "label", "v", "windows", "found"]
    both = copies.select(*here, *blobs, *[F.lit(None).cast(visits.schema[c].dataType).alias(c) for c in own]).unionByName(
        visits.select(*here, *[F.lit(None).cast("binary").alias(c) for c in blobs], *own)
    )
    met = both.repartition(tasks, *here).sortWithinPartitions(*here, F.col("rows").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, piece, x = sent.value.kind, None, None
        for batch in batches:
            out = []
            columns = [batch.column(i) for i in range(len(here) + len(blobs) + len(own))]
            filled = columns[3].is_valid().to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(filled).tolist()
            for a, b in zip([0, *[h + 1 for h in heads]], [*heads, batch.num_rows]):
                for a, b in [(c, min(c + AT_ONCE, b)) for c in range(a, b, AT_ONCE)]:
                    queries = columns[10].slice(a, b - a).flatten().to_numpy().reshape(-1, dims).astype(kind)
                    scores = (queries @ x.T).astype(np.int64)
                    for n, (row, label, windows, found) in enumerate(zip(*(columns[c].slice(a, b - a).to_pylist() for c in (8, 9, 11, 12)))):
                        fits = (piece["labels"] == label) & (piece["rows"] != row) if same else piece["labels"] != label
                        for w, places in best_in_windows(scores[n], fits, _wanted(windows, found, k), k):
                            out += [(row, w, s, o, i) for s, o, i in zip(scores[n][places].tolist(), piece["noid"][places].tolist(), piece["ids"][places].tolist())]
                if b < batch.num_rows:
                    rows, ids, noid, labels, vectors = (columns[3 + i][b].as_py() for i in range(5))
                    piece = {"rows": np.frombuffer(rows, np.int64), "ids": np.frombuffer(ids, np.int64), "noid": np.frombuffer(noid, bool), "labels": np.frombuffer(labels, np.int64)}
                    x = np.frombuffer(vectors, np.int32).reshape(-1, dims).astype(kind)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64())
            made = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, kinds)], names=["row", "w", "score", "noid", "id"])

    return met.mapInArrow(run, "row long, w int, score long, noid boolean, id long")


def _certified(queries: DataFrame, sent, end: int, k: int) -> DataFrame:
    """``queries`` with ``open``: whether an unvisited cell may still hold something for one of the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            still = []
            for v, windows, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                rest = next((high for number, (_, _, high) in enumerate(index.visits(np.array(v, np.int64))) if number >= end), None)
                # A row with the k-th score and a smaller id may be in a cell whose bound is just that score.
                still.append(rest is not None and any(rest >= lo for _, lo, _ in _wanted(windows, found, k)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(still, pa.bool_())], names=[*batch.schema.names, "open"])

    return queries.mapInArrow(run, f"row long, label long, v array<long>, windows {WINDOWS}, found {FOUND}, open boolean")


def _search(queries: DataFrame, index: Index, pieces: DataFrame, n_queries: int, dims: int, k: int, same: bool, keep: list[str], begun: int) -> tuple[DataFrame, list[str]]:
    """``queries`` (row, label, v, windows) with ``found``: the best ``k`` rows of each window, of the same label or of others."""
    spark = queries.sparkSession
    sent = spark.sparkContext.broadcast(index)
    cells = int((index.counts > 0).sum())
    rows = int(index.counts.sum())
    blocks = -(-n_queries // QUERIES) or 1
    now = queries.withColumn("found", F.array().cast(FOUND)).withColumn("open", F.lit(True))
    done, done_paths, begin, end = [], [], 0, FIRST
    while True:
        open_queries = now.filter("open").drop("open")
        visits, visits_path = written(_visit(open_queries, sent, begin, end, k, blocks), "negatives-visits")
        tasks = max(8, -(-rows // (4 * index.piece)) * blocks)
        candidates = _candidates(pieces, visits, sent, dims, k, same, blocks, tasks)
        earlier = open_queries.select("row", F.explode("found").alias("f")).select("row", "f.w", "f.score", "f.noid", "f.id")
        place_in = Window.partitionBy("row", "w").orderBy(F.col("score").desc(), "noid", "id")
        best = candidates.unionByName(earlier).withColumn("rn", F.row_number().over(place_in)).filter(F.col("rn") <= k)
        # At most k rows for each of a query's few windows.
        lists = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("w", (-F.col("score")).alias("minus"), "noid", "id"))).alias("found"))
        lists = lists.select("row", F.transform("found", lambda f: F.struct(f["w"].alias("w"), (-f["minus"]).alias("score"), f["noid"].alias("noid"), f["id"].alias("id"))).alias("found"))
        merged = open_queries.drop("found").join(lists, "row", "left").withColumn("found", F.coalesce("found", F.array().cast(FOUND))).select("row", "label", "v", "windows", "found")
        made, path = written(_certified(merged, sent, end, k), "negatives-found")
        done.append(made.filter("NOT open").drop("open"))
        done_paths.append(path)
        release(spark, begun, keep=[*keep, *done_paths])
        if end >= cells or made.filter("open").isEmpty():
            out = done[0]
            for d in done[1:]:
                out = out.unionByName(d)
            return out, done_paths
        now, begin, end = made, end, min(end * GROWTH, cells)


def hard_negatives(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    label: Column,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    dims: int = 64,
    scale: int = 256,
    piece: int = PIECE,
) -> DataFrame:
    """Hard negatives of every anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, both scores.

    Rows take part when their ``label`` (a whole number) is not null and their vector has ``dims`` components, an even
    number, none null or non-finite; each becomes ``floor(scale * x)`` and must lie within 2^27. Scores are inner products,
    higher first, ties by smaller id, rows without an id last. Rows where ``anchors`` holds are anchors; a row's positives are
    its first ``positives`` other rows of its label, and for each of them its first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score`` are returned, or as many as there are.

    Repeated rows count each, also as anchors; a copy of an anchor is one of its other rows. Anchors without positives,
    windows without rows, empty tables and columns of any other name add nothing. All rows are searched, exactly.
    """
    small_batches(df)
    spark, begun = df.sparkSession, mark()
    source = df.select(
        F.monotonically_increasing_id().alias("row"),
        col(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.when(usable(col(vector_col), dims), whole(col(vector_col), scale)).alias("v"),
    ).filter("label IS NOT NULL AND v IS NOT NULL")
    rows, rows_path = written(source, "negatives-rows")
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("anchor"), 1))).first()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    index, pieces, path = _index(rows, n, dims, piece)
    every = F.array(F.struct(F.lit(0).alias("w"), F.lit(LOWEST).cast("long").alias("lo"), F.lit(HIGHEST).cast("long").alias("hi")))
    queries = rows.filter("anchor").select("row", "label", "v", every.cast(WINDOWS).alias("windows"))
    keep = [rows_path, path]
    near, near_paths = _search(queries, index, pieces, n_anchors, dims, positives, True, keep, begun)
    # Shares of a score as the smallest and largest whole score that satisfy them.
    up = lambda s, p: F.ceil((s * p) / F.lit(100).cast("decimal(20,0)")).cast("long")
    down = lambda s, p: F.floor((s * p) / F.lit(100).cast("decimal(20,0)")).cast("long")
    windows = F.transform("found", lambda f, i: F.struct(i.alias("w"), up(f["score"], low).alias("lo"), down(f["score"], high).alias("hi")))
    asked = near.select("row", "label", "v", F.filter(windows, lambda w: w["lo"] <= w["hi"]).cast(WINDOWS).alias("windows"), F.col("found").alias("positives"))
    asked, asked_path = written(asked, "negatives-asked")
    keep = [*keep, asked_path]
    hard, hard_paths = _search(asked.filter(F.size("windows") > 0).drop("positives"), index, pieces, n_anchors, dims, negatives, False, keep, begun)
    release(spark, begun, keep=[rows_path, asked_path, *hard_paths])
    own = rows.filter("anchor").select("row", F.col("id").alias("anchor_id"))
    flat = hard.select("row", F.col("found").alias("hard")).join(asked.select("row", "positives"), "row").join(own, "row")
    each = flat.select("anchor_id", "positives", "hard", F.explode(F.sequence(F.lit(0), F.size("positives") - 1)).alias("w"))
    # Found rows stand by window, best first.
    mine = each.select("anchor_id", F.element_at("positives", F.col("w") + 1).alias("p"), F.posexplode(F.filter("hard", lambda h: h["w"] == F.col("w"))).alias("at", "h"))
    return mine.select(
        "anchor_id", F.expr("CASE WHEN NOT p.noid THEN p.id END").alias("positive_id"), (F.col("at") + 1).alias("rank"), F.expr("CASE WHEN NOT h.noid THEN h.id END").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("h.score").alias("negative_score")
    )
