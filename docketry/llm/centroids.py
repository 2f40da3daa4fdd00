"""Centroid clustering with bounds that loosen by geometry instead of by full drift.

Vectors and centroids are whole numbers, so distances, sums and ties are exact. Each vector keeps an upper bound on
the distance to its centroid and a lower bound on that to all others. When centroids move, the upper bound grows by its
own centroid's drift. The lower bound need not fall by the largest drift: the members of a cluster lie in a sphere
around its old centroid, and how much nearer another centroid can come to a point of that sphere is a problem in the
plane through the sphere's centre and the two places of that centroid (``loosening``). A vector whose upper bound
stays below the lower one, or below half the way to the nearest other centroid, keeps its cluster unseen; the others
are measured exactly, first against their own centroid, then against all.

A round is one pass over the vectors, written to the shared folder, and one aggregate of sums per cluster; tables of
earlier rounds are deleted. Only centroids and figures per cluster go through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import col, small_batches, written
from docketry.llm.vectors import largest, matrix, number_type, usable, whole
from docketry.sources.scratch import mark, release

# Room for rounding in comparisons of bounds, as a share and absolutely.
SHARE, ROOM = 1e-12, 1e-9
ANGLES = 2048


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray, angles: int = ANGLES) -> np.ndarray:
    """For each cluster how much the distance from any of its members to another centroid can have shrunk at most.

    A member lies within ``radius`` of its old centroid. Let another centroid move from A to B. The distance to A less that
    to B depends only on the place along AB and the distance from that line, so a point of the sphere has an equal in the
    disk that the plane through its centre and AB cuts out. The difference has no inner maximum but where it equals
    the drift, on the line beyond B, which leaves the disk through its edge. So the edge is walked in ``angles`` steps; as
    the difference changes by at most twice the way walked, a half step on either side is covered by ``step * radius``.
    Negative values mean that all other centroids have moved away.
    """
    k = len(old)
    out = np.zeros(k)
    if k < 2:
        return out
    way = new - old
    drift = np.sqrt((way**2).sum(axis=1))
    turn = 2 * np.pi * np.arange(angles) / angles
    step = 2 * np.pi / angles
    for i in range(k):
        to = old[i] - old
        along = np.divide((to * way).sum(axis=1), drift, out=np.zeros(k), where=drift > 0)
        off = np.sqrt(np.maximum((to**2).sum(axis=1) - along**2, 0))
        x = along[:, None] + radius[i] * np.cos(turn)
        y = off[:, None] + radius[i] * np.sin(turn)
        shrunk = (np.hypot(x, y) - np.hypot(x - drift[:, None], y)).max(axis=1) + step * radius[i]
        shrunk = np.where(drift > 0, np.minimum(shrunk, drift), 0.0)
        shrunk[i] = -np.inf
        out[i] = shrunk.max()
    return out


@dataclass
class Round:
    """What every task of a pass gets: at most k rows of numbers each."""

    centroids: np.ndarray
    drift: np.ndarray
    loosened: np.ndarray
    half: np.ndarray
    kind: type


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``x`` to each centroid; whole numbers in either type."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(axis=1)[None, :]


def half_ways(centroids: np.ndarray) -> np.ndarray:
    """Half the distance from each centroid to the nearest other one."""
    if len(centroids) < 2:
        return np.full(len(centroids), np.inf)
    apart = squared(centroids, centroids).astype(float)
    np.fill_diagonal(apart, np.inf)
    return np.sqrt(apart.min(axis=1)) / 2


def assign(x: np.ndarray, now: Round, cluster: np.ndarray | None, upper: np.ndarray | None, lower: np.ndarray | None):
    """Cluster, upper and lower bound of each row after a round; without earlier bounds all rows are measured."""
    n, centroids = len(x), now.centroids
    if cluster is None:
        cluster, upper, lower = np.zeros(n, np.int32), np.full(n, np.inf), np.full(n, -np.inf)
    else:
        cluster = cluster.copy()
        upper = (upper + now.drift[cluster]) * (1 + SHARE)
        lower = lower - now.loosened[cluster] - SHARE * np.abs(lower)
    clear = lambda: upper * (1 + SHARE) + ROOM < np.maximum(lower, now.half[cluster])
    unsure = np.flatnonzero(~clear())
    if len(unsure):
        own = x[unsure] - centroids[cluster[unsure]]
        upper[unsure] = np.sqrt((own * own).sum(axis=1).astype(float))
        unsure = unsure[~clear()[unsure]]
    if len(unsure):
        every = squared(x[unsure], centroids)
        # The first of equal distances is the smaller number.
        cluster[unsure] = every.argmin(axis=1)
        ranked = np.sqrt(np.partition(every, min(1, len(centroids) - 1), axis=1)[:, :2].astype(float))
        upper[unsure] = ranked[:, 0]
        lower[unsure] = ranked[:, 1] if len(centroids) > 1 else np.inf
    return cluster, upper, lower


def _pass(state: DataFrame, carried: list[str], now: Round, first: bool, last: bool, dims: int) -> DataFrame:
    """One assignment of all vectors; the last one also measures each vector against its own centroid."""
    sent = state.sparkSession.sparkContext.broadcast(now)
    n = len(carried)
    kept = [*[f"`{c}`" for c in carried], "__v"]
    bounds = [] if first else ["__c", "__u", "__l"]
    fields = [*state.select(*kept).schema.fields, T.StructField("__c", T.IntegerType()), T.StructField("__u", T.DoubleType()), T.StructField("__l", T.DoubleType()), T.StructField("__d", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = sent.value
        for batch in batches:
            x = matrix(batch.column(n), dims, now.kind)
            had = [batch.column(n + 1 + i).to_numpy(zero_copy_only=False) for i in range(len(bounds))] or [None] * 3
            cluster, upper, lower = assign(x, now, *had)
            own = x - now.centroids[cluster] if last else None
            distance = pa.array((own * own).sum(axis=1).astype(np.int64)) if last else pa.nulls(len(x), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n + 1)], pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower), distance], names=[f.name for f in fields])

    return state.select(*kept, *bounds).mapInArrow(run, T.StructType(fields))


def _figures(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, list[list[int]], np.ndarray]:
    """Per cluster the number of vectors, their sums and the radius of the sphere that holds them; added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, radius = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), np.zeros(k)
        for batch in batches:
            cluster = batch.column(1).to_numpy()
            sizes = np.bincount(cluster, minlength=k)
            there = np.flatnonzero(sizes)
            if not len(there):
                continue
            # Rows of one cluster stand together, then each run is added up.
            ordered = matrix(batch.column(0), dims)[np.argsort(cluster, kind="stable")]
            sums[there] += np.add.reduceat(ordered, (np.cumsum(sizes) - sizes)[there], axis=0)
            counts += sizes
            np.maximum.at(radius, cluster, batch.column(2).to_numpy())
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held]), pa.array(sums[held].tolist(), pa.list_(pa.int64())), pa.array(radius[held])], names=["c", "n", "sums", "r"])

    parts = state.select("__v", "__c", "__u").mapInArrow(run, "c int, n long, sums array<long>, r double")
    # Component -1 carries the count and the radius.
    flat = parts.select("c", "r", F.posexplode(F.concat(F.array("n"), "sums")).alias("at", "x"))
    counts, sums, radius = np.zeros(k, np.int64), [[0] * dims for _ in range(k)], np.zeros(k)
    for row in flat.groupBy("c", "at").agg(F.sum("x").alias("x"), F.max("r").alias("r")).collect():
        if row["at"] == 0:
            counts[row["c"]], radius[row["c"]] = row["x"], row["r"]
        else:
            sums[row["c"]][row["at"] - 1] = row["x"]
    return counts, sums, radius


def cluster(
    df: DataFrame,
    vector_col: str,
    order: Column,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    name: str = "centroid",
    carry: list[str] | None = None,
) -> DataFrame:
    """The rows of ``df`` (or its ``carry`` columns) with a usable vector and a struct ``name``.

    Usable vectors have ``dims`` components, none null or non-finite; each becomes ``floor(scale * x)``. The first ``k``
    of them by ``order`` (rows where it is null are never chosen; ties by the vector itself) are the first centroids, in that
    order. ``rounds`` times every vector goes to its nearest centroid, the smaller number on ties, and every centroid
    with vectors becomes the floor of their mean; then vectors are assigned once more. Fields of the struct:
    ``cluster``, ``distance`` (squared), ``cluster_inertia`` and ``inertia`` (distances summed over the cluster and
    over all) and ``components`` of the final centroid.

    Fewer than ``k`` vectors make fewer centroids; centroids without vectors stay where they are; repeated rows count each;
    without a usable vector the result is empty. A column called ``name`` gives way, others pass through whatever
    their names. Scaled components must lie within 2^27. A task holds one batch; the driver ``k`` centroids.
    """
    small_batches(df)
    spark, begun = df.sparkSession, mark()
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() != name.lower()]
    inside = {c: f"__column_{i}" for i, c in enumerate(kept)}
    source = df.filter(usable(col(vector_col), dims)).select(*[col(c).alias(n) for c, n in inside.items()], whole(col(vector_col), scale).alias("__v"), order.alias("__o"))
    vectors, path = written(source, "centroid-vectors")
    chosen = vectors.filter("__o IS NOT NULL").orderBy("__o", "__v").limit(k).select("__v").collect()
    kind = number_type(largest(vectors, "__v"), dims)
    centroids = np.array([r["__v"] for r in chosen], kind).reshape(-1, dims)
    still = np.zeros(len(centroids))
    now, state, last = Round(centroids, still, still, half_ways(centroids), kind), vectors.drop("__o"), rounds == 0
    if not len(centroids):
        state = state.limit(0)
    made, path = written(_pass(state, list(inside.values()), now, True, last, dims), "centroid-round")
    for i in range(rounds if len(centroids) else 0):
        release(spark, begun, keep=[path])
        counts, sums, radius = _figures(made, len(centroids), dims)
        moved = np.array([[x // int(n) for x in s] if n else c.astype(np.int64).tolist() for c, s, n in zip(now.centroids, sums, counts)], kind).reshape(-1, dims)
        old = now.centroids.astype(float)
        drift = np.sqrt(((moved - old) ** 2).sum(axis=1))
        now = Round(moved, drift, loosening(old, moved.astype(float), radius * (1 + SHARE) + ROOM), half_ways(moved), kind)
        made, path = written(_pass(made, list(inside.values()), now, False, i == rounds - 1, dims), "centroid-round")
    release(spark, begun, keep=[path])
    totals = made.groupBy("__c").agg(F.sum("__d").alias("d")).collect()
    inertia = sum(r["d"] for r in totals)
    figures = spark.createDataFrame([(r["__c"], r["d"], inertia, [int(x) for x in now.centroids[r["__c"]]]) for r in totals], "__of int, cluster_inertia long, inertia long, components array<long>")
    result = F.struct(F.col("__c").alias("cluster"), F.col("__d").alias("distance"), "cluster_inertia", "inertia", "components")
    return made.join(F.broadcast(figures), F.col("__c") == F.col("__of")).select(*[col(n).alias(c) for c, n in inside.items()], result.alias(name))
