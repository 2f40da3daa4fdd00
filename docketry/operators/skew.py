"""Ranks and sizes that hold when one key owns a large share of the rows.

A plain window puts a whole key into one task. These helpers cut the rows of a key into buckets by ``coarse``, a
column that never falls along the order (the year of a date, a prefix of a name, the high bits of a number). Rows
are ranked inside their bucket, buckets are counted, and the counts before a bucket are added. A task holds one
bucket of one key, and only bucket counts meet per key. ``ranked_groups`` takes that way
only for keys that may be hot, in the same plan, so nothing runs while a query is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column | str]


def _columns(order: Order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` joined to the rows before their bucket (``_before``) and in their key (``_all``)."""
    buckets = df.groupBy(*keys, "_coarse").agg(F.count(F.lit(1)).alias("_n"))
    key = Window.partitionBy(*keys)
    before = key.orderBy(F.col("_coarse").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = buckets.select(
        *keys, "_coarse", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(key).alias("_all")
    )
    same = F.lit(True)
    for k in [*keys, "_coarse"]:
        same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}"))
    return df.alias("p").join(counts.alias("s"), same).select("p.*", "s._before", "s._all")


def rank_within(df: DataFrame, keys: Sequence[str], order: Order, coarse: Column | str, name: str = "rn", size: str | None = None) -> DataFrame:
    """1-based place of each row in its key; ``order`` must be total inside a key and ``coarse`` follow it.

    With ``size`` the number of rows of the key comes along. No keys rank the whole table.
    """
    marked = df.withColumn("_coarse", F.expr(coarse) if isinstance(coarse, str) else coarse)
    window = Window.partitionBy(*keys, "_coarse").orderBy(*_columns(order))
    placed = _counted(marked.withColumn("_place", F.row_number().over(window).cast("long")), keys)
    kept = [F.col(c) for c in df.columns if c not in (name, size)]
    sizes = [F.col("_all").alias(size)] if size else []
    return placed.select(*kept, (F.col("_before") + F.col("_place")).alias(name), *sizes)


def global_rank(df: DataFrame, order: Order, coarse: Column | str, name: str = "rn") -> DataFrame:
    """1-based place of each row in the total order; only one count per bucket meets in a single task."""
    return rank_within(df, [], order, coarse, name)


def in_parts(df: DataFrame, keys: Sequence[str], order: Order, coarse: Column | str, size: int, name: str = "part") -> DataFrame:
    """Rows with their part of the key, from 0: ``size`` rows that follow each other in ``order``, so no part holds more.

    The buckets need not fit ``size``: their counts say where each begins, and the place inside gives the part. A key ten times
    as large has ten times as many parts of the same size. ``order`` and ``coarse`` as for ``rank_within``.
    """
    ranked = rank_within(df, keys, order, coarse, "_rn")
    return ranked.select(*[F.col(c) for c in df.columns if c != name], F.floor((F.col("_rn") - 1) / size).cast("long").alias(name))


# Keys are hashed to so many cells; a cell with more rows than ``LIGHT`` may hold a hot key.
CELLS, LIGHT = 65_536, 1_000_000


# Bytes of given tables, as the planner estimates them, whose rows one task can sort in memory: rows grow some ten times when read.
TASK_BYTES, MOST_TASKS, UNKNOWN = 4_000_000, 4096, 1 << 60


def width(*frames: DataFrame) -> int | None:
    """How many tasks a shuffle of ``frames`` needs for each to sort its rows in memory; None where the session's own number will do.

    It follows the sizes of the tables they read, as the planner knows them, so no job runs; tables of unknown size do not count. A
    task with more rows than it can hold writes them to disk once for each sort.
    """
    size = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        size += sum(n for n in (int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())) if n < UNKNOWN)
    wanted = min(-(-size // TASK_BYTES), MOST_TASKS)
    return wanted if wanted > int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, keys: Sequence[str], tasks: int | None) -> DataFrame:
    """Rows shuffled by ``keys`` to so many tasks (``width``)."""
    return df.repartition(tasks, *keys) if tasks else df.repartition(*keys)


def _cell(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(CELLS).cast("long"))


def full_cells(frames: Sequence[DataFrame], keys: Sequence[str], light: int | None = None) -> DataFrame | None:
    """The cells of keys with over ``light`` rows in one of ``frames``, as a small table of fixed rows, or None. Runs a job for each frame."""
    found: set[int] = set()
    for df in frames:
        counts = df.groupBy(_cell(keys).alias("_full")).agg(F.count(F.lit(1)).alias("_n"))
        found |= {r["_full"] for r in counts.filter(F.col("_n") > (LIGHT if light is None else light)).collect()}
    return F.broadcast(frames[0].sparkSession.createDataFrame([(c,) for c in sorted(found)], "_full bigint")) if found else None


def in_cells(df: DataFrame, keys: Sequence[str], full: DataFrame | None, inside: bool) -> DataFrame:
    """Rows whose key is in one of the cells, or those whose key is in none."""
    if full is None:
        return df.limit(0) if inside else df
    return df.join(full, _cell(keys) == F.col("_full"), "left_semi" if inside else "left_anti")


def by_weight(df: DataFrame, keys: Sequence[str], light: int, weighed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose key has at most ``light`` rows for sure, and the others. ``weighed`` is counted for them if given.

    Rows are counted by a hash of the key, so there are at most ``CELLS`` counts whatever the input. A cell with many rows goes
    to the others as a whole; a row is in exactly one of the two.
    """
    marked = df.withColumn("_cell", _cell(keys))
    counts = (marked if weighed is None else weighed.withColumn("_cell", _cell(keys))).groupBy(F.col("_cell").alias("_full")).agg(F.count(F.lit(1)).alias("_n"))
    full = F.broadcast(counts.filter(F.col("_n") > light).select("_full"))
    in_full = F.col("_cell") == F.col("_full")
    # Plain joins, as semi and anti joins would be pushed into each branch of a union, with counts of their own.
    near = marked.join(full, in_full, "left").filter(F.col("_full").isNull())
    return near.drop("_cell", "_full"), marked.join(full, in_full).drop("_cell", "_full")


def ranked_groups(
    df: DataFrame, keys: Sequence[str], order: Order, coarse: Column | str, gather: Callable[[DataFrame, bool], DataFrame],
    name: str = "_rn", size: str | None = None, home: Sequence[str] | None = None, light: int | None = None, weighed: DataFrame | None = None,
    expand: Callable[[DataFrame], DataFrame] = lambda df: df, distinct: Column | None = None, tasks: int | None = None,
) -> DataFrame:
    """``gather`` of the rows with their place in their key, which groups them by ``home`` (``keys`` if not given) and a part.

    Rows of keys that are not hot are shuffled once, by ``home``: they are ranked and gathered where they arrive. Those that may be
    hot are ranked by buckets (``rank_within``) and shuffled again by part; the flag tells ``gather`` so. Both are one plan.

    ``expand`` makes of the rows of a key those that are ranked, after they have been shuffled to so many ``tasks`` (``width``). Where
    ``distinct`` holds, rows of a key with the same order are one. ``weighed`` is that of ``by_weight``.
    """
    home = list(home or keys)
    near, far = by_weight(df, home, LIGHT if light is None else light, weighed)
    window = Window.partitionBy(*keys)
    along = window.orderBy(*_columns(order))
    placed, far = expand(dealt(near, home, tasks)), expand(far)
    if distinct is None:
        placed = placed.withColumn(name, F.row_number().over(along).cast("long"))
    else:
        ranks = placed.withColumns({name: F.row_number().over(along).cast("long"), "_peer": F.rank().over(along), "_dense": F.dense_rank().over(along)})
        first = ranks.filter(~F.coalesce(distinct, F.lit(False)) | (F.col(name) == F.col("_peer")))
        placed = first.withColumn(name, F.when(distinct, F.col("_dense").cast("long")).otherwise(F.col(name))).drop("_peer", "_dense")
        far = far.filter(~F.coalesce(distinct, F.lit(False))).unionAll(far.filter(distinct).dropDuplicates([*keys, *order]))
    if size:
        placed = placed.withColumn(size, F.count(F.lit(1)).over(window))
    return gather(placed, False).unionByName(gather(rank_within(far, keys, order, coarse, name, size), True))


# A value with over one in so many of the rows is joined without a shuffle; there are at most so many of those.
HEAVY = 1000


def join_unique(rows: DataFrame, on: str, keyed: DataFrame, key: str, total: int) -> DataFrame:
    """Left join of ``rows`` (``total`` of them) with ``keyed``, which has one row per ``key``, by ``on`` = ``key``.

    The partners of the at most ``HEAVY`` values with over one in ``HEAVY`` of the rows go to every task, so rows of a hot value
    stay where they are; all others are joined by shuffle, where no value has more than that share.
    """
    common = rows.groupBy(F.col(on).alias("_value")).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") * HEAVY > total) & F.col("_value").isNotNull()).select("_value")
    hot = F.broadcast(keyed.join(F.broadcast(common), F.col(key) == F.col("_value"), "left_semi"))
    there = rows.join(hot, F.col(on) == F.col(key))
    # Rows without a value meet no partner and need no shuffle either.
    nowhere = rows.filter(F.col(on).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in keyed.schema.fields])
    rest = rows.filter(F.col(on).isNotNull()).join(hot.select(F.col(key).alias("_hot")), F.col(on) == F.col("_hot"), "left_anti")
    return there.unionByName(rest.join(keyed, F.col(on) == F.col(key), "left")).unionByName(nowhere)


def carry_forward(df: DataFrame, keys: Sequence[str], order: Order, coarse: Column | str, columns: Sequence[str]) -> DataFrame:
    """NULLs of ``columns`` filled with the last value before them in their key, without a key in one task.

    Rows are filled inside their bucket first. The last values of a bucket seed the ones after it: they are known from one
    aggregate, and only a row per bucket is carried along a key. ``order`` and ``coarse`` as for ``rank_within``.
    """
    marked = df.withColumn("_coarse", F.expr(coarse) if isinstance(coarse, str) else coarse)
    place = F.struct(*_columns(order))
    ends = marked.groupBy(*keys, "_coarse").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_end_{c}") for c in columns])
    along = Window.partitionBy(*keys).orderBy(F.col("_coarse").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    seeds = ends.select(*keys, "_coarse", *[F.last(f"_end_{c}", ignorenulls=True).over(along).alias(f"_seed_{c}") for c in columns])
    inside = Window.partitionBy(*keys, "_coarse").orderBy(*_columns(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = marked.withColumns({f"_own_{c}": F.last(c, ignorenulls=True).over(inside) for c in columns})
    same = F.lit(True)
    for k in [*keys, "_coarse"]:
        same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}"))
    joined = filled.alias("p").join(seeds.alias("s"), same, "left")
    return joined.select(*[F.coalesce(F.col(f"p._own_{c}"), F.col(f"s._seed_{c}")).alias(c) if c in columns else F.col(f"p.{c}") for c in df.columns])


def group_size(df: DataFrame, keys: Sequence[str], coarse: Column | str, name: str = "n") -> DataFrame:
    """Rows per key attached to each row, joined by key and bucket, so that a hot key stays spread.

    ``coarse`` may be any column here; it need not follow an order.
    """
    counted = _counted(df.withColumn("_coarse", F.expr(coarse) if isinstance(coarse, str) else coarse), keys)
    return counted.select(*[F.col(c) for c in df.columns if c != name], F.col("_all").alias(name))
