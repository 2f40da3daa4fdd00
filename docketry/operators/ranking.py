"""Latest, earliest and n-th rows per key, and fixed-size batches.

``row_number() <= k`` is cut down to k rows per key in every task before the shuffle
(``WindowGroupLimit``), so a hot key does not reach one task whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.operators import skew


def _desc(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def _asc(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rn") -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], where: Column | None = None) -> DataFrame:
    """The greatest row per key; ``order`` must name enough columns to break every tie."""
    rows = df if where is None else df.filter(where)
    return top_n(rows, keys, _desc(order), 1, "_rn").drop("_rn")


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str], where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return top_n(rows, keys, _asc(order), 1, "_rn").drop("_rn")


def latest_multi(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], variants: Mapping[str, Column], take: Sequence[str]
) -> DataFrame:
    """Several differently filtered "latest" rows per key from one pass over the history.

    Column ``<variant>_<field>`` holds the field of the greatest row for which the condition holds.
    """
    fields = list(dict.fromkeys([*order, *take]))
    row = F.struct(*fields)
    best = df.groupBy(*keys).agg(*[F.max(F.when(cond, row)).alias(name) for name, cond in variants.items()])
    return best.select(
        *keys, *[F.col(name)[f].alias(f"{name}_{f}") for name in variants for f in take]
    )


def latest_before(df: DataFrame, keys: Sequence[str], order: str, marker: Column) -> DataFrame:
    """Per key the last marker and the greatest unmarked ``order`` below it.

    Only combined (key, marker) maxima and the unmarked rows below them are shuffled; a window over
    the whole history would hold a hot key in one task.
    """
    marks = df.groupBy(*keys).agg(F.max(F.when(marker, F.col(order))).alias("marker"))
    unmarked = df.filter(~F.coalesce(marker, F.lit(False))).select(*keys, F.col(order).alias("_id")).distinct()
    below = (
        unmarked.join(marks, list(keys))
        .filter(F.col("_id") < F.col("marker"))
        .groupBy(*keys)
        .agg(F.max("_id").alias("before"))
    )
    return marks.join(below, list(keys), "left")


def current_or_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], skip: Column) -> DataFrame:
    """The latest row, or the one before it when ``skip`` holds for the latest and there is one."""
    two = top_n(df.withColumn("_skip", F.coalesce(skip, F.lit(False))), keys, _desc(order), 2, "_rn")
    window = Window.partitionBy(*keys).orderBy(*_desc(order))
    marked = two.withColumn("_more", F.lead("_rn").over(window)).withColumn("_prev_skip", F.lag("_skip").over(window))
    use_first = (F.col("_rn") == 1) & (~F.col("_skip") | F.col("_more").isNull())
    use_second = (F.col("_rn") == 2) & F.col("_prev_skip")
    return marked.filter(use_first | use_second).drop("_rn", "_skip", "_more", "_prev_skip")


def top_n_pivot(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Mapping[str, tuple[str, int]], n: int = 2) -> DataFrame:
    """Named columns from the first ``n`` rows per key: name -> (field, place)."""
    ranked = top_n(df, keys, _desc(order), n, "_rn")
    return ranked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_rn") == place, F.col(field))).alias(name) for name, (field, place) in fields.items()]
    )


def pick_priority(df: DataFrame, keys: Sequence[str], label: Column, ranks: Sequence[str], name: str) -> DataFrame:
    """The best-ranked label per key; labels outside ``ranks`` do not count.

    The rank is an integer, so the aggregate stays a hash aggregate with one buffer slot.
    """
    rank = F.lit(None).cast("int")
    for i, value in reversed(list(enumerate(ranks))):
        rank = F.when(label == value, F.lit(i)).otherwise(rank)
    best = df.groupBy(*keys).agg(F.min(rank).alias("_rank")).filter(F.col("_rank").isNotNull())
    names = F.array(*[F.lit(r) for r in ranks])
    return best.select(*keys, names[F.col("_rank")].alias(name))


def drop_in_group(df: DataFrame, keys: Sequence[str], where: Column, coarse: Column | str) -> DataFrame:
    """Remove the rows matching ``where`` from groups of more than one row; ``coarse`` spreads a hot group."""
    sized = skew.group_size(df, list(keys), coarse, "_n")
    return sized.filter(~((F.col("_n") > 1) & F.coalesce(where, F.lit(False)))).drop("_n")


def batch(df: DataFrame, order: Sequence[Column | str], coarse: Column | str, size: int = 250, name: str = "batch_id") -> DataFrame:
    """Number rows in a total order and cut them into batches of ``size``; ``coarse`` as for ``global_rank``."""
    ranked = skew.global_rank(df, list(order), coarse, "_rn")
    return ranked.withColumn(name, (F.floor((F.col("_rn") - 1) / size) + 1).cast("long")).drop("_rn")
