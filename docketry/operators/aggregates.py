"""Aggregations that combine map-side before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from docketry.operators import skew


def money(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def total(amount: Column | str, where: Column | None = None) -> Column:
    """The exact sum of amounts with two decimals, whatever the order of the rows.

    Amounts become decimals first, halves rounding away from zero. Whole pennies are summed then: a long fits the
    aggregation buffer, where a wide decimal would make an object per row.
    """
    pennies = (money(amount) * F.lit(100).cast("decimal(3,0)")).cast("long")
    summed = F.sum(pennies if where is None else F.when(where, pennies))
    return (summed.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


def balance(df: DataFrame, keys: Sequence[str], amount: Column, name: str, reversed_rows: DataFrame | None = None,
            on: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Sum per key over the rows that no reversal refers to."""
    rows = df if where is None else df.filter(where)
    if reversed_rows is not None:
        rows = rows.join(reversed_rows.select(*on).distinct(), list(on), "left_anti")
    return rows.groupBy(*keys).agg(total(amount).alias(name))


def conditional_sums(df: DataFrame, keys: Sequence[str], amount: Column, flags: Mapping[str, Column], absolute: Sequence[str] = ()) -> DataFrame:
    """One sum per flag from a single pass; no matching row gives 0.00."""
    zero = F.lit(0).cast("decimal(18,2)")

    def figure(name: str, flag: Column) -> Column:
        value = F.coalesce(total(amount, flag), zero)
        return (F.abs(value) if name in absolute else value).alias(name)

    return df.groupBy(*keys).agg(*[figure(n, f) for n, f in flags.items()])


def status_counts(df: DataFrame, keys: Sequence[str], success: Column) -> DataFrame:
    """Rows, successes and failures; a row whose outcome is unknown is a failure."""
    ok = F.coalesce(success, F.lit(False))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
    )


def rate(part: Column, whole: Column) -> Column:
    """Percent with two decimals; NULL when nothing was expected."""
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 2)


def collected(df: DataFrame, keys: Sequence[str]) -> GroupedData:
    """Groups for a ``collect_list``, shuffled row by row first.

    Lists do not get smaller by collecting them in part before the shuffle; that would only sort and
    copy every row once more.
    """
    return df.repartition(*keys).groupBy(*keys)


# Rows in a part of a nested list, a joined text or a page.
PART = 1000


def nest(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str, order: Sequence[str], coarse: Column, size: int = PART
) -> DataFrame:
    """Child rows as one sorted array of structs per key and ``part``.

    The parts of a key together hold every child in order, ``size`` children each but the last, however many the key has.
    ``coarse`` is a column that follows the order, such as the day of a date (``skew.rank_within``).
    """
    whole_order = list(dict.fromkeys([*order, *fields]))
    child = F.struct(*whole_order)
    sorted_children = F.sort_array(F.collect_list(child))
    cut = skew.in_parts(df, keys, whole_order, coarse, size)
    return collected(cut, [*keys, "part"]).agg(
        F.transform(sorted_children, lambda c: F.struct(*[c[f].alias(f) for f in fields])).alias(name)
    )


def concat_agg(
    df: DataFrame, keys: Sequence[str], text: Column, sep: str, name: str, order: Sequence[str], coarse: Column, size: int = PART,
    light: int | None = None,
) -> DataFrame:
    """Texts of a key joined in order, in parts as for ``nest``; nothing to join gives NULL.

    ``df`` is read once to find hot keys and once for the texts (``skew.ranked_groups``); write it first if it is costly.
    """
    own = [F.col(c) for c in dict.fromkeys([*keys, *order])]
    texts = df.select(*own, text.alias("_text"), coarse.alias("_bucket"))
    rows = F.sort_array(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct(*order, "_text"))))

    def gather(ranked: DataFrame, apart: bool) -> DataFrame:
        cut = ranked.withColumn("part", F.floor((F.col("_rn") - 1) / size).cast("long"))
        groups = collected(cut, [*keys, "part"]) if apart else cut.groupBy(*keys, "part")
        return groups.agg(F.nullif(F.array_join(F.transform(rows, lambda r: r["_text"]), sep), F.lit("")).alias(name))

    return skew.ranked_groups(texts, keys, [*order, "_text"], F.col("_bucket"), gather, light=light)


def distinct_lines(df: DataFrame, keys: Sequence[str], line: Column, sep: str, name: str) -> DataFrame:
    """Distinct lines per key joined in sorted order; use on keys bounded by construction (a batch)."""
    return df.select(*keys, line.alias("_line")).distinct().groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list("_line")), sep).alias(name)
    )


def group_flag(df: DataFrame, keys: Sequence[str], condition: Column, name: str) -> DataFrame:
    """Whether any row of the group meets the condition."""
    return df.groupBy(*keys).agg(F.coalesce(F.bool_or(condition), F.lit(False)).alias(name))


def pivot_values(df: DataFrame, keys: Sequence[str], column: str, values: Mapping[str, object], value: Column) -> DataFrame:
    """A fixed-value pivot that keeps the smallest value per cell, in one aggregate."""
    return df.groupBy(*keys).agg(
        *[F.min(F.when(F.col(column) == v, value)).alias(name) for name, v in values.items()]
    )


def audit_counts(df: DataFrame, id_columns: Sequence[str], table: str, stage: str, run_id: str, as_of: str) -> DataFrame:
    """Audit rows: how many records each identifier has in a table at a stage."""
    return df.groupBy(*id_columns).count().select(
        F.lit(run_id).alias("run_id"),
        F.lit(",".join(id_columns)).alias("identifier_desc"),
        F.concat_ws(",", *[F.col(c).cast("string") for c in id_columns]).alias("identifier"),
        F.lit(table).alias("table_name"),
        F.lit(stage).alias("stage_name"),
        F.col("count").alias("record_count"),
        F.lit(as_of).alias("run_at"),
    )


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


# Size of the quantile sketches of rates: the rank of an answer is off by half a per cent at most, in 99 of 100 cases.
SKETCH, RANK_ERROR = 800, 0.005


def rate_sketches(df: DataFrame, ts: str, width: str, keys: Sequence[str] = ()) -> DataFrame:
    """A quantile sketch of the number of rows per time window, for each day and key, with the number of windows.

    A day's sketch is a few kilobytes whatever the traffic, and can be kept: ``merged_rates`` adds up the sketches of any days
    without their rows. Rows without a time are in no window.
    """
    counts = df.filter(F.col(ts).isNotNull()).groupBy(F.window(ts, width).alias("_window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(F.to_date("_window.start").alias("day"), *keys).agg(
        F.count(F.lit(1)).alias("windows"), F.sum("n").alias("rows"), F.max("n").alias("peak_rate"), F.kll_sketch_agg_bigint("n", SKETCH).alias("sketch")
    )


def merged_rates(sketches: DataFrame, keys: Sequence[str] = (), ranks: Mapping[str, float] | None = None) -> DataFrame:
    """Windows, mean, peak and quantiles (``ranks`` by name) over the days of ``sketches``; ranks hold within ``RANK_ERROR``."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("windows").alias("windows"),
        F.round(F.sum("rows") / F.sum("windows"), 4).alias("mean_rate"),
        F.max("peak_rate").alias("peak_rate"),
        F.kll_merge_agg_bigint("sketch").alias("_sketch"),
    )
    wanted = {"median_rate": 0.5} if ranks is None else ranks
    return merged.select(*keys, "windows", "mean_rate", "peak_rate", *[F.kll_sketch_get_quantile_bigint("_sketch", F.lit(r)).alias(n) for n, r in wanted.items()])


def rate_per_window(df: DataFrame, ts: str, width: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and exact median of the number of rows per time window."""
    counts = df.groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("windows"),
        F.round(F.avg("n"), 4).alias("mean_rate"),
        F.percentile("n", 0.5).alias("median_rate"),
        F.max("n").alias("peak_rate"),
    )
