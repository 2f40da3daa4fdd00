"""Published against acknowledged: stage matrices, gaps, replay and traces."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators.projection import first_match


def reconcile(stages: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per key known to any stage, with a flag per stage and the first stage that lacks it.

    Equal to a chain of full outer joins on the key, but as one union and one aggregate: no key is
    lost when the first stage lacks it, and repeated keys do not multiply.
    """
    names = list(stages)
    seen = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(key, F.lit(name).alias("_stage")) for name, df in stages.items()],
    )
    return reconcile_long(seen, key, F.col("_stage"), names)


def reconcile_long(df: DataFrame, key: str, stage: Column, names: Sequence[str]) -> DataFrame:
    """``reconcile`` for stages that are already rows of one table."""
    wide = df.groupBy(key).agg(*[F.coalesce(F.bool_or(stage == n), F.lit(False)).alias(f"has_{n}") for n in names])
    missing = first_match([(n, ~F.col(f"has_{n}")) for n in names])
    return wide.withColumn("first_missing", missing)


def stage_matrix(df: DataFrame, stage: str, key: str, success: Column) -> DataFrame:
    """Per stage: rows, distinct keys, successes and others.

    Rows are first combined per (stage, key); a distinct count over a hot stage would otherwise send
    all its rows to one task.
    """
    ok = F.coalesce(success, F.lit(False))
    per_key = df.groupBy(stage, key).agg(F.count(F.lit(1)).alias("_rows"), F.count_if(ok).alias("_ok"))
    return per_key.groupBy(stage).agg(
        F.sum("_rows").alias("row_count"),
        F.count(key).alias("distinct_keys"),
        F.sum("_ok").alias("succeeded"),
        (F.sum("_rows") - F.sum("_ok")).alias("other"),
    )


def missing_events(published: DataFrame, acknowledged: DataFrame, key: str) -> DataFrame:
    """Keys published but never acknowledged."""
    return published.select(key).distinct().join(acknowledged.select(key).distinct(), key, "left_anti")


def replay_report(missing: DataFrame, log: DataFrame, key: str, payload: Sequence[str]) -> DataFrame:
    """The logged event to send again for each missing key; keys without one are failures.

    ``log`` holds one row per key (take the latest first).
    """
    side = log.select(key, *payload, F.lit(True).alias("_found"))
    return missing.join(side, key, "left").select(
        key, *payload,
        F.when(F.col("_found"), F.lit("resent")).otherwise(F.lit("failed")).alias("replay_status"),
    )


def trace(published: DataFrame, steps: Mapping[str, DataFrame], key: str, status: str = "status") -> DataFrame:
    """Each published key with the status of every later step (one row per key and step)."""
    df = published
    for name, step in steps.items():
        df = df.join(step.select(key, F.col(status).alias(f"{name}_status")), key, "left")
    return df


def audit_totals(stages: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Row and distinct-key totals per stage, long format."""
    rows = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(F.lit(name).alias("stage"), F.col(key).alias("_key")) for name, df in stages.items()],
    )
    return totals_long(rows, "stage", "_key")


def totals_long(df: DataFrame, stage: str, key: str) -> DataFrame:
    """``audit_totals`` for stages that are already rows of one table."""
    per_key = df.groupBy(F.col(stage).alias("stage"), F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy("stage").agg(F.sum("_n").alias("row_count"), F.count("_key").alias("key_count"))
