"""Chains of parents: the root and the depth of every row, however long its chain.

A row may refer to a parent row, that one to another, and so on: an adjournment that was itself adjourned. Following one
parent at a time takes as many joins as the longest chain. Pointers are doubled instead: each row knows an ancestor and
how far it is, and takes over that ancestor's ancestor in every round, so the rounds are the logarithm of the longest
chain. A round that finishes no row has only loops left, and those are reported.

Rounds are written to the shared folder, and only the last one is kept. Rows that share an ancestor, of which one may have
a large share of them, meet it without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.operators import skew
from docketry.sources.scratch import mark, release, scratch_path


def _written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def ancestry(df: DataFrame, key: str, parent: str) -> DataFrame:
    """``key``, ``root``, ``depth`` and ``in_loop`` of every row with a key; keys are unique.

    A row without a parent, or whose parent is not there, is its own root at depth 0. Rows of a loop, and those whose chain
    ends in one, have neither root nor depth.
    """
    spark, begun = df.sparkSession, mark()
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(parent).alias("p"))
    known = skew.join_unique(rows, "p", rows.select(F.col("k").alias("_known")), "_known", rows.count())
    has = F.col("_known").isNotNull()
    start = known.select("k", F.when(has, F.col("p")).otherwise(F.col("k")).alias("at"), has.cast("long").alias("steps"), has.alias("open"))
    state, path = _written(start, "chains")
    left = state.filter("open").count()
    while left:
        release(spark, begun, keep=[path])
        ahead = state.select(F.col("k").alias("_k"), F.col("at").alias("_at"), F.col("steps").alias("_steps"), F.col("open").alias("_open"))
        moved = skew.join_unique(state.filter("open"), "at", ahead, "_k", left)
        jumped = moved.select("k", F.col("_at").alias("at"), (F.col("steps") + F.col("_steps")).alias("steps"), F.col("_open").alias("open"))
        state, path = _written(state.filter("NOT open").unionByName(jumped), "chains")
        before, left = left, state.filter("open").count()
        if left == before:
            break
    release(spark, begun, keep=[path])
    found = ~F.col("open")
    return state.select(F.col("k").alias(key), F.when(found, F.col("at")).alias("root"), F.when(found, F.col("steps")).alias("depth"), F.col("open").alias("in_loop"))


def with_root(df: DataFrame, key: str, parent: str, fields: list[str], prefix: str = "root_") -> DataFrame:
    """Rows with ``depth``, ``in_loop`` and the ``fields`` of the root of their chain."""
    placed = ancestry(df, key, parent)
    roots = df.select(F.col(key).alias("_root"), *[F.col(f).alias(prefix + f) for f in fields])
    known = skew.join_unique(placed, "root", roots, "_root", placed.count()).drop("_root", "root")
    return df.join(known, key, "left")
