"""Latest and n-th rows, batches and group windows on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import arrays
from docketry.operators import ranking, skew
from docketry.plans.joined import CUSTOMER_RANGE, LINE_ORDER, ORDER_RANGE, iso_day
from docketry.plans.registry import query
from docketry.sources.files import table

LINE_SQL = """l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
              strftime(l_shipdate, '%Y-%m-%d') AS ship_day"""
DESC_SQL = "PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC"
ASC_SQL = "PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"
    )


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey", "l_suppkey",
        "l_returnflag", "l_linestatus", iso_day("l_shipdate").alias("ship_day"),
    )


@query("latest_by_key", f"SELECT {LINE_SQL} FROM lineitem QUALIFY row_number() OVER ({DESC_SQL}) = 1")
def latest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(ranking.latest(_lines(spark, sf), ["l_orderkey"], LINE_ORDER))


@query("earliest_by_key", f"SELECT {LINE_SQL} FROM lineitem QUALIFY row_number() OVER ({ASC_SQL}) = 1")
def earliest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(ranking.earliest(_lines(spark, sf), ["l_orderkey"], LINE_ORDER))


_VARIANTS = {"top": "true", "kept": "l_returnflag <> 'R'", "open": "l_linestatus = 'O'"}


@query(
    "latest_multi",
    "SELECT l_orderkey, "
    + ", ".join(
        f"""CAST(max(l_linenumber) FILTER ({c}) AS BIGINT) AS {n}_line,
            strftime(arg_max(l_shipdate, (l_linenumber, l_shipdate)) FILTER ({c}), '%Y-%m-%d') AS {n}_ship"""
        for n, c in _VARIANTS.items()
    )
    + " FROM lineitem GROUP BY 1",
)
def latest_multi(spark: SparkSession, sf: str) -> DataFrame:
    best = ranking.latest_multi(
        _lines(spark, sf), ["l_orderkey"], ["l_linenumber", "l_shipdate"],
        {n: F.expr(c) for n, c in _VARIANTS.items()}, ["l_linenumber", "l_shipdate"],
    )
    return best.select(
        "l_orderkey",
        *[c for n in _VARIANTS for c in (
            F.col(f"{n}_l_linenumber").cast("long").alias(f"{n}_line"), iso_day(f"{n}_l_shipdate").alias(f"{n}_ship")
        )],
    )


@query(
    "latest_before_marker",
    """WITH m AS (SELECT l_orderkey, max(l_linenumber) FILTER (l_returnflag = 'R') AS marker FROM lineitem GROUP BY 1)
       SELECT m.l_orderkey, CAST(marker AS BIGINT) AS marker,
              CAST(max(l_linenumber) FILTER (l_returnflag <> 'R' AND l_linenumber < marker) AS BIGINT) AS before
       FROM m JOIN lineitem USING (l_orderkey) GROUP BY 1, 2""",
)
def latest_before_marker(spark: SparkSession, sf: str) -> DataFrame:
    df = ranking.latest_before(_lines(spark, sf), ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "R")
    return df.select("l_orderkey", F.col("marker").cast("long").alias("marker"), F.col("before").cast("long").alias("before"))


@query(
    "current_or_previous",
    f"""SELECT {LINE_SQL} FROM (
          SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY l_orderkey) AS n,
                 first_value(l_returnflag) OVER w AS top_flag
          FROM lineitem WINDOW w AS ({DESC_SQL}))
        WHERE rn = CASE WHEN top_flag = 'R' AND n > 1 THEN 2 ELSE 1 END""",
)
def current_or_previous(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(ranking.current_or_previous(_lines(spark, sf), ["l_orderkey"], LINE_ORDER, F.col("l_returnflag") == "R"))


@query(
    "latest_and_previous",
    f"""SELECT l_orderkey, strftime(max(l_shipdate) FILTER (rn = 1), '%Y-%m-%d') AS latest_ship,
               strftime(max(l_shipdate) FILTER (rn = 2), '%Y-%m-%d') AS previous_ship,
               max(l_returnflag) FILTER (rn = 1) AS latest_flag
        FROM (SELECT *, row_number() OVER ({DESC_SQL}) AS rn FROM lineitem) GROUP BY 1""",
)
def latest_and_previous(spark: SparkSession, sf: str) -> DataFrame:
    df = ranking.top_n_pivot(
        _lines(spark, sf), ["l_orderkey"], LINE_ORDER,
        {"latest_ship": ("l_shipdate", 1), "previous_ship": ("l_shipdate", 2), "latest_flag": ("l_returnflag", 1)},
    )
    return df.select(
        "l_orderkey", iso_day("latest_ship").alias("latest_ship"), iso_day("previous_ship").alias("previous_ship"), "latest_flag"
    )


@query(
    "drop_extra_in_group",
    """SELECT c_custkey, c_acctbal FROM (SELECT *, count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS n FROM customer)
       WHERE NOT (n > 1 AND c_acctbal < 0)""",
)
def drop_extra_in_group(spark: SparkSession, sf: str) -> DataFrame:
    df = ranking.drop_in_group(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], F.col("c_acctbal") < 0, CUSTOMER_RANGE)
    return df.select("c_custkey", "c_acctbal")


@query(
    "connected_flag",
    """SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) > 1 AS connected FROM orders""",
)
def connected_flag(spark: SparkSession, sf: str) -> DataFrame:
    df = skew.group_size(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"], ORDER_RANGE, "n")
    return df.select("o_orderkey", "o_custkey", (F.col("n") > 1).alias("connected"))


@query("peer_count", "SELECT c_custkey, count(*) OVER (PARTITION BY c_mktsegment) - 1 AS peers FROM customer")
def peer_count(spark: SparkSession, sf: str) -> DataFrame:
    df = skew.group_size(table(spark, sf, "customer"), ["c_mktsegment"], CUSTOMER_RANGE, "n")
    return df.select("c_custkey", (F.col("n") - 1).alias("peers"))


@query(
    "batch_ids",
    """SELECT batch_id, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
       FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 250 + 1 AS batch_id FROM orders)
       GROUP BY 1""",
)
def batch_ids(spark: SparkSession, sf: str) -> DataFrame:
    numbered = ranking.batch(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], ORDER_RANGE, 250)
    return numbered.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    "latest_ack",
    """SELECT user_id, event_id, CASE WHEN value >= 50 THEN 'success' ELSE 'failure' END AS outcome
       FROM events WHERE event_type = 'click'
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_ack(spark: SparkSession, sf: str) -> DataFrame:
    acks = ranking.latest(
        table(spark, sf, "events").select("user_id", "event_id", "ts", "value", "event_type"),
        ["user_id"], ["ts", "event_id"], F.col("event_type") == "click",
    )
    return acks.select("user_id", "event_id", F.when(F.col("value") >= 50, "success").otherwise("failure").alias("outcome"))


@query(
    "top_non_null",
    """SELECT o_custkey, max(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END) AS best
       FROM orders GROUP BY 1 HAVING best IS NOT NULL""",
)
def top_non_null(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice"))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.max(value).alias("best")).filter("best IS NOT NULL")


@query(
    "last_event_of_type",
    """SELECT user_id, event_id, value FROM events WHERE event_type = 'purchase'
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def last_event_of_type(spark: SparkSession, sf: str) -> DataFrame:
    """Filter before nesting and keep one row: no array is built only to take its first element."""
    best = F.max(F.struct("ts", "event_id", "value")).alias("b")
    return (
        table(spark, sf, "events").filter("event_type = 'purchase'").groupBy("user_id").agg(best)
        .select("user_id", "b.event_id", "b.value")
    )


@query(
    "top3_flags",
    """SELECT l_orderkey, array_to_string(f[1:3], ', ') || CASE WHEN len(f) > 3 THEN ', ...' ELSE '' END AS flags
       FROM (SELECT l_orderkey, list_sort(list_distinct(list(l_returnflag || l_linestatus))) AS f FROM lineitem GROUP BY 1)""",
)
def top3_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = F.sort_array(F.collect_set(F.concat("l_returnflag", "l_linestatus"))).alias("f")
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(flags)
    return per_order.select("l_orderkey", arrays.first_n_text(F.col("f"), 3).alias("flags"))
