"""Projections, filters, predicates, sorts and set operations on the given tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import dates
from docketry.operators import aggregates, projection
from docketry.plans.registry import query
from docketry.sources.files import table

AS_OF = "1998-12-01"

FLAG_LABELS = {"R": "Returned", "A": "Accepted"}
PRIORITY_BANDS = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "normal", "4-NOT SPECIFIED": "normal"}


@query(
    "decode_codes",
    """SELECT CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' ELSE l_returnflag END AS kept,
              CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' ELSE 'Other' END AS fixed,
              CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' END AS nulled,
              count(*) AS n
       FROM lineitem GROUP BY 1, 2, 3""",
)
def decode_codes(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select("l_returnflag")
    df = projection.decode_codes(df, "l_returnflag", FLAG_LABELS, name="kept")
    df = projection.decode_codes(df, "l_returnflag", FLAG_LABELS, "Other", "fixed")
    df = projection.decode_codes(df, "l_returnflag", FLAG_LABELS, None, "nulled")
    return df.groupBy("kept", "fixed", "nulled").agg(F.count(F.lit(1)).alias("n"))


@query(
    "map_lookup",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
                               WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'normal' END AS band
       FROM orders""",
)
def map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", projection.map_lookup(F.col("o_orderpriority"), PRIORITY_BANDS).alias("band")
    )


@query(
    "classify_segment",
    """SELECT state, segment, count(*) AS n FROM (
         SELECT CASE WHEN o_orderstatus = 'F' THEN 'final' WHEN o_totalprice > 250000 THEN 'large' ELSE 'open' END AS state,
                CASE WHEN CAST(o_orderdate AS DATE) + INTERVAL 24 MONTH < DATE '1998-12-01' THEN 'archive'
                     WHEN CAST(o_orderdate AS DATE) + INTERVAL 6 MONTH >= DATE '1998-12-01' THEN 'active'
                     ELSE 'retained' END AS segment
         FROM orders)
       WHERE segment <> 'archive' GROUP BY 1, 2""",
)
def classify_segment(spark: SparkSession, sf: str) -> DataFrame:
    date = F.col("o_orderdate")
    labelled = projection.classify_many(
        table(spark, sf, "orders"),
        {
            "state": ([("final", F.col("o_orderstatus") == "F"), ("large", F.col("o_totalprice") > 250000)], "open"),
            "segment": (
                [
                    ("archive", dates.retention_due(date, 24, AS_OF)),
                    ("active", ~dates.retention_due(date, 6, AS_OF)),
                ],
                "retained",
            ),
        },
    )
    return labelled.filter("segment <> 'archive'").groupBy("state", "segment").agg(F.count(F.lit(1)).alias("n"))


MATCH_PATTERNS = ["%license%", "%http%", "%@%"]


@query(
    "match_any",
    """SELECT doc_id, text LIKE '%license%' OR text LIKE '%http%' OR text LIKE '%@%' AS matched FROM documents""",
)
def match_any(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", projection.match_any(F.col("text"), MATCH_PATTERNS).alias("matched"))


@query(
    "project_when",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS o_totalprice,
              CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def project_when(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", *projection.project_when(F.col("o_orderstatus") == "O", ["o_totalprice", "o_orderpriority"])
    )


@query(
    "null_sentinels",
    """SELECT o_orderkey,
              CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', 'P') THEN o_orderpriority END AS o_orderpriority,
              CASE WHEN o_orderstatus NOT IN ('4-NOT SPECIFIED', 'P') THEN o_orderstatus END AS o_orderstatus
       FROM orders""",
)
def null_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return projection.null_if_in(df, ["o_orderpriority", "o_orderstatus"], ["4-NOT SPECIFIED", "P"])


@query(
    "not_in_modes",
    """WITH t AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders)
       SELECT count(*) FILTER (s NOT IN ('F')) AS strict_rows,
              count(*) FILTER (s IS NULL OR s NOT IN ('F')) AS tolerant_rows, count(*) AS all_rows FROM t""",
)
def not_in_modes(spark: SparkSession, sf: str) -> DataFrame:
    s = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus"))
    return table(spark, sf, "orders").agg(
        F.count_if(projection.not_in(s, ["F"], keep_null=False)).alias("strict_rows"),
        F.count_if(projection.not_in(s, ["F"], keep_null=True)).alias("tolerant_rows"),
        F.count(F.lit(1)).alias("all_rows"),
    )


@query(
    "retention_due",
    """SELECT CASE WHEN CAST(o_orderdate AS DATE) + INTERVAL 24 MONTH < DATE '1998-12-01' THEN 'due'
                   WHEN CAST(o_orderdate AS DATE) + INTERVAL 6 MONTH >= DATE '1998-12-01' THEN 'recent'
                   ELSE 'kept' END AS class, count(*) AS n
       FROM orders GROUP BY 1""",
)
def retention_due(spark: SparkSession, sf: str) -> DataFrame:
    date = F.col("o_orderdate")
    rules = [("due", dates.retention_due(date, 24, AS_OF)), ("recent", ~dates.retention_due(date, 6, AS_OF))]
    return projection.classify(table(spark, sf, "orders"), "class", rules, "kept").groupBy("class").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "retention_cross",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) + INTERVAL 60 MONTH < CAST(last_ship AS DATE) + INTERVAL 24 MONTH AS ends_first
       FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1)
         ON l_orderkey = o_orderkey""",
)
def retention_cross(spark: SparkSession, sf: str) -> DataFrame:
    ships = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("last_ship"))
    return table(spark, sf, "orders").join(ships, "o_orderkey").select(
        "o_orderkey", dates.ends_before(F.col("o_orderdate"), 60, F.col("last_ship"), 24).alias("ends_first")
    )


@query(
    "filters",
    """SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
       FROM lineitem
       WHERE l_returnflag IN ('A', 'R') AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'
         AND l_linestatus IS NOT NULL
       GROUP BY 1""",
)
def filters(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .filter(
            F.col("l_returnflag").isin("A", "R")
            & F.col("l_shipdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-12-31").cast("timestamp_ntz"))
            & F.col("l_linestatus").isNotNull()
        )
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), aggregates.total("l_quantity").cast("double").alias("quantity"))
    )


@query(
    "prefixed_columns",
    """SELECT c_custkey, c_name AS party_c_name, c_acctbal AS party_c_acctbal, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def prefixed_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Prefixed select of one side plus the columns only the other side has."""
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    extra = projection.new_columns(customer, nation)
    party = projection.rename_prefixed(customer, "party_", keep=["c_custkey", "c_nationkey"])
    return party.join(nation, "c_nationkey").select(
        "c_custkey", "party_c_name", "party_c_acctbal",
        *[F.col(c).cast("long") if c == "n_regionkey" else F.col(c) for c in extra],
    )


@query(
    "ordered_output",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_date FROM orders ORDER BY o_orderdate DESC, o_orderkey",
)
def ordered_output(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .orderBy(F.col("o_orderdate").desc(), "o_orderkey")
        .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_date"))
    )


@query(
    "nearest_bucket",
    """SELECT p_partkey, CAST((SELECT min_by(b, abs(b - p_size) * 1000 + b)
         FROM (VALUES (5),(10),(15),(20),(25),(30),(35),(40),(45),(50)) AS v(b)) AS BIGINT) AS bucket
       FROM part""",
)
def nearest_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", dates.nearest(F.col("p_size"), range(5, 51, 5)).cast("long").alias("bucket")
    )


@query(
    "union_segments",
    """SELECT DISTINCT o_custkey, segment FROM (
         SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'first' WHEN 'O' THEN 'second' ELSE 'third' END AS segment
         FROM orders) WHERE segment <> 'third'""",
)
def union_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The lists of a record from one scan: its segment, where that is one of the kept lists."""
    segment = F.when(F.col("o_orderstatus") == "F", "first").when(F.col("o_orderstatus") == "O", "second").otherwise("third")
    return table(spark, sf, "orders").select("o_custkey", segment.alias("segment")).filter(F.col("segment").isin("first", "second")).distinct()


@query(
    "union_missing_columns",
    """SELECT c_custkey AS party_id, c_name AS party_name, c_mktsegment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def union_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("party_name"), "c_mktsegment"
    )
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("party_name"))
    return customers.unionByName(suppliers, allowMissingColumns=True)
