"""Wide source records on raw tables that stand for those of a case system.

Lines are status rows, hearings and transactions, parts are lists, suppliers officers, nations courts and types,
customers users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.cases import wide
from docketry.plans.casework_tables import _LINE_ID
from docketry.plans.registry import query
from docketry.sources.files import table


def officers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr("s_suppkey AS AdjudicatorId", "s_name AS Surname", "CAST(s_acctbal < 0 AS INT) AS DoNotList")


@query(
    "case_hearings",
    f"""WITH seat AS (
          SELECT l_partkey AS list, min(l_suppkey) FILTER (l_linenumber = 1) AS chair, min(l_suppkey) FILTER (l_linenumber = 2) AS second,
                 min(l_suppkey) FILTER (l_linenumber = 3) AS third, min(l_suppkey) FILTER (l_linenumber = 4) AS clerk
          FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
        SELECT l_orderkey AS record, CAST({_LINE_ID} AS BIGINT) AS status, p_partkey AS list, CASE WHEN p_partkey IS NOT NULL THEN CAST(l_quantity AS INT) END AS estimate, n_name AS court,
               a.s_name AS chair, b.s_name AS second, c.s_name AS third, d.s_name AS clerk, e.s_name AS allocated, g.s_name AS decided_by
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND l_linestatus = 'F'
        LEFT JOIN nation ON n_nationkey = p_size AND p_type <> 'PROMO' LEFT JOIN seat ON list = p_partkey
        LEFT JOIN supplier a ON a.s_suppkey = chair LEFT JOIN supplier b ON b.s_suppkey = second LEFT JOIN supplier c ON c.s_suppkey = third
        LEFT JOIN supplier d ON d.s_suppkey = clerk LEFT JOIN supplier e ON e.s_suppkey = l_suppkey
        LEFT JOIN supplier g ON g.s_suppkey = CASE WHEN l_returnflag = 'A' THEN l_suppkey + 1 END""",
)
def case_hearings(spark: SparkSession, sf: str) -> DataFrame:
    """Status rows with list, court and bench; the officers take part in six roles."""
    lines = table(spark, sf, "lineitem")
    # A list is named by the line itself, so a status is on at most one.
    statuses = lines.selectExpr(
        "l_orderkey AS CaseNo", f"CAST({_LINE_ID} AS BIGINT) AS StatusNo", "struct(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate) AS StatusId",
        "l_suppkey AS AdjudicatorId", "CASE WHEN l_returnflag = 'A' THEN l_suppkey + 1 END AS DeterminationBy",
    )
    placements = lines.filter("l_linestatus = 'F'").selectExpr(
        "struct(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate) AS StatusId", "l_partkey AS ListId", "CAST(l_quantity AS INT) AS TimeEstimate"
    )
    lists = table(spark, sf, "part").selectExpr("p_partkey AS ListId", "CASE WHEN p_type <> 'PROMO' THEN p_size END AS CourtId", "p_type AS ListTypeId")
    courts = table(spark, sf, "nation").selectExpr("n_nationkey AS CourtId", "n_name AS CourtName")
    sittings = lines.selectExpr(
        "l_partkey AS ListId", "CASE l_linenumber WHEN 1 THEN 10 WHEN 2 THEN 11 WHEN 3 THEN 12 WHEN 4 THEN 3 END AS Position",
        "CAST(l_returnflag = 'R' AS INT) AS Cancelled", "l_suppkey AS AdjudicatorId",
    )
    made = wide.hearings(statuses, placements, lists, courts, sittings, officers(spark, sf))
    return made.select(
        F.col("CaseNo").alias("record"), F.col("StatusNo").alias("status"), F.col("ListId").alias("list"), F.col("TimeEstimate").alias("estimate"),
        "court", "chair", "second", "third", "clerk", "allocated", "decided_by",
    )


@query(
    "case_bench",
    "SELECT l_orderkey AS record, l_linenumber::BIGINT AS place, s_name AS judge FROM lineitem JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal >= 0",
)
def case_bench(spark: SparkSession, sf: str) -> DataFrame:
    assigned = table(spark, sf, "lineitem").selectExpr("l_orderkey AS record", "CAST(l_linenumber AS BIGINT) AS place", "l_suppkey AS AdjudicatorId")
    return wide.bench(assigned, officers(spark, sf)).select("record", "place", "judge")


@query(
    "case_payments",
    """SELECT l_orderkey AS record, l_linenumber::BIGINT AS place, n_name AS type, a.c_name AS created_by, b.c_name AS changed_by
       FROM lineitem LEFT JOIN nation ON n_nationkey = l_linenumber LEFT JOIN customer a ON a.c_custkey = l_suppkey
       LEFT JOIN customer b ON b.c_custkey = CASE WHEN l_returnflag <> 'N' THEN l_partkey END""",
)
def case_payments(spark: SparkSession, sf: str) -> DataFrame:
    made = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS record", "CAST(l_linenumber AS BIGINT) AS place", "l_linenumber AS TransactionTypeId", "l_suppkey AS CreateUserId",
        "CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS LastEditUserId",
    )
    types = table(spark, sf, "nation").selectExpr("n_nationkey AS TransactionTypeId", "n_name AS Description")
    users = table(spark, sf, "customer").selectExpr("c_custkey AS UserId", "c_name AS Name")
    return wide.payments(made, types, users).select("record", "place", "type", "created_by", "changed_by")


@query(
    "case_star",
    """SELECT l_orderkey, l_partkey, o_orderstatus, c_name, cn.n_name AS customer_nation, s_name, sn.n_name AS supplier_nation, p_type
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN part ON l_partkey = p_partkey AND p_size > 10""",
)
def case_star(spark: SparkSession, sf: str) -> DataFrame:
    """A star with one table in two roles and one required partner."""
    nations = table(spark, sf, "nation")
    df = wide.follow(table(spark, sf, "lineitem"), "l_orderkey", table(spark, sf, "orders"), "o_orderkey", {"o_orderstatus": "o_orderstatus", "o_custkey": "party"})
    df = wide.follow(df, "party", table(spark, sf, "customer"), "c_custkey", {"c_name": "c_name", "c_nationkey": "home"})
    df = wide.follow(df, "home", nations, "n_nationkey", {"n_name": "customer_nation"})
    df = wide.follow(df, "l_suppkey", table(spark, sf, "supplier"), "s_suppkey", {"s_name": "s_name", "s_nationkey": "base"})
    df = wide.follow(df, "base", nations, "n_nationkey", {"n_name": "supplier_nation"})
    df = wide.follow(df, "l_partkey", table(spark, sf, "part").filter("p_size > 10"), "p_partkey", {"p_type": "p_type"}, required=True)
    return df.select("l_orderkey", "l_partkey", "o_orderstatus", "c_name", "customer_nation", "s_name", "supplier_nation", "p_type")
