"""Data-quality rules on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators import aggregates, joins, projection, quality, ranking
from docketry.plans.joined import ORDER_RANGE
from docketry.plans.registry import query
from docketry.sources.files import table

ORDER_RULES = {
    "status_known": "o_orderstatus IN ('F', 'O', 'P')",
    "price_positive": "o_totalprice > 0",
    "has_lines": "lines >= 1",
    "ship_after_order": "first_ship >= o_orderdate",
    "priority_form": "o_orderpriority RLIKE '^[1-4]-'",
    "final_is_closed": "NOT (o_orderstatus = 'F' AND open_lines > 2)",
    "urgent_is_small": "NOT (o_orderpriority = '1-URGENT' AND quantity > 150)",
    "customer_known": "c_mktsegment IS NOT NULL",
}

_ENRICHED = """(SELECT orders.*, lines, open_lines, quantity, first_ship, c_mktsegment FROM orders
   LEFT JOIN (SELECT l_orderkey, count(*) AS lines, count(*) FILTER (l_linestatus = 'O') AS open_lines,
                     CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, min(l_shipdate) AS first_ship
              FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
   LEFT JOIN customer ON c_custkey = o_custkey)"""
# What passes each rule, written out again for the SQL side.
_PASS = {
    "status_known": "coalesce(o_orderstatus = 'F' OR o_orderstatus = 'O' OR o_orderstatus = 'P', false)",
    "price_positive": "coalesce(o_totalprice, 0) > 0",
    "has_lines": "coalesce(lines, 0) > 0",
    "ship_after_order": "coalesce(o_orderdate <= first_ship, false)",
    "priority_form": "coalesce(substr(o_orderpriority, 1, 1) IN ('1', '2', '3', '4') AND substr(o_orderpriority, 2, 1) = '-', false)",
    "final_is_closed": "coalesce(o_orderstatus <> 'F' OR open_lines <= 2, false)",
    "urgent_is_small": "coalesce(o_orderpriority <> '1-URGENT' OR quantity <= 150, false)",
    "customer_known": "c_mktsegment IS NOT NULL",
}
_ALL = " AND ".join(_PASS.values())


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the columns the rules need."""
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
            aggregates.total("l_quantity").cast("double").alias("quantity"),
            F.min("l_shipdate").alias("first_ship"),
        )
    )
    parties = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.assemble(table(spark, sf, "orders"), [lines], "o_orderkey").join(parties, "o_custkey", "left")


@query(
    "dq_enrich",
    f"""SELECT o_orderkey, lines, open_lines, quantity, strftime(first_ship, '%Y-%m-%d') AS first_ship, c_mktsegment FROM {_ENRICHED}""",
)
def dq_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return enriched(spark, sf).select(
        "o_orderkey", "lines", "open_lines", "quantity", F.date_format("first_ship", "yyyy-MM-dd").alias("first_ship"), "c_mktsegment"
    )


@query(
    "dq_rules",
    " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER ({p}) AS passed, count(*) FILTER (NOT {p}) AS failed FROM {_ENRICHED}" for n, p in _PASS.items()
    ),
)
def dq_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rule_counts(enriched(spark, sf), ORDER_RULES)


@query("dq_valid", f"SELECT o_orderkey, {_ALL} AS is_valid FROM {_ENRICHED}")
def dq_valid(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate(enriched(spark, sf), ORDER_RULES).select("o_orderkey", "is_valid")


NULL_KEY_RULES = {"has_key": "o_orderkey IS NOT NULL", "has_owner": "owner IS NOT NULL", "owner_positive": "owner > 0"}


@query(
    "dq_counts",
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS owner FROM orders)
       SELECT 'has_key' AS rule, count(*) AS passed, CAST(0 AS BIGINT) AS failed FROM t
       UNION ALL SELECT 'has_owner', count(*) FILTER (owner IS NOT NULL), count(*) FILTER (owner IS NULL) FROM t
       UNION ALL SELECT 'owner_positive', count(*) FILTER (coalesce(owner > 0, false)), count(*) FILTER (NOT coalesce(owner > 0, false)) FROM t""",
)
def dq_counts(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("owner"))
    return quality.rule_counts(df, NULL_KEY_RULES)


@query("dq_drop", f"SELECT o_orderkey, o_totalprice FROM {_ENRICHED} WHERE {_ALL}")
def dq_drop(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_invalid(enriched(spark, sf), ORDER_RULES).select("o_orderkey", "o_totalprice")


@query(
    "dq_fail",
    """SELECT 'status_known' AS rule, count(*) AS passed, CAST(0 AS BIGINT) AS failed FROM orders
       UNION ALL SELECT 'price_positive', count(*), 0 FROM orders""",
)
def dq_fail(spark: SparkSession, sf: str) -> DataFrame:
    """Raises when a rule is broken; here both hold."""
    must = {n: ORDER_RULES[n] for n in ("status_known", "price_positive")}
    orders = quality.expect_or_fail(table(spark, sf, "orders"), must)
    return quality.rule_counts(orders, must)


@query(
    "dq_quarantine",
    f"""SELECT o_orderkey, CASE WHEN {_ALL} THEN 'out/JSON/' ELSE 'out/INVALID_JSON/' END || o_orderkey || '.json' AS path,
               concat_ws(',', {', '.join(f"CASE WHEN NOT {p} THEN '{n}' END" for n, p in _PASS.items())}) AS failed_rules
        FROM {_ENRICHED}""",
)
def dq_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Valid and invalid rows with their folders in one pass; together they are the whole input."""
    path = F.concat(F.lit("out/JSON/"), F.col("o_orderkey").cast("string"), F.lit(".json"))
    marked = quality.mark(enriched(spark, sf), ORDER_RULES)
    return marked.select(
        "o_orderkey",
        quality.quarantine_path(path, F.col("is_valid")).alias("path"),
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


_PROFILE = ["o_orderkey", "owner", "priority"]


@query(
    "profile_nulls",
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS owner,
                         nullif(o_orderpriority, '5-LOW') AS priority FROM orders)
       """
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count FROM t" for c in _PROFILE),
)
def profile_nulls(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("owner"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    return quality.profile(df, _PROFILE)


@query(
    "check_outputs",
    """WITH t AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'order_0' ELSE 'order_' || o_orderkey END AS file_name,
                         o_orderpriority, (row_number() OVER (ORDER BY o_orderkey) - 1) // 250 + 1 AS batch_id FROM orders)
       SELECT 'file_name_unique' AS check_name, count(*) AS failures FROM (SELECT file_name FROM t GROUP BY 1 HAVING count(*) > 1)
       UNION ALL SELECT 'batch_size', count(*) FROM (SELECT batch_id FROM t GROUP BY 1 HAVING count(*) > 250)
       UNION ALL SELECT 'pattern_file_name', count(*) FILTER (NOT regexp_matches(file_name, '^order_[1-9][0-9]*$')) FROM t
       UNION ALL SELECT 'pattern_o_orderpriority', count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z]+$')) FROM t""",
)
def check_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """File names unique, batches full at most, names and priorities well formed."""
    key = F.col("o_orderkey")
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.when(key % 50 == 0, "order_0").otherwise(F.concat(F.lit("order_"), key.cast("string"))).alias("file_name"),
    )
    batched = ranking.batch(df, ["o_orderkey"], ORDER_RANGE, 250)
    patterns = {"file_name": "^order_[1-9][0-9]*$", "o_orderpriority": "^[1-5]-[A-Z]+$"}
    return quality.check_outputs(batched, "file_name", "batch_id", 250, patterns)


# Order states from status, the latest line and the balance of lines not returned.
STATE_RULES = [
    ("closed", "o_orderstatus = 'F' AND last_status = 'F' AND last_flag <> 'R'"),
    ("returned", "last_flag = 'R' AND balance = 0"),
    ("part_returned", "last_flag = 'R'"),
    ("shipping", "o_orderstatus = 'O' AND last_status = 'O'"),
    ("review", "o_orderstatus = 'P' AND balance > 100000"),
    ("pending", "o_orderstatus = 'P'"),
]
CASE_RULES = {"has_balance": "balance IS NOT NULL", "region_known": "r_name IS NOT NULL", "not_oversized": "balance < 400000"}

_CASES = """(SELECT o_orderkey, o_orderstatus, c_name, n_name, r_name, balance, last_flag, last_status FROM orders
   LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
   LEFT JOIN (SELECT l_orderkey, coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag <> 'R'), 0) AS balance FROM lineitem GROUP BY 1) b
     ON b.l_orderkey = o_orderkey
   LEFT JOIN (SELECT l_orderkey, l_returnflag AS last_flag, l_linestatus AS last_status FROM lineitem
              QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1) f
     ON f.l_orderkey = o_orderkey)"""
_STATE = """CASE WHEN o_orderstatus = 'F' AND last_status = 'F' AND last_flag IN ('A', 'N') THEN 'closed'
    WHEN last_flag = 'R' THEN CASE WHEN balance = 0 THEN 'returned' ELSE 'part_returned' END
    WHEN o_orderstatus = 'O' AND last_status = 'O' THEN 'shipping'
    WHEN o_orderstatus = 'P' THEN CASE WHEN balance > 100000 THEN 'review' ELSE 'pending' END ELSE 'unknown' END"""


def case_records(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in their star with the latest line and the balance, from one pass over the lines.

    The latest row and the sum share one aggregate, so the history is shuffled once, combined per key.
    """
    line = F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    history = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.max(line).alias("last"),
            F.coalesce(
                aggregates.total("l_extendedprice", F.col("l_returnflag") != "R"), F.lit(0).cast("decimal(18,2)")
            ).alias("balance"),
        )
        .select("o_orderkey", "balance", F.col("last.l_returnflag").alias("last_flag"), F.col("last.l_linestatus").alias("last_status"))
    )
    col = F.col
    wide = joins.star(
        table(spark, sf, "orders"),
        [
            (table(spark, sf, "customer"), col("o_custkey") == col("c_custkey")),
            (table(spark, sf, "nation"), col("c_nationkey") == col("n_nationkey")),
            (table(spark, sf, "region"), col("n_regionkey") == col("r_regionkey")),
            (history, "o_orderkey"),
        ],
    )
    rules = [(name, F.expr(cond)) for name, cond in STATE_RULES]
    return projection.classify(wide, "state", rules, "unknown")


@query("classify_state", f"SELECT {_STATE} AS state, count(*) AS n FROM {_CASES} GROUP BY 1")
def classify_state(spark: SparkSession, sf: str) -> DataFrame:
    return case_records(spark, sf).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(
    "case_states",
    f"""SELECT {_STATE} AS state, coalesce(balance IS NOT NULL AND r_name IS NOT NULL AND balance < 400000, false) AS is_valid,
               count(*) AS records, CAST(coalesce(sum(balance), 0) AS DOUBLE) AS balance
        FROM {_CASES} GROUP BY 1, 2""",
)
def case_states(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.validate(case_records(spark, sf), CASE_RULES)
    return checked.groupBy("state", "is_valid").agg(
        F.count(F.lit(1)).alias("records"), F.coalesce(F.sum("balance"), F.lit(0)).cast("double").alias("balance")
    )
