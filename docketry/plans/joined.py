"""Joins, lookups, assembly and linking on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import text
from docketry.operators import aggregates, joins, linking, quality, ranking
from docketry.plans.registry import query
from docketry.sources.files import table

# Total order of the line history; (l_orderkey, l_linenumber) repeats.
LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
# Ranges that follow the order of a key: about a million keys, or a thousand names.
ORDER_RANGE = "shiftright(o_orderkey, 20)"
CUSTOMER_RANGE = "shiftright(c_custkey, 20)"
NAME_RANGE = "left(s_name, 15)"


def iso_day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


@query(
    "star_denorm",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice,
              o_orderstatus, c_name, c_mktsegment, n_name, r_name, p_brand, s_name
       FROM lineitem
       LEFT JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey
       LEFT JOIN part ON l_partkey = p_partkey
       LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def star_denorm(spark: SparkSession, sf: str) -> DataFrame:
    col = F.col
    wide = joins.star(
        table(spark, sf, "lineitem"),
        [
            (table(spark, sf, "orders"), col("l_orderkey") == col("o_orderkey")),
            (table(spark, sf, "customer"), col("o_custkey") == col("c_custkey")),
            (table(spark, sf, "nation"), col("c_nationkey") == col("n_nationkey")),
            (table(spark, sf, "region"), col("n_regionkey") == col("r_regionkey")),
            (table(spark, sf, "part"), col("l_partkey") == col("p_partkey")),
            (table(spark, sf, "supplier"), col("l_suppkey") == col("s_suppkey")),
        ],
    )
    return wide.select(
        "l_orderkey", "l_partkey", "l_suppkey", col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_extendedprice", "o_orderstatus", "c_name", "c_mktsegment", "n_name", "r_name", "p_brand", "s_name",
    )


@query(
    "restrict_semi",
    """SELECT c_custkey, c_name FROM customer c WHERE EXISTS (
         SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderdate > TIMESTAMP '1997-01-01')""",
)
def restrict_semi(spark: SparkSession, sf: str) -> DataFrame:
    segment = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderdate") > F.lit("1997-01-01").cast("timestamp_ntz"))
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    return joins.restrict(table(spark, sf, "customer"), segment, "c_custkey").select("c_custkey", "c_name")


@query(
    "restrict_inner",
    """SELECT l_orderkey, l_partkey, l_suppkey, state FROM lineitem JOIN (
         SELECT DISTINCT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'pending' ELSE 'open' END AS state
         FROM orders WHERE o_orderstatus <> 'F') ON l_orderkey = o_orderkey""",
)
def restrict_inner(spark: SparkSession, sf: str) -> DataFrame:
    segment = (
        table(spark, sf, "orders")
        .filter("o_orderstatus <> 'F'")
        .select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.when(F.col("o_orderstatus") == "P", "pending").otherwise("open").alias("state"),
        )
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return joins.restrict(lines, segment, "l_orderkey", ["state"])


@query(
    "anti_join",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.exclude(table(spark, sf, "customer"), keys, "c_custkey").select("c_custkey", "c_name")


@query(
    "anti_join_null",
    """SELECT o_orderkey, o_orderstatus FROM orders LEFT JOIN
         (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey
       WHERE l_orderkey IS NULL""",
)
def anti_join_null(spark: SparkSession, sf: str) -> DataFrame:
    """'Left join, keep the unmatched' is an anti join: no partner columns are built."""
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.exclude(table(spark, sf, "orders"), returned, "o_orderkey").select("o_orderkey", "o_orderstatus")


@query(
    "anti_join_null_aware",
    """WITH full_keys AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'),
            holed AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS k FROM orders WHERE o_orderstatus = 'F')
       SELECT 'whole' AS keys, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT k FROM full_keys)
       UNION ALL SELECT 'holed', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT k FROM holed)""",
)
def anti_join_null_aware(spark: SparkSession, sf: str) -> DataFrame:
    """NOT IN against keys without and with a NULL; the second keeps nothing."""
    final = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    customers = table(spark, sf, "customer").select("c_custkey")
    whole = final.select(F.col("o_custkey").alias("c_custkey"))
    holed = final.select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("c_custkey"))
    results = [
        joins.exclude(customers, keys, "c_custkey", null_aware=True).select(F.lit(name).alias("keys"), "c_custkey")
        for name, keys in (("whole", whole), ("holed", holed))
    ]
    return results[0].unionByName(results[1])


@query(
    "role_pivot_join",
    """SELECT o_orderkey, o_orderstatus,
              min(l_suppkey) FILTER (l_linenumber = 1) AS seat_1, min(l_suppkey) FILTER (l_linenumber = 2) AS seat_2,
              min(l_suppkey) FILTER (l_linenumber = 3) AS seat_3, min(l_suppkey) FILTER (l_linenumber = 4) AS seat_4,
              min(l_suppkey) FILTER (l_linenumber = 5) AS seat_5, min(l_suppkey) FILTER (l_linenumber = 6) AS seat_6,
              min(l_suppkey) FILTER (l_linenumber = 7) AS seat_7
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def role_pivot_join(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    seats = joins.role_pivot(lines, ["o_orderkey"], "l_linenumber", {f"seat_{i}": i for i in range(1, 8)}, "l_suppkey")
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(seats, "o_orderkey", "left")


PRIORITY_RULES = [
    ("O", "1-URGENT", "open urgent"),
    ("O", None, "open"),
    ("F", "2-HIGH", "final high"),
    ("P", None, "pending"),
]


@query(
    "join_or_lookup",
    """WITH rules(status, priority, label) AS (VALUES
         ('O', '1-URGENT', 'open urgent'), ('O', NULL, 'open'), ('F', '2-HIGH', 'final high'), ('P', NULL, 'pending'))
       SELECT o_orderkey, o_orderstatus, o_orderpriority, label FROM orders LEFT JOIN rules
         ON (o_orderstatus = status AND o_orderpriority = priority) OR (o_orderstatus = status AND priority IS NULL)""",
)
def join_or_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(PRIORITY_RULES, "status string, priority string, label string")
    return joins.join_any(
        table(spark, sf, "orders"),
        F.broadcast(rules),
        F.col("o_orderstatus") == F.col("status"),
        [F.col("o_orderpriority") == F.col("priority"), F.col("priority").isNull()],
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority", "label")


@query(
    "join_or_large",
    """SELECT c_custkey, s_suppkey FROM customer LEFT JOIN supplier
         ON (c_nationkey % 7 = 3 AND c_nationkey = s_nationkey) OR CAST(floor(c_acctbal / 50) AS BIGINT) = CAST(floor(s_acctbal / 50) AS BIGINT)
            OR (c_custkey % 11 = 0 AND c_custkey % 97 = s_suppkey)""",
)
def join_or_large(spark: SparkSession, sf: str) -> DataFrame:
    """Three alternatives, none of them with a key in common, on two sides that both grow."""
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 7 == 3, F.col("c_nationkey")).alias("_nation"), F.floor(F.col("c_acctbal") / 50).alias("_band"),
        F.when(F.col("c_custkey") % 11 == 0, F.col("c_custkey") % 97).alias("_chosen"),
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", F.floor(F.col("s_acctbal") / 50).alias("s_band"))
    either = [(F.col("_nation"), F.col("s_nationkey")), (F.col("_band"), F.col("s_band")), (F.col("_chosen"), F.col("s_suppkey"))]
    return joins.match_any(customers, suppliers, either, "left").select("c_custkey", "s_suppkey")


@query(
    "null_safe_join",
    """WITH rules(priority, label) AS (VALUES ('1-URGENT', 'urgent'), (NULL, 'unset')),
            t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders)
       SELECT o_orderkey, p, label FROM t JOIN rules ON p IS NOT DISTINCT FROM priority""",
)
def null_safe_join(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame([("1-URGENT", "urgent"), (None, "unset")], "priority string, label string")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("p")
    )
    return orders.join(F.broadcast(rules), F.col("p").eqNullSafe(F.col("priority"))).select("o_orderkey", "p", "label")


@query(
    "attach_options",
    """SELECT c_custkey, c_mktsegment, (SELECT string_agg(r_name, ';' ORDER BY r_regionkey) FROM region) AS options
       FROM customer""",
)
def attach_options(spark: SparkSession, sf: str) -> DataFrame:
    df = joins.attach_list(table(spark, sf, "customer"), table(spark, sf, "region"), "items", "r_regionkey", "r_name")
    return df.select(
        "c_custkey", "c_mktsegment", F.array_join(F.transform("items", lambda i: i["r_name"]), ";").alias("options")
    )


@query(
    "unify_outputs",
    """WITH j AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Failure: no body' ELSE o_orderpriority END AS js FROM orders),
            h AS (SELECT l_orderkey AS o_orderkey, CASE WHEN count(*) > 6 THEN 'Failure: too long' ELSE 'html' END AS ht
                  FROM lineitem GROUP BY 1)
       SELECT o_orderkey, js, ht FROM j JOIN h USING (o_orderkey) WHERE js NOT LIKE 'Failure%' AND ht NOT LIKE 'Failure%'""",
)
def unify_outputs(spark: SparkSession, sf: str) -> DataFrame:
    json_out = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "Failure: no body").otherwise(F.col("o_orderpriority")).alias("js"),
    )
    html_out = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.when(F.count(F.lit(1)) > 6, "Failure: too long").otherwise("html").alias("ht"))
    )
    return joins.unify([json_out, html_out], "o_orderkey", ["js", "ht"])


@query(
    "assemble_wide",
    """SELECT o_orderkey, o_orderstatus, lines, quantity, first_ship, returned
       FROM orders
       LEFT JOIN (SELECT l_orderkey, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
                  FROM lineitem GROUP BY 1) a ON a.l_orderkey = o_orderkey
       LEFT JOIN (SELECT l_orderkey, strftime(min(l_shipdate), '%Y-%m-%d') AS first_ship FROM lineitem GROUP BY 1) b
         ON b.l_orderkey = o_orderkey
       LEFT JOIN (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1) c
         ON c.l_orderkey = o_orderkey""",
)
def assemble_wide(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    groups = [
        lines.groupBy("o_orderkey").agg(
            F.count(F.lit(1)).alias("lines"), aggregates.total("l_quantity").cast("double").alias("quantity")
        ),
        lines.groupBy("o_orderkey").agg(F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_ship")),
        aggregates.group_flag(lines, ["o_orderkey"], F.col("l_returnflag") == "R", "returned"),
    ]
    return joins.assemble(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), groups, "o_orderkey")


@query(
    "normalise_key",
    """SELECT c_custkey, c_mktsegment || '/' || c_custkey AS record_key FROM customer""",
)
def normalise_key(spark: SparkSession, sf: str) -> DataFrame:
    """Keys recovered from the file names written for them."""
    customer = table(spark, sf, "customer")
    path = F.concat(
        F.lit("published/out/case_"), F.col("c_mktsegment"), F.lit("_"), F.col("c_custkey").cast("string"),
        F.when(F.col("c_acctbal") > 0, ".json").otherwise(".html"),
    )
    return customer.select("c_custkey", text.normalise_key(path, "case_", [".json", ".html"]).alias("record_key"))


ALLOWED_PAIRS = [("R", "F"), ("A", "F"), ("N", "O"), ("N", "O")]


@query(
    "valid_pairs",
    """SELECT l_returnflag, l_linestatus, (l_returnflag, l_linestatus) IN (('R','F'), ('A','F'), ('N','O')) AS is_valid_pair,
              count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
)
def valid_pairs(spark: SparkSession, sf: str) -> DataFrame:
    allowed = spark.createDataFrame(ALLOWED_PAIRS, "flag string, status string")
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    marked = joins.in_pairs(lines, ["l_returnflag", "l_linestatus"], allowed, "is_valid_pair")
    return marked.groupBy("l_returnflag", "l_linestatus", "is_valid_pair").agg(F.count(F.lit(1)).alias("n"))


@query(
    "linked_peers",
    """SELECT s_suppkey, CAST(s_nationkey AS BIGINT) AS s_nationkey,
              row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey) AS position,
              count(*) OVER (PARTITION BY s_nationkey) - 1 AS peers
       FROM supplier QUALIFY peers > 0""",
)
def linked_peers(spark: SparkSession, sf: str) -> DataFrame:
    members = linking.membership(table(spark, sf, "supplier"), "s_nationkey", ["s_name", "s_suppkey"], NAME_RANGE)
    return members.select("s_suppkey", F.col("s_nationkey").cast("long").alias("s_nationkey"), "position", "peers")


@query(
    "link_groups",
    """SELECT CAST(s_nationkey AS BIGINT) AS s_nationkey, (rn - 1) // 3 AS part, string_agg(s_suppkey || ':' || s_name, ';' ORDER BY s_suppkey) AS members
       FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier) GROUP BY 1, 2""",
)
def link_groups(spark: SparkSession, sf: str) -> DataFrame:
    member = F.concat_ws(":", F.col("s_suppkey").cast("string"), "s_name")
    groups = linking.group_members(table(spark, sf, "supplier"), "s_nationkey", member, ["s_suppkey"], F.floor(F.col("s_suppkey") / 1000), size=3)
    return groups.select(
        F.col("s_nationkey").cast("long").alias("s_nationkey"), "part", F.array_join("members", ";").alias("members")
    )


@query(
    "pair_combinations",
    """SELECT CAST(s_nationkey AS BIGINT) AS s_nationkey, s_suppkey AS from_key,
              lead(s_suppkey) OVER w AS to_key, row_number() OVER w AS from_position
       FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey)
       QUALIFY to_key IS NOT NULL""",
)
def pair_combinations(spark: SparkSession, sf: str) -> DataFrame:
    pairs = linking.chain(table(spark, sf, "supplier"), "s_nationkey", "s_suppkey", ["s_name", "s_suppkey"], NAME_RANGE)
    return pairs.select(F.col("s_nationkey").cast("long").alias("s_nationkey"), "from_key", "to_key", "from_position")


@query(
    "fallback_lookup",
    """WITH last_order AS (
         SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
       SELECT c_custkey, coalesce(f.o_orderpriority, 'open ' || o.o_orderstatus, n_name, 'none') AS centre
       FROM customer
       LEFT JOIN (SELECT * FROM last_order WHERE o_orderstatus = 'F') f ON f.o_custkey = c_custkey
       LEFT JOIN (SELECT * FROM last_order WHERE o_orderstatus = 'O') o ON o.o_custkey = c_custkey
       LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def fallback_lookup(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority")
    last = ranking.latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    final = last.filter("o_orderstatus = 'F'")
    opened = last.filter("o_orderstatus = 'O'").withColumn("opened", F.concat(F.lit("open "), "o_orderstatus"))
    return joins.fallback_lookup(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"),
        [
            (final, "c_custkey", "o_custkey", "o_orderpriority"),
            (opened, "c_custkey", "o_custkey", "opened"),
            (table(spark, sf, "nation"), "c_nationkey", "n_nationkey", "n_name"),
        ],
        "centre",
        "none",
    ).select("c_custkey", "centre")


@query(
    "duplicates",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies
       FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicates(spark: SparkSession, sf: str) -> DataFrame:
    quality.assert_unique(table(spark, sf, "orders"), ["o_orderkey"])
    found = aggregates.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return found.withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
