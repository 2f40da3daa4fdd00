"""Scalar function families on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import dates
from docketry.operators import projection
from docketry.plans.registry import query
from docketry.sources.files import table


@query(
    "string_functions",
    """SELECT p_partkey, p_brand || '/' || p_type AS code, concat_ws(' ', p_name, p_brand) AS title,
              split_part(p_name, ' ', 2) AS second_word, regexp_replace(p_brand, '[0-9]+', '#') AS masked,
              regexp_extract(p_brand, '([0-9]+)', 1) AS number, regexp_matches(p_name, '^(red|blue)') AS coloured,
              p_type LIKE 'S%' AS starts_s, contains(p_name, 'bolt') AS has_bolt, ends_with(p_name, 'ring') AS ends_ring,
              upper(p_name) AS up, lower(p_brand) AS low, trim('  ' || p_name || ' ') AS trimmed,
              CAST(length(p_name) AS BIGINT) AS len, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded,
              replace(p_brand, '#', '-') AS dashed
       FROM part""",
)
def string_functions(spark: SparkSession, sf: str) -> DataFrame:
    name, brand = F.col("p_name"), F.col("p_brand")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat(brand, F.lit("/"), "p_type").alias("code"),
        F.concat_ws(" ", name, brand).alias("title"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("second_word"),
        F.regexp_replace(brand, "[0-9]+", "#").alias("masked"),
        F.regexp_extract(brand, "([0-9]+)", 1).alias("number"),
        name.rlike("^(red|blue)").alias("coloured"),
        F.col("p_type").like("S%").alias("starts_s"),
        name.contains("bolt").alias("has_bolt"),
        name.endswith("ring").alias("ends_ring"),
        F.upper(name).alias("up"),
        F.lower(brand).alias("low"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.length(name).cast("long").alias("len"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.replace(brand, F.lit("#"), F.lit("-")).alias("dashed"),
    )


@query(
    "date_functions",
    """SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS uk_date, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso,
              strftime(CAST(o_orderdate AS DATE) + 14, '%Y-%m-%d') AS plus_days,
              strftime(CAST(o_orderdate AS DATE) + INTERVAL 7 MONTH, '%Y-%m-%d') AS plus_months,
              strftime(CAST(o_orderdate AS DATE) + INTERVAL 2 YEAR, '%Y-%m-%d') AS plus_years,
              CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-12-01') AS BIGINT) AS age_days,
              CAST(epoch(o_orderdate) AS BIGINT) AS seconds,
              strftime(o_orderdate + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M') AS later
       FROM orders""",
)
def date_functions(spark: SparkSession, sf: str) -> DataFrame:
    date = F.col("o_orderdate")
    day = "yyyy-MM-dd"
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(date, "dd/MM/yyyy").alias("uk_date"),
        F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"),
        F.date_format(F.date_add(date, 14), day).alias("plus_days"),
        F.date_format(F.add_months(date, 7), day).alias("plus_months"),
        F.date_format(dates.add_years(date, 2), day).alias("plus_years"),
        F.datediff(F.lit("1998-12-01").cast("date"), date).cast("long").alias("age_days"),
        F.unix_timestamp(date).alias("seconds"),
        F.date_format(date + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd HH:mm").alias("later"),
    )


@query(
    "math_functions",
    """SELECT c_custkey, abs(c_acctbal) AS magnitude, CAST(floor(c_acctbal) AS BIGINT) AS low,
              CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(18,1)) + 0.0 AS one_place, c_custkey % 7 AS remainder
       FROM customer""",
)
def math_functions(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.abs(value).alias("magnitude"),
        F.floor(value).alias("low"),
        F.round(value.cast("decimal(18,2)"), 1).cast("double").alias("one_place"),
        (F.col("c_custkey") % 7).alias("remainder"),
    )


@query(
    "array_functions",
    """SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n, CAST(list_min(embedding) AS DOUBLE) AS least,
              CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[-1] AS DOUBLE) AS last_value,
              CAST(list_sort(embedding, 'DESC')[1] AS DOUBLE) AS greatest,
              CAST(len([x FOR x IN embedding IF x > 0]) AS BIGINT) AS positive,
              CAST(len(embedding[1:3]) AS BIGINT) AS head, list_contains(embedding, CAST(9 AS FLOAT)) AS has_nine,
              CAST(len(list_distinct([sign(x) FOR x IN embedding])) AS BIGINT) AS signs
       FROM embeddings""",
)
def array_functions(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.size(e).cast("long").alias("n"),
        F.array_min(e).cast("double").alias("least"),
        F.element_at(e, 1).cast("double").alias("first_value"),
        F.element_at(e, -1).cast("double").alias("last_value"),
        F.sort_array(e, False)[0].cast("double").alias("greatest"),
        F.size(F.filter(e, lambda x: x > 0)).cast("long").alias("positive"),
        F.size(F.slice(e, 1, 3)).cast("long").alias("head"),
        F.array_contains(e, F.lit(9.0).cast("float")).alias("has_nine"),
        F.size(F.array_distinct(F.transform(e, F.signum))).cast("long").alias("signs"),
    )


@query(
    "array_set_functions",
    """SELECT p_partkey, list_has_any([p_type, p_brand], ['PROMO', 'Brand#2']) AS overlaps,
              array_to_string(list_sort(list_intersect([p_type, 'SMALL', 'PROMO'], ['PROMO', 'ECONOMY'])), ',') AS shared,
              array_to_string([x FOR x IN [p_type, CASE WHEN p_size > 25 THEN 'large' END] IF x IS NOT NULL], ',') AS kept,
              array_to_string(flatten([[p_type], [p_brand, p_name]]), '|') AS flat
       FROM part""",
)
def array_set_functions(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("p_type")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.arrays_overlap(F.array(kind, "p_brand"), F.array(F.lit("PROMO"), F.lit("Brand#2"))).alias("overlaps"),
        F.array_join(
            F.sort_array(
                F.array_intersect(F.array(kind, F.lit("SMALL"), F.lit("PROMO")), F.array(F.lit("PROMO"), F.lit("ECONOMY")))
            ),
            ",",
        ).alias("shared"),
        F.array_join(F.array_compact(F.array(kind, F.when(F.col("p_size") > 25, "large"))), ",").alias("kept"),
        F.array_join(F.flatten(F.array(F.array(kind), F.array("p_brand", "p_name"))), "|").alias("flat"),
    )


@query(
    "json_functions",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
              '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS document
       FROM events""",
)
def json_functions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        F.from_json("props", "k long")["k"].alias("k"),
        F.to_json(F.struct("event_id", "event_type", F.lit(None).cast("string").alias("left_out"))).alias("document"),
    )


@query(
    "struct_map_functions",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'final' END AS label,
              'changed ' || o_orderpriority AS changed, o_totalprice AS kept,
              split_part(sha256(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus), ' ', 1) AS record_id
       FROM orders""",
)
def struct_map_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Struct fields, a map lookup and an id that a second run repeats."""
    item = F.struct("o_orderpriority", "o_totalprice").withField(
        "o_orderpriority", F.concat(F.lit("changed "), "o_orderpriority")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        projection.literal_map({"O": "open", "F": "final"})[F.col("o_orderstatus")].alias("label"),
        item.getField("o_orderpriority").alias("changed"),
        item.getField("o_totalprice").alias("kept"),
        F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus"), 256).alias("record_id"),
    )


@query(
    "conditional_functions",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END, 'none') AS known,
              nullif(o_orderstatus, 'F') AS not_final, o_orderpriority IN ('1-URGENT', '2-HIGH') AS hurry,
              (nullif(o_orderstatus, 'F') IS NOT DISTINCT FROM NULL) AS is_unset, CAST(o_totalprice AS BIGINT) >= 100000 AS large
       FROM orders""",
)
def conditional_functions(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    unset = F.nullif(status, F.lit("F"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.coalesce(F.when(status != "P", F.col("o_orderpriority")), F.lit("none")).alias("known"),
        unset.alias("not_final"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("hurry"),
        unset.eqNullSafe(F.lit(None)).alias("is_unset"),
        (F.round("o_totalprice").cast("long") >= 100000).alias("large"),
    )
