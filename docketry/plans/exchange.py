"""Files written from the given tables and read back: snapshots, configuration, documents, text, uploads, bootstrap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators import quality
from docketry.plans.registry import query
from docketry.sources import files, sinks, snapshots
from docketry.sources.files import table
from docketry.sources.scratch import scratch_path


@query(
    "latest_snapshot_by_text",
    "SELECT s_suppkey, s_name, s_acctbal, '9' AS audit_stamp FROM supplier",
)
def latest_snapshot_by_text(spark: SparkSession, sf: str) -> DataFrame:
    """Stamps compared as text rank 9 above 10."""
    base = scratch_path(spark, "snapshots")
    supplier = table(spark, sf, "supplier")
    supplier.write.parquet(f"{base}/supplier_9.parquet")
    supplier.withColumn("s_acctbal", F.lit(0.0)).write.parquet(f"{base}/supplier_10.parquet")
    df = snapshots.read_latest(spark, base, "supplier_ingest", numeric=False)
    return df.select("s_suppkey", "s_name", "s_acctbal", "audit_stamp")


@query(
    "config_json",
    "SELECT o_orderkey, r_name AS centre FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey",
)
def config_json(spark: SparkSession, sf: str) -> DataFrame:
    """A configuration file over several lines, joined to the records it configures."""
    path = scratch_path(spark, "config")
    entry = F.struct(F.col("r_regionkey").alias("code"), F.col("r_name").alias("label"))
    listed = table(spark, sf, "region").agg(F.to_json(F.struct(F.sort_array(F.collect_list(entry)).alias("centres")), {"pretty": "true"}).alias("value"))
    listed.write.text(path)
    centres = files.read_config(spark, path).select(F.explode("centres").alias("c")).select(F.col("c.code").alias("n_regionkey"), F.col("c.label").alias("centre"))
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return orders.join(people, "o_custkey").join(nations, "c_nationkey").join(centres, "n_regionkey").select("o_orderkey", "centre")


@query(
    "document_files",
    "SELECT CAST(s_nationkey AS VARCHAR) AS folder, s_suppkey || ' ' || s_name AS line FROM supplier",
)
def document_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents found at any depth by a pattern, read whole, and cut into their lines."""
    path = scratch_path(spark, "found")
    lines = table(spark, sf, "supplier").select("s_nationkey", F.concat_ws(" ", F.col("s_suppkey").cast("string"), "s_name").alias("body"))
    sinks.write_documents(lines, path, "s_nationkey", "body")
    found = files.read_documents(spark, path, "*.txt")
    folder = F.regexp_extract("path", "s_nationkey=([^/]+)/", 1)
    return found.select(folder.alias("folder"), F.explode(F.split(F.regexp_replace("content_str", "\n$", ""), "\n")).alias("line"))


_EVENT_LINE = "event_id || ';' || event_type || ';' || user_id"


@query("recent_files", f"SELECT {_EVENT_LINE} AS line, true AS dated, true AS sized FROM events")
def recent_files(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the text files changed in the last three hours, with the size of their file joined by its path."""
    path = scratch_path(spark, "recent")
    table(spark, sf, "events").selectExpr("concat_ws(';', CAST(event_id AS STRING), event_type, CAST(user_id AS STRING)) AS value").write.text(path)
    since = F.current_timestamp() - F.expr("INTERVAL 3 HOURS")
    lines = files.read_recent_text(spark, path, since)
    # One source writes file: and the other file:// before the same path.
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    sizes = files.read_documents(spark, path).select(plain("path").alias("_path"), "length")
    return lines.join(sizes, plain("file_path") == F.col("_path"), "left").select(
        "line", F.col("modified_at").isNotNull().alias("dated"), (F.col("length") > 0).alias("sized")
    )


def _put(name: str, body: str) -> None:
    """A receiver that takes a document again without harm, and refuses the lowest priority."""
    if body == "5-LOW":
        raise ValueError(f"{name} refused")


@query(
    "upload_status",
    """SELECT 'out/' || o_orderkey || '.txt' AS path,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'failure: out/' || o_orderkey || '.txt refused' ELSE 'success' END AS transfer_status
       FROM orders""",
)
def upload_status(spark: SparkSession, sf: str) -> DataFrame:
    """The report of an upload; reading it sends nothing again."""
    named = table(spark, sf, "orders").select(F.concat(F.lit("out/"), F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("path"), "o_orderpriority")
    return sinks.upload_documents(named, _put, "path", "o_orderpriority")


@query(
    "bootstrap_table",
    "SELECT event_type AS stage, count(*) AS record_count FROM events GROUP BY 1",
)
def bootstrap_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table made empty with its schema, then filled; the second call finds it."""
    path, schema = scratch_path(spark, "bootstrap"), "stage string, record_count long"
    assert sinks.ensure_table(spark, path, schema).schema.names == ["stage", "record_count"]
    counts = table(spark, sf, "events").groupBy(F.col("event_type").alias("stage")).agg(F.count(F.lit(1)).alias("record_count"))
    sinks.append(counts, path)
    return sinks.ensure_table(spark, path, schema)


REQUIRED = {"o_orderkey": "bigint", "o_totalprice": "decimal(18,2)", "o_clerk": "string", "o_orderpriority": "string"}


@query(
    "schema_check",
    """SELECT 'o_clerk' AS column_name, 'missing' AS problem, CAST(NULL AS BIGINT) AS null_count, CAST(NULL AS BIGINT) AS repeated
       UNION ALL SELECT 'o_totalprice', 'double instead of decimal(18,2)', count(*) - count(o_totalprice), count(*) - count(DISTINCT o_totalprice) FROM orders
       UNION ALL SELECT 'o_orderkey', NULL, count(*) - count(o_orderkey), count(*) - count(DISTINCT o_orderkey) FROM orders
       UNION ALL SELECT 'o_orderpriority', NULL, count(*) - count(p), count(*) FILTER (p IS NOT NULL) - count(DISTINCT p)
         FROM (SELECT nullif(o_orderpriority, '5-LOW') AS p FROM orders)""",
)
def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    """Required columns with their problem, and the NULL and repeated values of those present."""
    df = table(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    problems = quality.schema_differences(df, REQUIRED)
    present = [c for c in REQUIRED if c in df.columns]
    nulls = quality.profile(df, present).select("column_name", "null_count")
    # Values are combined before they are counted, so a common one stays spread.
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in present])).alias("v")).select("v.*")
    counts = values.filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    repeated = counts.groupBy("column_name").agg(F.sum(F.col("n") - 1).alias("repeated"))
    named = spark.createDataFrame([(c, problems.get(c)) for c in REQUIRED], "column_name string, problem string")
    return named.join(nulls, "column_name", "left").join(repeated, "column_name", "left").select("column_name", "problem", "null_count", "repeated")
