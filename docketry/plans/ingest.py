"""Scans, sources and sinks on the given tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators import joins, ranking
from docketry.plans.registry import query
from docketry.sources import files, sinks, snapshots
from docketry.sources.files import table
from docketry.sources.scratch import scratch_path
from docketry.streaming import feeds


@query(
    "latest_snapshot",
    """SELECT c_custkey, c_name, c_acctbal, '10' AS audit_stamp, 'customer_ingest' AS audit_process
       FROM customer""",
)
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "snapshots")
    customer = table(spark, sf, "customer")
    customer.withColumn("c_acctbal", F.lit(0.0)).write.parquet(f"{base}/full/customer_9.parquet")
    customer.write.parquet(f"{base}/full/2024/customer_10.parquet")
    df = snapshots.read_latest(spark, base, "customer_ingest")
    return df.select("c_custkey", "c_name", "c_acctbal", "audit_stamp", "audit_process")


@query("scan_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    """By name through the catalogue, as the pipelines read each other's tables."""
    table(spark, sf, "orders").createOrReplaceTempView("docketry_orders")
    return files.table_or_catalog(spark, "docketry_orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "lookup_csv",
    """SELECT s_suppkey, s_name || '"' || chr(10) || '{"id": ' || s_suppkey || '}' AS s_note,
              CAST(s_nationkey AS BIGINT) AS s_nationkey
       FROM supplier""",
)
def lookup_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lookup")
    (
        table(spark, sf, "supplier")
        .select(
            "s_suppkey",
            F.concat("s_name", F.lit('"\n{"id": '), F.col("s_suppkey").cast("string"), F.lit("}")).alias("s_note"),
            "s_nationkey",
        )
        .write.option("header", True)
        .option("escape", '"')
        .option("quoteAll", True)
        .csv(path)
    )
    return files.read_lookup(spark, path, "s_suppkey long, s_note string, s_nationkey long", multiline=True)


@query(
    "external_merge",
    """SELECT c_custkey, c_name FROM customer c
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""",
)
def external_merge(spark: SparkSession, sf: str) -> DataFrame:
    """An external list with repeated rows, deduplicated and reduced to records we do not hold."""
    path = scratch_path(spark, "external")
    listed = table(spark, sf, "customer").select("c_custkey", "c_name")
    listed.unionAll(listed).write.option("header", True).csv(path)
    external = ranking.earliest(files.read_inferred_csv(spark, path), ["c_custkey"], ["c_name"])
    held = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.exclude(external, held, "c_custkey").select(F.col("c_custkey").cast("long"), "c_name")


@query(
    "recent_window",
    """SELECT event_id, user_id, event_type FROM events
       WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 HOUR""",
)
def recent_window(spark: SparkSession, sf: str) -> DataFrame:
    """One value comes to the driver, so that the time filter reaches the parquet scan."""
    events = table(spark, sf, "events")
    newest = events.agg(F.max("ts")).first()[0]
    since = F.lit(newest - timedelta(hours=3)).cast(events.schema["ts"].dataType)
    return events.filter(F.col("ts") >= since).select("event_id", "user_id", "event_type")


@query(
    "parse_json_value",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def parse_json_value(spark: SparkSession, sf: str) -> DataFrame:
    return files.parse_json_value(table(spark, sf, "events"), "k long", "props", keep=["event_id"])


@query(
    "stream_json",
    "SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def stream_json(spark: SparkSession, sf: str) -> DataFrame:
    """Events exported as JSON files, read back as a folder stream with a fixed schema."""
    landing = scratch_path(spark, "landing")
    table(spark, sf, "events").select("event_id", "user_id", "event_type", "props").write.json(landing)
    stream = feeds.stream_json(spark, landing, "event_id long, user_id long, event_type string, props string")
    parsed = stream.withColumn("k", F.from_json("props", "k long")["k"])
    out, checkpoint = feeds.scratch_paths(spark, "stream-json")
    feeds.append_stream(parsed.select("event_id", "user_id", "event_type", "k"), out, checkpoint)
    return spark.read.schema("event_id long, user_id long, event_type string, k long").parquet(out)


@query(
    "publish_report",
    """SELECT 'order_' || o_orderkey || '.json' AS file_name,
              CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status,
              CASE WHEN o_orderstatus = 'P' THEN 'empty body' END AS error_message,
              CAST(1 AS BIGINT) AS attempts
       FROM orders""",
)
def publish_report(spark: SparkSession, sf: str) -> DataFrame:
    """The sender is a local function, so it reaches executors that do not have this package."""

    def send(key: str, body: str) -> None:
        """A stand-in for a message producer: refuses empty bodies."""
        if not body:
            raise ValueError("empty body")

    out = table(spark, sf, "orders").select(
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("file_name"),
        F.when(F.col("o_orderstatus") != "P", F.to_json(F.struct("o_orderkey", "o_totalprice")))
        .otherwise(F.lit(""))
        .alias("body"),
    )
    return sinks.publish(out, send, "file_name", "body").withColumn("attempts", F.col("attempts").cast("long"))


@query(
    "publish_window",
    """SELECT 'customer_' || o_custkey AS file_name, CASE WHEN o_orderkey % 13 = 0 THEN 'failed' ELSE 'success' END AS status,
              CASE WHEN o_orderkey % 13 = 0 THEN 'not deliverable' END AS error_message,
              CASE WHEN o_orderkey % 13 = 0 THEN 3 WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END::BIGINT AS attempts
       FROM orders""",
)
def publish_window(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as messages by customer, through a producer that refuses some once and some for good."""

    def connect():
        class Producer:
            """A stand-in for a broker client: takes messages, and settles them a poll later."""

            def __init__(self):
                self.waiting, self.seen = [], set()

            def send(self, key, body, done):
                self.waiting.append((body, done))

            def poll(self, seconds):
                for body, done in self.waiting[:64]:
                    number = int(body)
                    first = body not in self.seen
                    self.seen.add(body)
                    done("not deliverable" if number % 13 == 0 else "try again" if number % 7 == 0 and first else None)
                del self.waiting[:64]

        return Producer()

    out = table(spark, sf, "orders").select(
        F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("file_name"), F.col("o_orderkey").cast("string").alias("body"), "o_orderkey"
    )
    report = sinks.publish_window(out, connect, "file_name", "body", ["o_orderkey"], window=256, attempts=3, delay=0.001)
    return report.withColumn("attempts", F.col("attempts").cast("long"))


@query(
    "stream_rescue",
    """SELECT event_id, event_type, CASE WHEN event_id % 5 = 0 THEN '{"extra":"x' || event_id || '"}' END AS unknown, NULL AS reason FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 3
       UNION ALL SELECT NULL, NULL, NULL, CASE WHEN event_id % 7 = 0 THEN 'no JSON object' ELSE 'a field has another type' END FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 3""",
)
def stream_rescue(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON lines, some cut short, some with a text for a number, some with a field more; in two landings."""
    landing = scratch_path(spark, "rescue-landing")
    out, checkpoint = feeds.scratch_paths(spark, "rescue")
    number = F.when(F.col("event_id") % 11 == 3, F.lit("many")).otherwise(F.col("event_id").cast("string"))
    quoted = F.when(F.col("event_id") % 11 == 3, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    more = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit(',"extra":"x'), F.col("event_id").cast("string"), F.lit('"'))).otherwise("")
    line = F.concat(F.lit('{"event_id":'), quoted, F.lit(',"event_type":"'), "event_type", F.lit('"'), more, F.when(F.col("event_id") % 7 != 0, "}").otherwise(""))
    events = table(spark, sf, "events").select("event_id", line.alias("value"))
    for half in range(2):
        events.filter(F.col("event_id") % 2 == half).select("value").write.mode("append").text(landing)
        stream = feeds.rescued(feeds.stream_lines(spark, landing), "value", "event_id long, event_type string")
        feeds.split_bad(stream, f"{out}/good", f"{out}/bad", checkpoint)
    good = spark.read.schema("source_file string, event_id long, event_type string, _unknown string").parquet(f"{out}/good")
    bad = spark.read.schema("source_file string, _bad string, _reason string").parquet(f"{out}/bad")
    nothing = F.lit(None)
    return good.select("event_id", "event_type", F.col("_unknown").alias("unknown"), nothing.cast("string").alias("reason")).unionByName(
        bad.select(nothing.cast("long").alias("event_id"), nothing.cast("string").alias("event_type"), nothing.cast("string").alias("unknown"), F.col("_reason").alias("reason"))
    )


@query(
    "document_sink",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""",
)
def document_sink(spark: SparkSession, sf: str) -> DataFrame:
    """JSON documents written to one folder per status and read back."""
    path = scratch_path(spark, "documents")
    docs = table(spark, sf, "orders").select(
        "o_orderstatus", F.to_json(F.struct("o_orderkey", "o_totalprice")).alias("content")
    )
    sinks.write_documents(docs, path, "o_orderstatus", "content")
    back = spark.read.schema("value string, o_orderstatus string").text(path)
    parsed = F.from_json("value", "o_orderkey long, o_totalprice double")
    return back.select(parsed["o_orderkey"].alias("o_orderkey"), "o_orderstatus", parsed["o_totalprice"].alias("o_totalprice"))


@query(
    "append_merge",
    """SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
       UNION ALL
       SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders""",
)
def append_merge(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "appended")
    orders = table(spark, sf, "orders")
    sinks.append(orders.select("o_orderkey", "o_orderstatus"), path)
    sinks.append(orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return sinks.read_appended(spark, path).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "replace_partition",
    """SELECT o_orderkey, o_orderstatus,
              CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice
       FROM orders""",
)
def replace_partition(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "partitions")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.replace_partition(orders, path, "o_orderstatus")
    closed = orders.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.lit(0.0))
    for _ in range(2):
        sinks.replace_partition(closed, path, "o_orderstatus")
    return spark.read.schema(orders.schema).parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "clone_rows",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
       UNION ALL
       SELECT o_orderkey, -1, 'X' FROM orders WHERE o_custkey = 1""",
)
def clone_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return sinks.clone_rows(orders, "o_custkey", 1, -1, {"o_orderstatus": F.lit("X")})


@query("drop_clones", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (1, 2, 3)")
def drop_clones(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.drop_clones(table(spark, sf, "orders"), "o_custkey", [1, 2, 3]).select("o_orderkey", "o_custkey")


@query(
    "merge_states",
    """SELECT CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'final' ELSE 'pending' END AS state,
              o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice
       FROM orders WHERE o_orderstatus IN ('O', 'F', 'P')""",
)
def merge_states(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return sinks.merge_states(
        {
            "open": orders.filter("o_orderstatus = 'O'").select("o_orderkey"),
            "final": orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"),
            "pending": orders.filter("o_orderstatus = 'P'").select("o_orderkey"),
        }
    ).select("state", "o_orderkey", "o_totalprice")
