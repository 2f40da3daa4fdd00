"""Streams, reconciliation and traces on the events table.

``signup`` stands for created, ``view`` for published, ``click`` for acknowledged, ``purchase`` for uploaded
and ``error`` for failed; the record key is user and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators import aggregates, ranking, reconcile
from docketry.plans.registry import query
from docketry.sources.files import table
from docketry.streaming import feeds

STAGES = ["signup", "view", "click", "purchase", "error"]
_KEYED = "(SELECT *, user_id || '/' || strftime(ts, '%Y-%m-%d') AS record_key FROM events)"


def keyed(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf, "events").withColumn("record_key", key)


def _of(df: DataFrame, kind: str) -> DataFrame:
    return df.filter(F.col("event_type") == kind)


@query(
    "stream_route",
    """SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1""",
)
def stream_route(spark: SparkSession, sf: str) -> DataFrame:
    """One source scan, one folder per kind of event."""
    out, checkpoint = feeds.scratch_paths(spark, "route")
    stream = feeds.stream_table(spark, sf, "events").select("event_id", "value", "event_type")
    feeds.route_stream(stream, "event_type", out, checkpoint)
    routed = spark.read.schema("event_id long, value double, event_type string").parquet(out)
    return routed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), aggregates.total("value").cast("double").alias("total")
    )


@query("stream_append", "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'")
def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    """The second run finds nothing new: the checkpoint remembers what was taken."""
    out, checkpoint = feeds.scratch_paths(spark, "acks")
    for _ in range(2):
        stream = feeds.stream_table(spark, sf, "events").filter("event_type = 'click'")
        feeds.append_stream(stream.select("event_id", "user_id", "event_type"), out, checkpoint)
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(out)


@query(
    "stream_dual_sink",
    """SELECT sink, event_type, count(*) AS n FROM events, (VALUES ('current'), ('history')) AS s(sink) GROUP BY 1, 2""",
)
def stream_dual_sink(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = feeds.scratch_paths(spark, "dual")
    stream = feeds.stream_table(spark, sf, "events").select("event_id", "event_type")
    feeds.dual_sink(stream, f"{out}/current", f"{out}/history", checkpoint)
    both = [
        spark.read.schema("event_id long, event_type string, batch_id long").parquet(f"{out}/{sink}").withColumn("sink", F.lit(sink))
        for sink in ("current", "history")
    ]
    return both[0].unionByName(both[1]).groupBy("sink", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "expected_counts",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT record_key) AS expected_records,
               2 * count(DISTINCT record_key) AS expected_files FROM {_KEYED} WHERE event_type = 'view' GROUP BY 1""",
)
def expected_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What a later stage must deliver, from the audit of an earlier one: two files per record."""
    published = _of(keyed(spark, sf), "view").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "record_key").distinct()
    return published.groupBy("day").agg(
        F.count(F.lit(1)).alias("expected_records"), (F.count(F.lit(1)) * 2).alias("expected_files")
    )


_HAS = ", ".join(f"coalesce(bool_or(event_type = '{s}'), false) AS has_{s}" for s in STAGES)
_FIRST = "CASE " + " ".join(f"WHEN NOT has_{s} THEN '{s}'" for s in STAGES) + " END"


@query(
    "reconcile_stages",
    f"SELECT *, {_FIRST} AS first_missing FROM (SELECT record_key, {_HAS} FROM {_KEYED} GROUP BY 1)",
)
def reconcile_stages(spark: SparkSession, sf: str) -> DataFrame:
    """The stages are rows of one table here, so one scan serves all of them."""
    return reconcile.reconcile_long(keyed(spark, sf), "record_key", F.col("event_type"), STAGES)


@query(
    "missing_events",
    f"""SELECT DISTINCT record_key FROM {_KEYED} WHERE event_type = 'view'
          AND record_key NOT IN (SELECT record_key FROM {_KEYED} WHERE event_type = 'click')""",
)
def missing_events(spark: SparkSession, sf: str) -> DataFrame:
    events = keyed(spark, sf)
    return reconcile.missing_events(_of(events, "view"), _of(events, "click"), "record_key")


@query(
    "replay_report",
    f"""WITH missing AS (SELECT DISTINCT record_key FROM {_KEYED} WHERE event_type = 'view'
                           AND record_key NOT IN (SELECT record_key FROM {_KEYED} WHERE event_type = 'click')),
             log AS (SELECT record_key, event_id, props FROM {_KEYED} WHERE event_type = 'signup'
                     QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY ts DESC, event_id DESC) = 1)
        SELECT record_key, event_id, props, CASE WHEN event_id IS NULL THEN 'failed' ELSE 'resent' END AS replay_status
        FROM missing LEFT JOIN log USING (record_key)""",
)
def replay_report(spark: SparkSession, sf: str) -> DataFrame:
    """The last logged payload for each missing key; the log here is the signup events."""
    events = keyed(spark, sf)
    missing = reconcile.missing_events(_of(events, "view"), _of(events, "click"), "record_key")
    log = ranking.latest(
        _of(events, "signup").select("record_key", "event_id", "props", "ts"), ["record_key"], ["ts", "event_id"]
    )
    return reconcile.replay_report(missing, log, "record_key", ["event_id", "props"])


def _last_sql(kind: str) -> str:
    return f"""(SELECT record_key, CASE WHEN value >= 50 THEN 'success' ELSE 'failure' END AS status FROM {_KEYED}
                WHERE event_type = '{kind}' QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY ts DESC, event_id DESC) = 1)"""


@query(
    "trace_files",
    f"""SELECT v.record_key, c.status AS ack_status, p.status AS upload_status
        FROM (SELECT DISTINCT record_key FROM {_KEYED} WHERE event_type = 'view') v
        LEFT JOIN {_last_sql('click')} c ON c.record_key = v.record_key
        LEFT JOIN {_last_sql('purchase')} p ON p.record_key = v.record_key""",
)
def trace_files(spark: SparkSession, sf: str) -> DataFrame:
    """The last acknowledgement and upload of every published record, from one pass over the events."""
    status = F.when(F.col("value") >= 50, "success").otherwise("failure")
    events = keyed(spark, sf).select("record_key", "event_type", "ts", "event_id", status.alias("status"))
    kinds = {"view": "view", "ack": "click", "upload": "purchase"}
    last = ranking.latest_multi(
        events, ["record_key"], ["ts", "event_id"], {n: F.col("event_type") == k for n, k in kinds.items()}, ["event_id", "status"]
    )
    return last.filter("view_event_id IS NOT NULL").select("record_key", "ack_status", "upload_status")


@query(
    "audit_totals",
    f"""SELECT event_type AS stage, CAST(count(*) AS BIGINT) AS row_count, count(DISTINCT record_key) AS key_count
        FROM {_KEYED} GROUP BY 1""",
)
def audit_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.totals_long(keyed(spark, sf), "event_type", "record_key")
