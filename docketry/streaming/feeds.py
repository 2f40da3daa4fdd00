"""Streaming sources and idempotent sinks.

Every query runs with ``availableNow``: it takes what is there, commits and stops, so nothing polls for
an expected count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docketry.sources.files import table
from docketry.sources.scratch import scratch_path


def stream_json(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """JSON files landing in a folder, fixed schema, with the file they came from."""
    return (
        spark.readStream.format("json")
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("*", F.col("_metadata.file_name").alias("source_file"))
    )


def stream_table(spark: SparkSession, base: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """A parquet table, one file or a folder of them, as a stream of its files."""
    schema = table(spark, base, name).schema
    # As a pattern the path may be a single file, which a streaming source otherwise refuses.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{base}/{{{name}.parquet}}")


def kafka_json(raw: DataFrame, schema) -> DataFrame:
    """Parse the JSON value of a message stream; takes any streaming frame with a ``value`` column."""
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("_m")).select("_m.*")


def rescued(raw: DataFrame, value: str, schema: str) -> DataFrame:
    """Parse the JSON objects in ``value`` and keep what does not fit; all other columns stay.

    The fields of ``schema`` come with three columns: ``_unknown``, the fields that are not in it, as JSON; ``_bad``, the text
    as it came where it is no JSON object or a field has another type; and ``_reason``. A bad row has no fields, so nothing
    half-read goes on. A NULL value is bad too.
    """
    text = F.col(value).cast("string")
    wanted = T.StructType.fromDDL(schema)
    read = T.StructType([*wanted.fields, T.StructField("_corrupt", T.StringType())])
    named = F.array(*[F.lit(f.name) for f in wanted.fields])
    kept = [c for c in raw.columns if c != value]
    parsed = raw.select(
        *kept, text.alias("_text"), F.from_json(text, read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("_m"), F.json_object_keys(text).alias("_keys")
    )
    reason = F.when(F.col("_text").isNull(), "no value").when(F.col("_keys").isNull(), "no JSON object").when(F.col("_m._corrupt").isNotNull(), "a field has another type")
    every = F.from_json("_text", "map<string,string>")
    unknown = F.when(F.size(F.array_except("_keys", named)) > 0, F.to_json(F.map_filter(every, lambda k, _: ~F.array_contains(named, k))))
    marked = parsed.withColumn("_reason", reason)
    good = F.col("_reason").isNull()
    return marked.select(
        *kept,
        *[F.when(good, F.col(f"_m.{f.name}")).alias(f.name) for f in wanted.fields],
        F.when(good, unknown).alias("_unknown"),
        F.when(~good, F.coalesce("_text", F.lit(""))).alias("_bad"),
        "_reason",
    )


def stream_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The lines of the files landing in a folder as ``value``, with the file they came from; empty lines are not messages."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).text(path)
    return lines.select("value", F.col("_metadata.file_name").alias("source_file")).filter(F.trim("value") != "")


def split_bad(stream: DataFrame, good: str, bad: str, checkpoint: str) -> None:
    """Append the rows of ``rescued`` to two tables: what was read, and what was not, with its text and the reason.

    Each sink has its own checkpoint, so one that falls behind or is run again neither loses nor repeats rows of the other.
    """
    append_stream(stream.filter("_reason IS NULL").drop("_bad", "_reason"), good, f"{checkpoint}/good")
    others = [c for c in ("source_file", "topic", "partition", "offset", "timestamp") if c in stream.columns]
    append_stream(stream.filter("_reason IS NOT NULL").select(*others, "_bad", "_reason"), bad, f"{checkpoint}/bad")


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append to a parquet table; the sink's log drops the output of a repeated batch."""
    run_to_end(
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def route_stream(stream: DataFrame, column: str, path: str, checkpoint: str) -> None:
    """Split a stream into one folder per value of ``column`` with one scan of the source."""
    run_to_end(
        stream.writeStream.format("parquet")
        .partitionBy(column)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def dual_sink(stream: DataFrame, current: str, history: str, checkpoint: str) -> None:
    """Write each micro-batch to two tables. A repeated batch overwrites its own folder in both."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{current}/batch_id={batch_id}")
            batch.write.mode("overwrite").parquet(f"{history}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    run_to_end(
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def scratch_paths(spark: SparkSession, tag: str) -> tuple[str, str]:
    """(output, checkpoint) folders for one run."""
    base = scratch_path(spark, tag)
    return f"{base}/out", f"{base}/checkpoint"
