"""Writers that stay correct when a task is run again."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial, reduce
from itertools import islice

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.sources.scratch import materialise

REPORT_SCHEMA = "file_name string, status string, error_message string, attempts int"


def publish(
    df: DataFrame,
    send: Callable[[str, str], None],
    key: str,
    body: str,
    attempts: int = 3,
    retry_on: tuple[type[Exception], ...] = (BufferError,),
) -> DataFrame:
    """Send every row from its own partition and return one report row per record.

    ``send(key, body)`` must be idempotent by key: Spark may run a task twice. A full buffer is tried
    again up to ``attempts`` times; any other error is recorded, never swallowed. The report is written here,
    so that reading it again sends nothing.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, text in zip(batch["_key"], batch["_body"]):
                status, error, used = "failed", None, 0
                while used < attempts:
                    used += 1
                    try:
                        send(name, text)
                        status, error = "success", None
                        break
                    except retry_on as exc:
                        error = str(exc)
                    except Exception as exc:
                        error = str(exc)
                        break
                rows.append((name, status, error, used))
            yield pd.DataFrame(rows, columns=["file_name", "status", "error_message", "attempts"])

    picked = df.select(F.col(key).cast("string").alias("_key"), F.col(body).cast("string").alias("_body"))
    return materialise(picked.mapInPandas(run, REPORT_SCHEMA), "report")


class Delivery:
    """Messages of one task on their way: at most ``window`` of them held, sent in order per key, each until it is settled.

    ``producer.send(key, body, done)`` takes a message and calls ``done(error)`` later, from ``producer.poll(seconds)``, with
    None when it was delivered; it raises ``BufferError`` when its buffer is full. A refused or undelivered message is tried
    again after a pause that doubles each time; the next message of its key waits for it. ``clock`` and ``pause`` stand in
    for time in tests.
    """

    def __init__(self, producer, window: int, attempts: int, delay: float, clock=time.monotonic, pause=time.sleep):
        self.producer, self.window, self.attempts, self.delay = producer, window, attempts, delay
        self.clock, self.pause = clock, pause
        self.queues: dict[str | None, deque] = {}
        self.held, self.most, self.settled = 0, 0, []

    def run(self, messages: Iterable[tuple[str | None, str | None]]) -> Iterator[tuple]:
        """A report row per message: key, status, error, attempts."""
        source, more = iter(messages), True
        while more or self.held:
            while more and self.held < self.window:
                message = next(source, None)
                more = message is not None
                if more:
                    # Not before, of when it may be tried, whether it is out, attempts, last error.
                    self.queues.setdefault(message[0], deque()).append({"key": message[0], "body": message[1], "at": 0.0, "out": False, "used": 0, "error": None})
                    self.held += 1
                    self.most = max(self.most, self.held)
            self._send()
            self.producer.poll(self.delay)
            yield from self.settled
            self.settled = []

    def _send(self) -> None:
        """Offer the first message of every key that is not out and whose pause is over; stop at a full buffer."""
        now, soonest, busy = self.clock(), None, False
        for key in list(self.queues):
            first = self.queues[key][0]
            if first["out"]:
                busy = True
            elif first["at"] > now:
                soonest = first["at"] if soonest is None else min(soonest, first["at"])
            else:
                first["out"], first["used"] = True, first["used"] + 1
                try:
                    self.producer.send(first["key"], first["body"], partial(self._done, first))
                    busy = True
                except BufferError as full:
                    self._again(first, str(full))
                    return
                except Exception as refused:
                    first["used"] = self.attempts
                    self._done(first, refused)
        if soonest is not None and not busy:
            # Nothing is out, so nothing will come back before the first pause is over.
            self.pause(max(0.0, soonest - now))

    def _again(self, message: dict, error: str) -> None:
        message.update(out=False, error=error)
        if message["used"] >= self.attempts:
            self._settle(message, "failed")
        else:
            message["at"] = self.clock() + self.delay * 2 ** (message["used"] - 1)

    def _done(self, message: dict, error) -> None:
        if error is None:
            message["error"] = None
            self._settle(message, "success")
        else:
            self._again(message, str(error))

    def _settle(self, message: dict, status: str) -> None:
        queue = self.queues[message["key"]]
        queue.popleft()
        if not queue:
            del self.queues[message["key"]]
        self.held -= 1
        self.settled.append((message["key"], status, message["error"], message["used"]))


def publish_window(
    df: DataFrame, connect: Callable[[], object], key: str, body: str, order: Sequence[str] = (), window: int = 1000, attempts: int = 5, delay: float = 0.05
) -> DataFrame:
    """Send every row through a producer with delivery callbacks and return one report row per record.

    ``connect()`` makes the producer of a task (see ``Delivery``). Rows of a key go to one task and out in ``order``, one after
    the other; different keys are in flight together, ``window`` at most, which bounds the memory of a task. Sending must be
    idempotent by key and body, as Spark may run a task twice. The report is written here, so reading it sends nothing.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((k, b) for batch in batches for k, b in zip(batch["_key"], batch["_body"]))
        columns = ["file_name", "status", "error_message", "attempts"]
        reported = Delivery(connect(), window, attempts, delay).run(rows)
        while part := list(islice(reported, 10_000)):
            yield pd.DataFrame(part, columns=columns)

    sent = df.select(F.col(key).cast("string").alias("_key"), F.col(body).cast("string").alias("_body"), *[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)])
    dealt = sent.repartition("_key").sortWithinPartitions("_key", *[f"_order_{i}" for i in range(len(order))])
    return materialise(dealt.select("_key", "_body").mapInPandas(run, REPORT_SCHEMA), "report")


def write_documents(df: DataFrame, path: str, folder: str, body: str) -> None:
    """One text line per document, in one folder per ``folder`` value, through Spark's committer.

    A retried task replaces its own output, which an upload from inside a UDF cannot promise.
    """
    (
        df.select(F.col(body).alias("value"), F.col(folder))
        .write.mode("overwrite")
        .partitionBy(folder)
        .text(path)
    )


def upload_documents(df: DataFrame, put: Callable[[str, str], None], path_col: str, body_col: str) -> DataFrame:
    """Per-row upload with a status text, as a written report."""
    report = publish(df, put, path_col, body_col)
    return report.select(
        F.col("file_name").alias(path_col),
        F.when(F.col("status") == "success", F.lit("success"))
        .otherwise(F.concat(F.lit("failure: "), F.coalesce("error_message", F.lit("unknown"))))
        .alias("transfer_status"),
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """Read an appended table whose parts may have different columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read the table at ``path``; write an empty one with ``schema`` first if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        spark.createDataFrame([], schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path) if isinstance(schema, str) else spark.read.parquet(path)


def replace_partition(df: DataFrame, path: str, column: str) -> None:
    """Replace only the partitions present in ``df``; a second run leaves the same table.

    Rebalancing gives few files for small partitions and splits a large one over several tasks.
    """
    (
        df.hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def clone_rows(df: DataFrame, key: str, old, new, overrides: dict[str, Column] | None = None) -> DataFrame:
    """``df`` plus copies of the rows of key ``old`` under key ``new`` with some columns replaced."""
    copies = df.filter(F.col(key) == F.lit(old)).withColumn(key, F.lit(new).cast(df.schema[key].dataType))
    for name, value in (overrides or {}).items():
        copies = copies.withColumn(name, value.cast(df.schema[name].dataType))
    return df.unionByName(copies)


def drop_clones(df: DataFrame, key: str, keys: list) -> DataFrame:
    """Remove cloned rows; rows with a NULL key stay."""
    return df.filter(F.col(key).isNull() | ~F.col(key).isin(keys))


def merge_states(outputs: dict[str, DataFrame], column: str = "state") -> DataFrame:
    """One table from per-state outputs, each tagged with its state."""
    tagged = [df.withColumn(column, F.lit(name)) for name, df in outputs.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
