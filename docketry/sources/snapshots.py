"""Newest-snapshot ingest of stamped parquet extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Files are named <table>_<digits>.parquet.
STAMP_PATTERN = r"_(\d+)\.parquet$"


def list_snapshots(spark: SparkSession, base: str, pattern: str = STAMP_PATTERN) -> list[tuple[str, str]]:
    """(path, stamp) of every stamped parquet file or folder at any depth under ``base``.

    Only names are listed; no file is opened. The list holds one entry per extract, not per row.
    """
    import re

    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stamp = re.compile(pattern)
    found, pending = [], [root]
    while pending:
        for status in fs.listStatus(pending.pop()):
            path = status.getPath()
            match = stamp.search(path.getName())
            if match:
                found.append((path.toString(), match.group(1)))
            elif status.isDirectory() and not path.getName().startswith(("_", ".")):
                pending.append(path)
    return found


def newest(snapshots: list[tuple[str, str]], numeric: bool = True) -> tuple[str, str]:
    """The newest entry. String order (``numeric=False``) ranks "9" above "10"."""
    return max(snapshots, key=lambda s: ((int(s[1]) if numeric else s[1]), s[0]))


def read_latest(
    spark: SparkSession,
    base: str,
    process: str,
    pattern: str = STAMP_PATTERN,
    numeric: bool = True,
    view: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """The newest snapshot under ``base`` with audit columns.

    Only the newest file is read, so the scan does not grow with the number of old snapshots.
    ``as_of`` fixes the two clock columns so that runs can be compared.
    """
    snapshots = list_snapshots(spark, base, pattern)
    if not snapshots:
        raise FileNotFoundError(f"no stamped parquet under {base}")
    path, stamp = newest(snapshots, numeric)
    clock = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    df = spark.read.parquet(path).select(
        "*",
        clock.alias("audit_created"),
        clock.alias("audit_modified"),
        F.lit(path.rsplit("/", 1)[-1]).alias("audit_source"),
        F.lit(stamp).alias("audit_stamp"),
        F.lit(process).alias("audit_process"),
    )
    if view:
        df.createOrReplaceTempView(view)
    return df
