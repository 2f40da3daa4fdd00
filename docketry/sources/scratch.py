"""Scratch storage shared by all executors.

A cluster names its shared folder in ``spark.checkpoint.dir``. A local folder is made only for a session
whose executors are all on this machine (tests, laptop); any other session without the setting is refused.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None
_written: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    global _local_dir
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="docketry-")
    return _local_dir


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path that no other call gets."""
    path = f"{scratch_dir(spark)}/docketry/{tag}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def mark() -> int:
    """A point in the order of scratch paths, for ``release``."""
    return len(_written)


def release(spark: SparkSession, since: int = 0, keep: Collection[str] = ()) -> int:
    """Delete the scratch paths handed out after ``since`` but those in ``keep``.

    Call it once no result that reads them is needed. Goes through the file system of the path, so it works on
    the shared folder of a cluster.
    """
    removed = 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    kept = [p for p in _written[since:] if p in keep]
    for name in _written[since:]:
        if name not in keep:
            path = jvm.org.apache.hadoop.fs.Path(name)
            removed += bool(path.getFileSystem(conf).delete(path, True))
    _written[since:] = kept
    return removed


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to scratch and read it back.

    Cuts the lineage with a table that outlives lost executors, and fixes the values of columns that
    depend on the physical layout (``monotonically_increasing_id``) before they are used twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
