"""What the operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.sources.scratch import scratch_path

# Rows turned into Python objects at a time, whatever the size of an Arrow batch.
SLICE = 256

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


# Bytes of rows that go to Python at a time, unless the session says otherwise.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def small_batches(df: DataFrame) -> None:
    """Keep Arrow batches small in a session that has not set their size, as texts may be long."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH_BYTES)


def annotate(
    df: DataFrame,
    inputs: list[Column | str],
    name: str,
    result: T.StructType,
    start: Callable[[], Callable[..., pa.StructArray]],
    carry: list[str] | None = None,
) -> DataFrame:
    """Append one struct column computed from ``inputs`` by a Python function over Arrow slices.

    ``start`` runs once per task and returns the function, which gets one Python list per input. An input given
    as a name is that text column as UTF-8 bytes; where it is also kept, it goes to Python only once.
    ``carry`` names the columns to keep (all by default); a column already called ``name`` gives way,
    so no other column of the input can clash with what is added. Nothing is shuffled.
    """
    small_batches(df)
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() != name.lower()]
    n, m = len(kept), len(inputs)
    own = [c for c in inputs if not (isinstance(c, str) and c in kept)]
    place = [kept.index(c) if isinstance(c, str) and c in kept else n + next(i for i, o in enumerate(own) if o is c) for c in inputs]
    raw = [isinstance(c, str) for c in inputs]
    fields = df.select(*[col(c) for c in kept]).schema.fields
    schema = T.StructType([*fields, T.StructField(name, result)])
    # Plain names on the way in, as a column may be called anything.
    source = df.select(*[col(c).alias(f"__kept_{i}") for i, c in enumerate(kept)], *[(col(c) if isinstance(c, str) else c).alias(f"__input_{i}") for i, c in enumerate(own)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = score(*[(part.column(place[i]).cast(pa.binary()) if raw[i] else part.column(place[i])).to_pylist() for i in range(m)])
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(n)], made], names=[*kept, name])
        # Workers live on for other tasks; what their batches took goes back.
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, schema)


def struct_array(**columns: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df``, written to scratch, and the path, for ``release`` to keep."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def shared_uri(spark, path: str) -> str:
    """A scratch path as a URI of the session's own file system, for tasks that open files there."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(found).toString()
    return re.sub(r"^file:/+", "file:///", whole)


# The bits of a row number that count inside the task that has written the row; the others name the task.
CHUNK = 33


def write_marks(marks: DataFrame, tag: str) -> tuple[str, str]:
    """Write ``marks`` of rows (``row``, a number from ``monotonically_increasing_id``) by the task that has written the row.

    Returns the path, for ``release`` to keep, and the folder's URI for ``Marks``. Tasks that read the rows again look up what
    is marked among them, so the rows, which may be long, need no shuffle to meet their marks.
    """
    spark = marks.sparkSession
    path = scratch_path(spark, tag)
    marks.withColumn("chunk", F.shiftrightunsigned("row", CHUNK)).repartition("chunk").sortWithinPartitions("chunk", "row").write.partitionBy("chunk").parquet(path)
    return path, shared_uri(spark, path)


class Marks:
    """Marks of rows, read chunk by chunk. Rows of a chunk follow each other, so a task holds the marks of one chunk."""

    def __init__(self, uri: str, columns: tuple[str, ...] = ()):
        self.system, self.base = fs.FileSystem.from_uri(uri)
        self.names, self.chunk = ["row", *columns], None

    def open(self, chunk: int) -> bool:
        """Make ``rows`` (sorted) and ``columns`` those of a chunk; False if they were already."""
        if chunk == self.chunk:
            return False
        there = self.system.get_file_info(fs.FileSelector(f"{self.base}/chunk={chunk}", allow_not_found=True))
        tables = [parquet.read_table(f.path, filesystem=self.system, partitioning=None, columns=self.names) for f in there if f.base_name.startswith("part-")]
        parts = [[t.column(c).to_numpy() for t in tables] for c in self.names]
        rows, *others = (np.concatenate(p) if p else np.array([], np.int64) for p in parts)
        order = np.argsort(rows, kind="stable")
        self.chunk, self.rows, self.columns = chunk, rows[order], [c[order] for c in others]
        return True

    def has(self, rows: np.ndarray) -> np.ndarray:
        """Which of some rows are marked."""
        out = np.zeros(len(rows), bool)
        chunks = rows >> CHUNK
        for chunk in np.unique(chunks).tolist():
            self.open(chunk)
            here = chunks == chunk
            out[here] = np.isin(rows[here], self.rows)
        return out


# A key of more rows than one in so many is sent to every task; there are at most so many of those.
HEAVY = 1000


def join_marks(rows: DataFrame, marks: DataFrame, on: list[str], rows_of: str, total: int) -> DataFrame:
    """``rows`` joined (inner) to ``marks``, which has one row per key ``on`` and its number of ``rows`` in ``rows_of``.

    Marks of the at most ``HEAVY`` keys with over one in ``HEAVY`` of the ``total`` rows go to every task, so that rows of
    a hot key stay where they are; all other keys are joined by shuffle, where none owns more than that share.
    """
    heavy = F.col(rows_of) * HEAVY > total
    hot = F.broadcast(marks.filter(heavy))
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(marks.filter(~heavy), on))


def place(key: Column) -> Column:
    """A number from 0 to 1 that depends on ``key`` alone; keys below a share are a sample of that share."""
    return F.shiftrightunsigned(F.xxhash64(key), 11) / F.lit(float(1 << 53))


def share_of(kind: Column, counts: dict, wanted: int) -> Column:
    """For each value of ``kind`` the share that leaves about ``wanted`` of its ``counts`` rows."""
    out = F.lit(0.0)
    for value, n in counts.items():
        out = F.when(kind == F.lit(value), F.lit(min(1.0, wanted / max(1, n)))).otherwise(out)
    return out
