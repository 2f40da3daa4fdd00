"""Table, lookup, document and text readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The given tables with a fixed schema, so that reading one starts no job to look at its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table by name: the parquet copy under ``base``."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{base}/{name}.parquet")


def table_or_catalog(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    """A catalogue table or view when one is registered, else the parquet copy."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    if base is None:
        raise ValueError(f"{name} is not in the catalogue and no folder was given")
    return table(spark, base, name)


def read_lookup(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    multiline: bool = False,
    strip_bom: bool = True,
) -> DataFrame:
    """A header CSV with a fixed schema; ``multiline`` allows quoted cells that hold JSON text."""
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", True)
    )
    df = reader.csv(path)
    if not strip_bom:
        return df
    first = df.columns[0]
    if dict(df.dtypes)[first] == "string":
        df = df.withColumn(first, F.regexp_replace(first, "^﻿", ""))
    return df


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """A header CSV whose types are inferred; for small external lists of unknown layout only."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """A multi-line JSON configuration file."""
    return spark.read.option("multiLine", True).json(path)


def read_documents(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """Whole files as text with their base name."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select(
            F.col("path"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.decode("content", "UTF-8").alias("content_str"),
            F.col("modificationTime").alias("modified_at"),
            F.col("length"),
        )
    )


def read_recent_text(spark: SparkSession, path: str, since) -> DataFrame:
    """Lines of the text files modified at or after ``since`` (a timestamp column or literal)."""
    return (
        spark.read.text(path)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
        .filter(F.col("modified_at") >= since)
    )


def parse_json_value(df: DataFrame, schema, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Parse a JSON text or binary column into top-level columns.

    Works on a batch table and on any streaming source with a ``value`` column.
    """
    parsed = df.withColumn("_parsed", F.from_json(F.col(column).cast("string"), schema))
    return parsed.select(*(keep or []), "_parsed.*")
