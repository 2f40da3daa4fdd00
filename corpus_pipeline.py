"""A corpus from raw documents to tokens: five stages, each written and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given. All but the last return the columns
of ``documents``; ``n_chars`` follows the text where a stage changes it. Nulls, empty texts, repeated rows, empty
tables and further columns are handled as the operators' docstrings say; further columns pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import bpe, decontaminate, quality, secrets, simhash
from docketry.llm.common import col
from docketry.sources.files import table
from docketry.sources.scratch import mark, release, scratch_path


def _with_text(df: DataFrame, columns: list[str], text: Column, changed: Column) -> DataFrame:
    """``columns`` of ``df`` with a new text, and its length where it has changed."""
    length = F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    new = {"text": text.alias("text"), "n_chars": length.alias("n_chars")}
    return df.select(*[new.get(c, col(c)) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines are taken out of the others."""
    made = quality.judged(docs, "source", "text", name="__quality").filter("__quality.kept")
    removed = F.col("__quality.removed")
    return _with_text(made, docs.columns, quality.without_lines(F.col("text"), removed), F.size(removed) > 0)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    return simhash.keep_one(docs, "doc_id", "text", words=4, radius=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words inside benchmark windows go."""
    made = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), name="__contamination")
    hit, words = F.col("__contamination.n_hit"), F.col("__contamination.n_words")
    return made.filter(~((hit > 0) & (20 * hit >= words))).select(*[col(c) for c in docs.columns])


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark of its kind."""
    found = secrets.scan(docs, "doc_id", "text", name="__secrets", redacted=True)
    return _with_text(found, docs.columns, F.coalesce("__secrets.text", "text"), F.col("__secrets.text").isNotNull())


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document, with the digests of the ids and of what they decode to."""
    carried = [c for c in docs.columns if c not in ("text", "n_chars")]
    made = bpe.encode(docs, "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, name="__tokens", carry=carried, digests=True)
    return made.select(*[col(c) for c in carried], "__tokens.n_tokens", "__tokens.ids_sha256", "__tokens.decoded_sha256", "__tokens.ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("byte_level_bpe", byte_level_bpe),
]

#: No SQL expresses the rank merges of the last stage; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has written goes once the next one's table is there."""
    docs, start = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage-{name}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        release(spark, since=start, keep=[path])
    return docs
