"""Named data-quality rules: validation, counts, quarantine, profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Mapping[str, str]


class QualityError(Exception):
    """A rule that must hold does not."""


def passes(rule: str) -> Column:
    """A rule as a condition; NULL counts as failing."""
    return F.coalesce(F.expr(rule), F.lit(False))


def valid_column(rules: Rules) -> Column:
    """All rules hold; without rules every row is valid."""
    return reduce(lambda a, b: a & b, [passes(r) for r in rules.values()], F.lit(True))


def failed_rules(rules: Rules) -> Column:
    """The names of the failing rules, in rule order.

    Names occur once, so taking away the NULLs of the rules that hold loses nothing else; unlike ``array_compact``, which
    interprets all conditions row by row, this stays in generated code.
    """
    if not rules:
        return F.array().cast("array<string>")
    return F.array_except(F.array(*[F.when(~passes(r), F.lit(n)) for n, r in rules.items()]), F.array(F.lit(None).cast("string")))


def validate(df: DataFrame, rules: Rules, name: str = "is_valid") -> DataFrame:
    return df.withColumn(name, valid_column(rules))


def drop_invalid(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(valid_column(rules))


def mark(df: DataFrame, rules: Rules) -> DataFrame:
    """Every row with ``is_valid`` and the names of its failed rules, for a sink partitioned by validity."""
    return df.withColumn("failed_rules", failed_rules(rules)).withColumn("is_valid", F.size("failed_rules") == 0)


def quarantine(df: DataFrame, rules: Rules, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with the names of the failed rules); sizes add up to the input.

    The input is evaluated once, in one write to ``path`` partitioned by validity; each side reads its folder.
    """
    marked = mark(df, rules)
    marked.write.partitionBy("is_valid").parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    return stored.filter("is_valid").select(*df.columns), stored.filter(~F.col("is_valid")).select(*df.columns, "failed_rules")


def quarantine_path(path: Column, valid: Column, valid_folder: str = "/JSON/", invalid_folder: str = "/INVALID_JSON/") -> Column:
    return F.when(valid, path).otherwise(F.replace(path, F.lit(valid_folder), F.lit(invalid_folder)))


def failing(rules: Rules, numbers: Mapping[str, int]) -> Column:
    """The numbers of the failing rules as a text, each with a comma behind it; empty for most rows of good data."""
    return F.concat(F.lit(""), *[F.when(passes(r), F.lit("")).otherwise(F.lit(f"{numbers[n]},")) for n, r in rules.items()])


def numbered(rules: Rules) -> dict[str, int]:
    return {n: i for i, n in enumerate(rules)}


def rule_counts(df: DataFrame, rules: Rules, settled: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Passed and failed rows per rule, in one pass over the data.

    Rows are counted by the rules they fail together: one key and one count for a row, where a count per rule is a buffer of as
    many columns as there are rules, written anew for every row. ``settled`` maps columns that hold the ``failing`` text of rules
    that were looked at before, when their columns were at hand, to the names of these rules.
    """
    numbers, settled = numbered(rules), settled or {}
    done = {n for names in settled.values() for n in names}
    text = F.concat(*settled, failing({n: r for n, r in rules.items() if n not in done}, numbers))
    together = df.select(text.alias("_failing")).groupBy("_failing").agg(F.count(F.lit(1)).alias("_n"))
    # Behind the last comma stands one empty piece, so the empty number counts all rows.
    single = together.select(F.explode(F.split("_failing", ",")).alias("_rule"), "_n").groupBy("_rule").agg(F.sum("_n").alias("_n"))
    found = single.agg(F.map_from_entries(F.collect_list(F.struct("_rule", "_n"))).alias("_n"))

    def count(number: Column) -> Column:
        return F.coalesce(F.col("_n")[number], F.lit(0).cast("long"))

    failed = count(F.col("_number").cast("string"))
    each = found.select("_n", F.posexplode(F.array(*map(F.lit, rules)).cast("array<string>")).alias("_number", "rule"))
    return each.select("rule", (count(F.lit("")) - failed).alias("passed"), failed.alias("failed"))


def expect_or_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """Raise when any row fails any rule; one aggregate instead of a check in every task."""
    counts = {r["rule"]: r["failed"] for r in rule_counts(df, rules).collect()}
    broken = {n: c for n, c in counts.items() if c}
    if broken:
        raise QualityError(f"rules broken: {broken}")
    return df


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    extra = df.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if extra:
        raise QualityError(f"repeated keys {list(keys)}: {[tuple(r)[:-1] for r in extra]}")
    return df


def state_path(state: str, previous: Mapping[str, str | None]) -> list[str]:
    """The state and the states before it, root first."""
    path: list[str] = []
    at: str | None = state
    while at is not None:
        if at in path:
            raise ValueError(f"states form a loop at {at}")
        path.append(at)
        at = previous.get(at)
    return path[::-1]


def inherited_rules(state: str, own: Mapping[str, Rules], previous: Mapping[str, str | None]) -> dict[str, str]:
    """Rules of a state together with those of the states before it; later states override by name."""
    merged: dict[str, str] = {}
    for s in state_path(state, previous):
        merged.update(own.get(s, {}))
    return merged


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL counts per column in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("_total").alias("row_count"), F.col(c).alias("null_count")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def schema_differences(df: DataFrame, required: Mapping[str, str]) -> dict[str, str]:
    """Missing and wrongly typed columns."""
    have = dict(df.dtypes)
    out = {}
    for name, kind in required.items():
        if name not in have:
            out[name] = "missing"
        elif have[name] != kind:
            out[name] = f"{have[name]} instead of {kind}"
    return out


def check_outputs(df: DataFrame, name: str, batch: str, max_batch: int, patterns: Mapping[str, str]) -> DataFrame:
    """Counts of repeated file names, oversized batches and values that break their pattern."""
    repeated = df.groupBy(name).count().filter("count > 1").agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("file_name_unique").alias("check_name"), "failures"
    )
    oversized = df.groupBy(batch).count().filter(F.col("count") > max_batch).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("batch_size").alias("check_name"), "failures"
    )
    shapes = df.agg(*[F.count_if(~F.coalesce(F.col(c).rlike(p), F.lit(False))).alias(c) for c, p in patterns.items()])
    rows = [F.struct(F.lit(f"pattern_{c}").alias("check_name"), F.col(c).alias("failures")) for c in patterns]
    return repeated.unionByName(oversized).unionByName(shapes.select(F.inline(F.array(*rows))))
