"""Row-level operators: decode, classify, filter, rename."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP = object()


def literal_map(mapping: Mapping) -> Column:
    """A constant map column; for fixed rule tables only."""
    cells = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*cells)


def map_lookup(column: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """The mapped value, ``default`` (or NULL) when the key is not in the map."""
    found = F.element_at(literal_map(mapping), column) if mapping else F.lit(None)
    return found if default is None else F.coalesce(found, default)


def decode_codes(df: DataFrame, column: str, mapping: Mapping, default=KEEP, name: str | None = None) -> DataFrame:
    """Codes to labels. Unknown codes keep their value, become ``default``, or NULL for ``None``."""
    col = F.col(column)
    fallback = col.cast("string") if default is KEEP else F.lit(default)
    return df.withColumn(name or column, map_lookup(col, mapping, fallback))


def first_match(rules: Sequence[tuple[str, Column]], default: str | None = None) -> Column:
    """The label of the first rule that holds; a NULL condition does not hold."""
    if not rules:
        return F.lit(default)
    label, cond = rules[0]
    cascade = F.when(cond, F.lit(label))
    for label, cond in rules[1:]:
        cascade = cascade.when(cond, F.lit(label))
    return cascade.otherwise(F.lit(default))


def classify(df: DataFrame, name: str, rules: Sequence[tuple[str, Column]], default: str | None = None) -> DataFrame:
    return df.withColumn(name, first_match(rules, default))


def classify_many(df: DataFrame, cascades: Mapping[str, tuple[Sequence[tuple[str, Column]], str | None]]) -> DataFrame:
    """Several independent labels over the same row in one projection."""
    return df.select("*", *[first_match(rules, default).alias(name) for name, (rules, default) in cascades.items()])


def match_any(column: Column, patterns: Sequence[str]) -> Column:
    """True when any LIKE pattern matches; NULL text matches nothing."""
    hit = reduce(lambda a, b: a | b, [column.like(p) for p in patterns])
    return F.coalesce(hit, F.lit(False))


def project_when(condition: Column, columns: Sequence[str]) -> list[Column]:
    """Each column where ``condition`` holds, else NULL."""
    return [F.when(condition, F.col(c)).alias(c) for c in columns]


def null_if_in(df: DataFrame, columns: Sequence[str], values: Sequence) -> DataFrame:
    """Sentinel values become NULL."""
    return df.withColumns({c: F.when(~F.col(c).isin(*values), F.col(c)) for c in columns})


def not_in(column: Column, values: Sequence, keep_null: bool) -> Column:
    """NOT IN that keeps (tolerant) or drops (strict) rows whose value is NULL."""
    outside = ~column.isin(*values)
    return column.isNull() | outside if keep_null else F.coalesce(outside, F.lit(False))


def new_columns(base: DataFrame, other: DataFrame) -> list[str]:
    """Columns of ``other`` that ``base`` lacks, in the order of ``other``."""
    have = set(base.columns)
    return [c for c in other.columns if c not in have]


def rename_prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def apart(column: str) -> Column:
    """An empty text that keeps a projection of many expressions out of the generated method of its neighbours.

    Whole-stage code puts joins and projections that follow each other into one method, and a method of over 8,000 bytes is never
    compiled by the JVM. A function over elements has no such code, so a projection with one is generated alone, in small methods;
    nothing but this text is evaluated by the interpreter.
    """
    return F.element_at(F.transform(F.array(column), lambda _: F.lit("")), 1)
