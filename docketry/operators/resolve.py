"""Columns on demand: the columns a rule set names, from as few sources as they need.

Rules compare a record with columns that come from many tables, some of them derived from columns of others. Joining
all tables for every rule set reads most of them for nothing. A resolver is told once what each source provides; given the
columns wanted, it takes the sources they need, in the order their own needs ask for, and reads each one once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_QUOTED = re.compile(r"'(?:[^']|'')*'")
_NAME = re.compile(r"[A-Za-z_]\w*")


@dataclass(frozen=True)
class Source:
    """A table that provides columns by key. ``read`` is only called when one of them is wanted.

    ``on`` maps its key columns to columns of the record (the record's key by default), which may themselves come from
    other sources. Several rows of a key become one: ``pick`` names an aggregate for a column, and all other
    columns come from the row with the smallest ``order``.
    """

    name: str
    read: Callable[[], DataFrame]
    provides: Sequence[str]
    on: Mapping[str, str] = field(default_factory=dict)
    pick: Mapping[str, Column] = field(default_factory=dict)
    order: Sequence[str] = ()


@dataclass(frozen=True)
class Derived:
    """A column that is computed from others."""

    name: str
    needs: Sequence[str]
    value: Column


def named_columns(rules: Iterable[str], known: Iterable[str]) -> list[str]:
    """The known columns that SQL rules name, in the order of ``known``; texts in quotes name nothing."""
    words = {w for rule in rules for w in _NAME.findall(_QUOTED.sub(" ", rule))}
    return [c for c in known if c in words]


def words_of(value: Column) -> set[str]:
    """The words of an expression as it is written: all columns it reads, and others that only look like columns."""
    return set(_NAME.findall(str(value)))


class Resolver:
    """Sources and derived columns for records with a key."""

    def __init__(self, key: str, sources: Sequence[Source], derived: Sequence[Derived] = ()):
        self.key = key
        self.source_of = {c: s for s in sources for c in s.provides}
        self.derived = {d.name: d for d in derived}
        provided = [c for s in sources for c in s.provides]
        twice = {c for c in provided if provided.count(c) > 1} | (set(provided) & set(self.derived))
        if twice:
            raise ValueError(f"provided twice: {sorted(twice)}")

    @property
    def known(self) -> list[str]:
        return [*self.source_of, *self.derived]

    def steps(self, wanted: Iterable[str], there: Iterable[str]) -> list[Source | Derived]:
        """What to join and compute, in an order in which every step finds what it needs."""
        out, done, busy = [], set(there), []

        def need(column: str) -> None:
            if column in done:
                return
            step = self.source_of.get(column) or self.derived.get(column)
            if step is None:
                raise KeyError(f"no source provides {column}")
            if step.name in busy:
                raise ValueError(f"{' needs '.join([*busy, step.name])}")
            busy.append(step.name)
            for other in step.needs if isinstance(step, Derived) else step.on.values():
                need(other)
            busy.pop()
            if step not in out:
                out.append(step)
            done.add(column)

        for column in wanted:
            need(column)
        return out

    def resolve(self, records: DataFrame, wanted: Iterable[str]) -> DataFrame:
        """``records`` with the ``wanted`` columns they lack; rows and other columns stay as they are.

        A record without a partner in a source gets NULLs, unless an aggregate of that source says otherwise.
        """
        wanted = list(dict.fromkeys(wanted))
        plan = self.steps(wanted, records.columns)
        taken = {c for step in plan for c in (step.needs if isinstance(step, Derived) else step.on.values())} | set(wanted)
        out = records
        for step in plan:
            if isinstance(step, Derived):
                out = out.withColumn(step.name, step.value)
                continue
            columns = [c for c in step.provides if c in taken and c not in records.columns]
            out = out.join(self._one_row(step, columns), self._condition(out, step), "left").drop(*[f"_on_{i}" for i in range(max(1, len(step.on)))])
        return out.select(*records.columns, *[c for c in wanted if c not in records.columns])

    def _one_row(self, source: Source, columns: list[str]) -> DataFrame:
        """One row per key of a source, with the columns that are taken; picked and aggregated before the shuffle."""
        keys = list(source.on) or [self.key]
        picked = [c for c in columns if c not in source.pick]
        first = F.min(F.struct(*source.order, *[c for c in picked if c not in source.order])) if picked else None
        aggregates = [*([first.alias("_first")] if picked else []), *[source.pick[c].alias(c) for c in columns if c in source.pick]]
        rows = source.read().groupBy(*[F.col(k).alias(f"_on_{i}") for i, k in enumerate(keys)]).agg(*aggregates)
        return rows.select(*[f"_on_{i}" for i in range(len(keys))], *[F.col(f"_first.{c}").alias(c) for c in picked], *[c for c in columns if c in source.pick])

    def _condition(self, records: DataFrame, source: Source) -> Column:
        condition = F.lit(True)
        for i, column in enumerate(source.on.values() or [self.key]):
            condition = condition & (records[column] == F.col(f"_on_{i}"))
        return condition
