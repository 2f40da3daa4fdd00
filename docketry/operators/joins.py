"""Joins: star, restriction, exclusion, lookup, assembly."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star(base: DataFrame, dims: Sequence[tuple[DataFrame, Column | str | list[str]]]) -> DataFrame:
    """Left-outer star. Join strategy is left to the planner, which knows the real sizes."""
    return reduce(lambda df, dim: df.join(dim[0], dim[1], "left"), dims, base)


def restrict(df: DataFrame, segment: DataFrame, key: str, take: Sequence[str] = ()) -> DataFrame:
    """Rows whose key is in the segment; with ``take`` also those segment columns.

    The segment is reduced to distinct keys before the join, so a key repeated many times in it
    collapses map-side.
    """
    if not take:
        return df.join(segment.select(key).distinct(), key, "left_semi")
    return df.join(segment.select(key, *take).distinct(), key, "inner")


def exclude(df: DataFrame, keys: DataFrame, on: str | list[str] | Column, null_aware: bool = False) -> DataFrame:
    """Rows without a partner. ``null_aware`` follows NOT IN: a NULL on the right removes every row.

    Repeated keys collapse map-side before the join.
    """
    names = [on] if isinstance(on, str) else on if isinstance(on, list) else keys.columns
    kept = df.join(keys.select(*names).distinct(), on, "left_anti")
    if not null_aware:
        return kept
    # Two counts of the keys decide the rest, as subqueries of one row in the same plan.
    name = names[0]
    rows = keys.agg(F.count(F.lit(1))).scalar()
    holes = keys.agg(F.count_if(F.col(name).isNull())).scalar()
    return kept.filter((rows == 0) | ((holes == 0) & F.col(name).isNotNull()))


def role_pivot(dim: DataFrame, keys: Sequence[str], role: str, roles: dict, value: str) -> DataFrame:
    """One row per key with one column per role, so that one join replaces one per role."""
    return dim.groupBy(*keys).agg(
        *[F.min(F.when(F.col(role) == code, F.col(value))).alias(name) for name, code in roles.items()]
    )


def join_any(base: DataFrame, lookup: DataFrame, shared: Column, either: Sequence[Column]) -> DataFrame:
    """Left join where ``shared`` and any of ``either`` hold.

    ``shared`` must be an equality: it makes this a hash join with the alternatives as an extra
    condition, where an OR of whole conditions could end as a nested loop.
    """
    return base.join(lookup, shared & reduce(lambda a, b: a | b, either), "left")


# Pairs of one key that one task makes; a key with more is cut into so many shares of its left rows, at most ``SHARES``.
PAIRS, SHARES = 20_000_000, 4096


def _spread_join(left: DataFrame, right: DataFrame, a: Column, b: Column, rest: Column | None, pairs: int) -> DataFrame:
    """Inner join by ``a`` = ``b`` and ``rest``, with the pairs of a hot key made by several tasks.

    A key has as many pairs as the product of its rows on both sides says. One with more than ``pairs`` has its left rows
    dealt to shares and its right rows copied to each. There are never more such keys than the pairs of all keys divided by
    ``pairs``, so the list of them is small beside the result and goes to every task.
    """
    per_left = left.groupBy(a.alias("_key")).agg(F.count(F.lit(1)).cast("double").alias("_l"))
    per_right = right.groupBy(b.alias("_key_r")).agg(F.count(F.lit(1)).cast("double").alias("_r"))
    many = per_left.join(per_right, F.col("_key") == F.col("_key_r")).filter(F.col("_l") * F.col("_r") > pairs)
    shares = F.least(F.ceil(F.col("_l") * F.col("_r") / pairs), F.lit(SHARES)).cast("long")
    hot = F.broadcast(many.select(F.col("_key").alias("_hot"), shares.alias("_shares")))
    place = F.pmod(F.xxhash64(*left.columns), F.coalesce("_shares", F.lit(1).cast("long")))
    dealt = left.join(hot, a == F.col("_hot"), "left").withColumn("_place", place).drop("_hot", "_shares")
    last = F.coalesce("_shares", F.lit(1).cast("long")) - 1
    copied = right.join(hot, b == F.col("_hot"), "left").withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("_hot", "_shares")
    same = (a == b) & (F.col("_place") == F.col("_copy"))
    # A hint, as a side small enough to go everywhere would leave all pairs to the few tasks that read the other one.
    joined = dealt.hint("merge").join(copied, same if rest is None else same & rest)
    return joined.drop("_place", "_copy")


def match_any(left: DataFrame, right: DataFrame, either: Sequence[tuple[Column, Column]], how: str = "inner", pairs: int = PAIRS) -> DataFrame:
    """Pairs for which any of the equalities ``either`` holds, each pair once, on two sides of any size.

    An OR of equalities has no key to shuffle by, so as one join it is a nested loop. Here each equality is a join of its own,
    and a pair is left to the first of them that holds: the later ones exclude it as they meet it, so nothing needs to be
    made distinct afterwards. ``how`` is ``inner`` or ``left``, which adds the rows of ``left`` without a partner. Columns
    of the two sides have different names. A NULL equals nothing. The pairs of a key go to tasks ``pairs`` at a time.
    """
    found = []
    for i, (a, b) in enumerate(either):
        earlier = [~F.coalesce(x == y, F.lit(False)) for x, y in either[:i]]
        found.append(_spread_join(left, right, a, b, reduce(lambda c, e: c & e, earlier) if earlier else None, pairs))
    if how == "left":
        alone = reduce(lambda df, e: df.join(right.select(e[1].alias("_other")).distinct(), e[0] == F.col("_other"), "left_anti"), either, left)
        found.append(alone.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]))
    return reduce(lambda x, y: x.unionByName(y), found)


def attach_list(df: DataFrame, lookup: DataFrame, name: str, *fields: str) -> DataFrame:
    """A whole lookup as a constant array column, sorted by its fields; for lookups that are to stand in every row.

    The array is a subquery of one row, made once by the executors.
    """
    items = lookup.select(F.struct(*fields).alias("item")).distinct().agg(F.sort_array(F.collect_list("item")))
    return df.withColumn(name, items.scalar())


def unify(outputs: Sequence[DataFrame], key: str, failed: Sequence[str] = ()) -> DataFrame:
    """Records present in every output, without those whose listed columns report a failure."""
    joined = reduce(lambda a, b: a.join(b, key, "inner"), outputs)
    for column in failed:
        joined = joined.filter(F.coalesce(~F.col(column).like("Failure%"), F.lit(False)))
    return joined


def assemble(base: DataFrame, groups: Sequence[DataFrame], key: str) -> DataFrame:
    """One wide row per key from one-row-per-key groups.

    All joins use the same key, so each side is shuffled once. No ``distinct`` follows: check the
    groups with ``quality.assert_unique`` instead.
    """
    return reduce(lambda a, b: a.join(b, key, "left"), groups, base)


def pack(df: DataFrame, apart: Sequence[str], name: str) -> DataFrame:
    """All columns but ``apart`` as one value, for a row of many columns that passes many joins.

    A join writes every column of its rows anew; one value is copied as a block. It is an array of one struct, as the
    planner takes a bare struct to pieces again when it looks for unused fields. ``unpack`` gives the columns back.
    """
    rest = [c for c in df.columns if c not in apart]
    return df.select(*[c for c in df.columns if c in apart], F.array(F.struct(*rest)).alias(name))


def unpack(df: DataFrame, name: str) -> DataFrame:
    """The columns that ``pack`` put into ``name``; every row stays one row.

    ``inline_outer``, as the planner adds a filter on the size of the array to a plain ``inline``.
    """
    return df.select(*[c for c in df.columns if c != name], F.inline_outer(name))


def in_pairs(df: DataFrame, columns: Sequence[str], lookup: DataFrame, name: str) -> DataFrame:
    """Whether the column combination occurs in the lookup; repeated lookup rows do not fan out."""
    allowed = lookup.select(*[F.col(c).alias(f"_lk_{i}") for i, c in enumerate(lookup.columns)]).distinct()
    allowed = allowed.withColumn("_hit", F.lit(True))
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_lk_{i}") for i, c in enumerate(columns)])
    return df.join(allowed, cond, "left").select(*[df[c] for c in df.columns], F.coalesce("_hit", F.lit(False)).alias(name))


def fallback_lookup(df: DataFrame, attempts: Sequence[tuple[DataFrame, str, str, str]], name: str, default) -> DataFrame:
    """The first lookup that knows the record.

    Each attempt is (lookup, column of ``df``, lookup key, lookup value); lookups hold one row per key.
    """
    found = []
    base = df.columns
    for i, (lookup, column, key, value) in enumerate(attempts):
        side = lookup.select(F.col(key).alias(f"_k{i}"), F.col(value).alias(f"_v{i}"))
        df = df.join(side, F.col(column) == F.col(f"_k{i}"), "left")
        found.append(F.col(f"_v{i}"))
    return df.select(*base, F.coalesce(*found, F.lit(default)).alias(name))
