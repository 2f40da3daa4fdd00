"""Array and struct expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_any(ids: Column, wanted: Sequence) -> Column:
    """Whether the collected ids hold any wanted value; no ids means no."""
    return F.coalesce(F.arrays_overlap(ids, F.array(*[F.lit(w) for w in wanted])), F.lit(False))


def flag_array(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """The structs whose condition holds; NULL when none does.

    Arrays of one or none are joined: ``array_compact`` is a function over elements, and generated code leaves everything
    under such a function to the interpreter.
    """
    kept = F.concat(*[F.when(cond & flag.isNotNull(), F.array(flag)).otherwise(F.array()) for cond, flag in pairs])
    return F.when(F.size(kept) > 0, kept)


def flag(
    key: Column, name: str, code: str, comment: str | None, relevant: str, as_of: str, sub_type: tuple[Column, Column] | None = None
) -> Column:
    """A flag entry, if need be with the key and value of its sub-type.

    Its id comes from the record key, so that a second run yields the same entry.
    """
    more = [] if sub_type is None else [sub_type[0].alias("subTypeKey"), sub_type[1].alias("subTypeValue")]
    return F.struct(
        F.sha2(F.concat_ws("|", key.cast("string"), F.lit(code), F.lit(name)), 256).alias("id"),
        F.struct(
            F.lit(name).alias("name"),
            F.lit("Active").alias("status"),
            F.lit(code).alias("flagCode"),
            F.lit(comment).cast("string").alias("flagComment"),
            *more,
            F.lit(as_of).alias("dateTimeCreated"),
            F.lit(relevant).alias("hearingRelevant"),
        ).alias("value"),
    )


def align(item: Column, fields: Mapping[str, str], have: Sequence[str]) -> Column:
    """A struct with exactly ``fields`` (name -> type), missing ones NULL."""
    return F.struct(
        *[(item[f].cast(t) if f in have else F.lit(None).cast(t)).alias(f) for f, t in fields.items()]
    )


def update_each(items: Column, changes) -> Column:
    """Replace fields of each element; ``changes`` maps a field to a function of the element."""

    def change(item: Column) -> Column:
        for name, value in changes.items():
            item = item.withField(name, value(item))
        return item

    return F.transform(items, change)


def seats(counts: Sequence[tuple[str, Column]], seat: int) -> Column:
    """The label of seat ``seat`` when labels are seated in order, each as often as its count."""
    rows = F.flatten(F.array(*[F.array_repeat(F.lit(label), F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).cast("int")) for label, n in counts]))
    return F.try_element_at(rows, F.lit(seat))


def first_n_text(items: Column, n: int, sep: str = ", ", more: str = ", ...") -> Column:
    """The first ``n`` elements as text, with a mark when there are more."""
    head = F.array_join(F.slice(items, 1, n), sep)
    return F.when(F.size(items) > n, F.concat(head, F.lit(more))).otherwise(head)
