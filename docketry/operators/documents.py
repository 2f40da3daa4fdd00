"""JSON, template and manifest documents, and field lineage."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import html_escape
from docketry.operators import aggregates, skew

PLACEHOLDER = re.compile(r"\{\{(\w+)\}\}")


def file_name(key: Column, prefix: str, extension: str) -> Column:
    return F.concat(F.lit(prefix), F.replace(key.cast("string"), F.lit("/"), F.lit("_")), F.lit(f".{extension}"))


def row_json(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """All columns but ``exclude`` as JSON; NULL fields are left out."""
    return F.to_json(F.struct(*[c for c in df.columns if c not in exclude]))


def read_back(content: Column, schema: str) -> Column:
    """Fields of a JSON document that the same plan has written.

    The parser is interpreted together with all that is planned into its argument. A document that is named twice is not
    planned into it: it is written by generated code first and parsed then.
    """
    return F.when(content.isNotNull(), F.from_json(content, schema))


def content_status(content: Column) -> Column:
    """Missing or failed content is a failure."""
    return F.when(content.isNull() | content.like("Failure%"), F.lit("Failure")).otherwise(F.lit("Success"))


def render(template: str, values: Mapping[str, Column], raw: Sequence[str] = ()) -> Column:
    """A template with ``{{name}}`` placeholders as one concat of its pieces.

    Values are escaped for HTML unless listed in ``raw`` (numbers and dates need no escape); a NULL value
    leaves its place empty.
    """
    pieces: list[Column] = []
    end = 0
    for mark in PLACEHOLDER.finditer(template):
        if mark.start() > end:
            pieces.append(F.lit(template[end : mark.start()]))
        value = F.coalesce(values[mark.group(1)].cast("string"), F.lit(""))
        pieces.append(value if mark.group(1) in raw else html_escape(value))
        end = mark.end()
    if end < len(template):
        pieces.append(F.lit(template[end:]))
    return F.concat(*pieces)


def render_children(
    df: DataFrame, keys: Sequence[str], template: str, values: Mapping[str, Column], name: str, order: Sequence[str],
    coarse: Column, raw: Sequence[str] = (), size: int = aggregates.PART,
) -> DataFrame:
    """The template once per child row, joined in order per key and part (as ``aggregates.nest``); ``first_part`` and ``last_part`` mark the ends.

    Rows are rendered before they are nested: plain columns stay in generated code, where a function
    over an array element would be interpreted.
    """
    return joined_parts(df, keys, {name: (render(template, values, raw), "")}, order, coarse, size)


def joined_parts(
    df: DataFrame, keys: Sequence[str], texts: Mapping[str, tuple[Column, str]], order: Sequence[str], coarse: Column, size: int = aggregates.PART,
    light: int | None = None,
) -> DataFrame:
    """Several texts of the same child rows, each joined in order with its separator, in parts of ``size`` rows.

    The last part is known from the number of rows of the key, which comes with the rank; so nothing is asked of all parts.
    """
    own = [F.col(c) for c in dict.fromkeys([*keys, *order])]
    rows = df.select(*own, *[t.alias(f"_text_{n}") for n, (t, _) in texts.items()], coarse.alias("_bucket"))
    named = [f"_text_{n}" for n in texts]
    sorted_rows = F.sort_array(F.collect_list(F.struct("_rn", *named)))

    def gather(ranked: DataFrame, apart: bool) -> DataFrame:
        cut = ranked.withColumn("part", F.floor((F.col("_rn") - 1) / size).cast("long"))
        groups = aggregates.collected(cut, [*keys, "part"]) if apart else cut.groupBy(*keys, "part")
        return groups.agg(sorted_rows.alias("_rows"), F.max("_all").alias("_all"))

    gathered = skew.ranked_groups(rows, keys, [*order, *named], F.col("_bucket"), gather, "_rn", "_all", light=light)
    joined = [F.array_join(F.col(f"_rows._text_{n}"), sep).alias(n) for n, (_, sep) in texts.items()]
    return gathered.select(*keys, "part", *joined, (F.col("part") == 0).alias("first_part"), ((F.col("part") + 1) * size >= F.col("_all")).alias("last_part"))


def fragment_page(head: Column, rows: Column, tail: Column) -> Column:
    """One part of a page: the head only on its first part and the tail only on its last, so that the parts join to the page.

    A record without children has one part, with both.
    """
    first, last = (F.coalesce(F.col(c), F.lit(True)) for c in ("first_part", "last_part"))
    return F.concat(F.when(first, head).otherwise(""), F.coalesce(rows, F.lit("")), F.when(last, tail).otherwise(""))


def checked(condition: Column) -> Column:
    return F.when(condition, F.lit("checked")).otherwise(F.lit(""))


def manifest_lines(key: Column, metadata: Mapping[str, Column], publisher: str, prefix: str) -> Column:
    """Three JSON lines for a record: the record, its HTML file and its JSON file."""
    blank = F.lit("")
    record = F.to_json(
        F.struct(
            F.lit("create_record").alias("operation"),
            key.cast("string").alias("relation_id"),
            F.struct(
                F.lit(publisher).alias("publisher"),
                *[F.coalesce(v.cast("string"), blank).alias(k) for k, v in metadata.items()],
            ).alias("record_metadata"),
        )
    )

    def upload(extension: str) -> Column:
        return F.to_json(
            F.struct(
                F.lit("upload_new_file").alias("operation"),
                key.cast("string").alias("relation_id"),
                F.struct(
                    F.lit(publisher).alias("publisher"),
                    file_name(key, prefix, extension).alias("dz_file_name"),
                    F.lit(extension).alias("file_tag"),
                ).alias("file_metadata"),
            )
        )

    return F.concat_ws("\n", record, upload("html"), upload("json"))


def manifest_batches(df: DataFrame, batch: str, order: str, content: str, name: str = "manifest") -> DataFrame:
    """One newline-joined manifest per batch with its number of records; the batch size bounds the
    collected lines."""
    rows = F.sort_array(F.collect_list(F.struct(order, content)))
    return aggregates.collected(df, [batch]).agg(
        F.count(F.lit(1)).alias("records"), F.array_join(F.transform(rows, lambda r: r[content]), "\n").alias(name)
    )


def inject_json(document: Column, name: str, value: Column) -> Column:
    """A JSON object with one more top-level field, all others kept whatever they are.

    Text that is no JSON object, or a NULL value, leaves the document as it is.
    """
    fields = F.try_parse_json(document).cast("map<string,variant>")
    others = F.map_filter(fields, lambda k, _: k != name)
    added = F.map_concat(F.create_map(F.lit(name), F.parse_json(F.to_json(value))), others)
    is_object = F.schema_of_variant(F.try_parse_json(document)).startswith("OBJECT")
    return F.when(is_object & value.isNotNull(), F.to_json(added)).otherwise(document)


def lineage(df: DataFrame, key: str, fields: Mapping[str, tuple[Sequence[str], bool]]) -> DataFrame:
    """Long lineage rows: per key and output field its inputs, value and whether it was derived."""
    entries = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(",".join(inputs)).alias("input_fields"),
            F.to_json(F.struct(*[F.col(i).cast("string").alias(i) for i in inputs])).alias("input_values"),
            F.col(name).cast("string").alias("value"),
            F.lit("yes" if derived else "no").alias("transformation"),
        )
        for name, (inputs, derived) in fields.items()
    ]
    return df.select(key, F.inline(F.array(*entries)))


def parent_child(df: DataFrame, key: str, parent: str, fields: Sequence[str], prefix: str = "parent_") -> DataFrame:
    """Rows with the fields of their parent row, by a left self-join on the parent id."""
    parents = df.select(F.col(key).alias("_pid"), *[F.col(f).alias(prefix + f) for f in fields])
    return df.join(parents, F.col(parent) == F.col("_pid"), "left").drop("_pid")
