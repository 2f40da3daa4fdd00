"""Quality rules with cross-document line frequency, in DataFrame functions only.

Each text is split at line feeds; a line is normalised (A-Z lower-cased, words joined by single spaces) and hashed with
its host. A line of a host is frequent when more than ``max_docs`` distinct documents of that host hold it, whatever the
size of the host; copies are documents of their own. Frequent lines are removed. A document is rejected when it fails
a base rule, or when what is left of it is depleted: fewer than ``left_words`` words, or under ``left_share`` of its words.

Counts combine before the shuffle. Frequent lines meet the lines of the documents by hash, those of very many
documents without a shuffle, and per document the places of its frequent lines come back to its row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import col, join_marks, written
from docketry.sources.scratch import mark, release

SPACE = "[\\x20\\x09-\\x0D]+"
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules; shares are in per cent."""

    min_words: int = 20
    repeat_share: int = 30
    max_docs: int = 100
    left_words: int = 10
    left_share: int = 30


def words(text: Column) -> Column:
    """Words between white space; no word gives an empty array."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found twice or more in the text.

    Windows are compared by a 64-bit hash of their words' hashes. Only a text with a repeated window sorts
    its windows, to find the places; then the gaps between those places are added up.
    """
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        return F.when(F.size(h) < WINDOW, F.expr("array()").cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
        )

    def places(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        first = F.struct(F.lit(None).cast("long").alias("h"), F.lit(-1).alias("i"))
        # A place counts when its neighbour in hash order on either side has the same hash.
        return bind(
            ordered,
            lambda o: F.sort_array(
                F.filter(
                    F.zip_with(
                        F.zip_with(o, F.concat(F.array(first), F.slice(o, F.lit(1), F.size(o) - 1)), lambda a, b: F.struct(a["h"].alias("h"), a["i"].alias("i"), a["h"].eqNullSafe(b["h"]).alias("before"))),
                        F.concat(F.slice(o, F.lit(2), F.size(o)), F.array(first)),
                        lambda a, b: F.when(a["before"] | a["h"].eqNullSafe(b["h"]), a["i"]),
                    ),
                    lambda p: p.isNotNull(),
                )
            ),
        )

    def covered(p: Column) -> Column:
        gaps = F.zip_with(F.slice(p, F.lit(2), F.size(p)), F.slice(p, F.lit(1), F.size(p) - 1), lambda b, a: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda total, x: total + x.cast("long"))

    return bind(
        bind(hashes, grams),
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(bind(places(w), covered)),
    )


def bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def line_hash(tokens: Column, host: Column) -> Column:
    """Hash of a normalised line of a host, from its words; a null host is a host of its own."""
    return F.xxhash64(host.isNull(), host, F.translate(F.array_join(tokens, " "), UPPER, LOWERED))


def measures(text: Column, host: Column) -> Column:
    """A struct of the base measures and the lines with words (hash, words, place) of a text that is not null.

    Each line is split into words once; everything else follows from those words, as a line feed is white space.
    """
    lines = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(line.alias("raw"), words(line).alias("w"), i.alias("at")))

    def measured(rows: Column) -> Column:
        return F.struct(
            F.aggregate(rows, F.lit(0).cast("long"), lambda n, r: n + F.size(r["w"])).alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(rows) - F.size(F.array_distinct(F.transform(rows, lambda r: r["raw"])))).cast("long").alias("n_dup_lines"),
            repeated_words(F.flatten(F.transform(rows, lambda r: r["w"]))).alias("n_repeat_words"),
            F.transform(rows, lambda r: F.struct(line_hash(r["w"], host).alias("line"), F.size(r["w"]).alias("n"), r["at"].alias("at"))).alias("lines"),
        )

    return bind(F.filter(lines, lambda r: F.size(r["w"]) > 0), measured)


def frequent_lines(stored: DataFrame, limits: Limits) -> DataFrame:
    """Rows (``__of``) that hold frequent lines, with the words in those and their places, from rows of ``__row`` and ``__m.lines``.

    A document counts once for each of its lines, so a line's rows are added up in every task before the shuffle.
    """
    own = F.array_distinct(F.transform("__m.lines", lambda x: x["line"]))
    counted = stored.select(F.explode(own).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("docs"))
    frequent, _ = written(counted.filter(F.col("docs") > limits.max_docs), "frequent-lines")
    total = stored.agg(F.sum(F.size(own))).first()[0] or 0
    each = stored.select("__row", F.explode("__m.lines").alias("l")).select("__row", "l.line", "l.n", "l.at")
    found = join_marks(each, frequent, ["line"], "docs", total)
    return found.groupBy(F.col("__row").alias("__of")).agg(F.sum("n").alias("__gone"), F.collect_list("at").alias("__places"))


def judged(df: DataFrame, host_col: str, text_col: str, limits: Limits = Limits(), carry: list[str] | None = None, name: str = "quality") -> DataFrame:
    """Every row of ``df`` (or its ``carry`` columns) with a struct ``name``.

    Fields: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``kept``, ``n_removed_words``, ``removed`` (places of its frequent lines among all its lines, from 0). Each row is a
    document, so repeated rows count each. A null text has no words and fails the base rules; a null host is a host of
    its own; texts of any length are taken whole; an empty table gives an empty result. A column called ``name``
    gives way, others pass through whatever their names.

    Rows and measures are written once, and so are the rows' frequent lines, which come back by row number.
    """
    begun = mark()
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() != name.lower()]
    inside = {c: f"__column_{i}" for i, c in enumerate(kept)}
    text = F.coalesce(col(text_col), F.lit(""))
    measured = df.select(
        *[col(c).alias(n) for c, n in inside.items()], F.monotonically_increasing_id().alias("__row"), measures(text, col(host_col).cast("string")).alias("__m")
    )
    stored, stored_path = written(measured, "quality")
    marks, marks_path = written(frequent_lines(stored, limits), "quality-lines")
    release(df.sparkSession, begun, keep=[stored_path, marks_path])
    # Rows meet their marks by row number, which no row shares, and always in the same way: sent to every task while they are
    # few, the marks would make large inputs take another path than small ones.
    joined = stored.join(marks.hint("shuffle_hash"), F.col("__row") == F.col("__of"), "left")
    n_words, gone = F.col("__m.n_words"), F.coalesce("__gone", F.lit(0).cast("long"))
    failed = (n_words < limits.min_words) | (100 * F.col("__m.n_repeat_words") > limits.repeat_share * n_words)
    left = n_words - gone
    depleted = (gone > 0) & ((left < limits.left_words) | (100 * left < limits.left_share * n_words))
    result = F.struct(
        *[F.col(f"__m.{k}") for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        gone.alias("n_removed_words"),
        F.coalesce(F.sort_array("__places"), F.expr("array()").cast("array<int>")).alias("removed"),
    )
    return joined.select(*[F.col(n).alias(c) for c, n in inside.items()], result.alias(name))


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines at the places in ``removed``; the text itself where there is none.

    The lambdas name no column of the row, which inside a lambda could be taken for an alias of the same select.
    """
    lines = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    kept = bind(F.struct(lines.alias("lines"), left.alias("left")), lambda s: F.array_join(F.transform(s["left"], lambda i: F.element_at(s["lines"], i + 1)), "\n"))
    return F.when(F.size(removed) == 0, text).otherwise(kept)
