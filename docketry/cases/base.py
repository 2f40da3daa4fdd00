"""The base record: everything the content fields of a case need, one row per case.

Each source table is combined per case once, before any join. Content fields are then plain column
expressions over the base, so a state with hundreds of fields costs one projection, not one join per
group of fields.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators import aggregates, joins, ranking

KEY = "CaseNo"

# Which status row of a case a field is taken from (fixed values: status and outcome codes).
STATUS_VARIANTS = {
    "any": "true",
    "with_outcome": "Outcome IS NOT NULL",
    "listed": "CaseStatus IN (37, 38)",
    "reviewed": "CaseStatus IN (37, 38) OR (CaseStatus = 26 AND Outcome = 0)",
    "listing": "(CaseStatus IN (37, 38) AND Outcome IN (0, 27, 37, 39, 40, 50)) OR (CaseStatus = 26 AND Outcome IN (40, 52))",
    "decided": "CaseStatus IN (37, 38, 26) AND Outcome IN (1, 2)",
    "permission": "CaseStatus = 39",
    "permission_decided": "CaseStatus = 39 AND Outcome IN (30, 31, 14)",
    "permission_final": "(CaseStatus = 39 AND Outcome IN (30, 31, 14)) OR (CaseStatus = 46 AND Outcome = 31)",
    "remitted": "CaseStatus IN (42, 43, 44) AND Outcome = 86",
    "reached": "(CaseStatus IN (26, 37, 38) AND Outcome IN (13, 25, 80)) OR (CaseStatus = 38 AND Outcome = 72) OR (CaseStatus = 39 AND Outcome = 25)",
    # Rows the state rules look at.
    "t": "Outcome NOT IN (38, 111) AND CaseStatus <> 17",
    "st": "CaseStatus IS NULL OR CaseStatus NOT IN (50, 52, 36)",
    "us": "CaseStatus IN (40, 41, 42, 43, 44, 45, 53, 27, 28, 29, 34, 32, 33)",
    "sa": "CaseStatus IS NULL OR CaseStatus <> 46",
}

# A case ends with one of these; 46/31 only counts when the case also has a status 10, 51 or 52.
ENDED = {10: [80, 122, 25, 120, 2, 105, 13], 26: [80, 13, 25], 37: [80, 13, 25, 72, 125], 38: [80, 13, 25, 72, 125], 39: [25], 51: [0, 94, 93], 52: [91, 95], 36: [1, 2, 25]}


@dataclass(frozen=True)
class CaseTables:
    """The tables of one migration run. Every one but ``lookups`` grows with the number of cases."""

    header: DataFrame
    people: DataFrame | None = None
    statuses: DataFrame | None = None
    transactions: DataFrame | None = None
    judges: DataFrame | None = None
    history: DataFrame | None = None
    categories: DataFrame | None = None
    references: DataFrame | None = None
    lookups: dict[str, DataFrame] = field(default_factory=dict)


def pair(row: str, codes: dict[int, Iterable[int]]) -> str:
    """SQL: the status row has one of the (status, outcome) codes."""
    return "(" + " OR ".join(
        f"({row}CaseStatus = {s} AND {row}Outcome IN ({', '.join(map(str, o))}))" for s, o in codes.items()
    ) + ")"


def status_summary(
    statuses: DataFrame, variants: Mapping[str, Iterable[str]], order: str = "StatusId", read: Mapping[str, Iterable[str]] | None = None
) -> DataFrame:
    """The latest status row of each variant as a struct, from one aggregate over the history.

    ``variants`` names the fields wanted from each, so that no other column is shuffled. The status id
    is unique in a case. ``read`` names those of them that are used: fields behind the last of these are not shuffled, those
    before it still break the ties of a repeated status id as they did.
    """

    def row(name: str) -> Column:
        names = [order, *[c for c in dict.fromkeys(variants[name]) if c != order]]
        used = names if read is None else read.get(name, [])
        return F.struct(*names[: 1 + max([names.index(c) for c in used], default=0)])

    wanted = [STATUS_VARIANTS[v] for v in variants if v != "ended"]
    if "ended" in variants:
        wanted.append(pair("", {**ENDED, 46: [31]}) + " OR CaseStatus IN (10, 51, 52)")
    # Rows no variant looks at are dropped before the shuffle; a case without rows gets NULL structs.
    statuses = statuses.filter(F.expr(" OR ".join(f"coalesce({w}, false)" for w in wanted)))
    aggs = [F.max(F.when(F.expr(STATUS_VARIANTS[v]), row(v))).alias(f"s_{v}") for v in variants if v != "ended"]
    if "ended" in variants:
        plain = F.max(F.when(F.expr(pair("", ENDED)), row("ended")))
        with_46 = F.max(F.when(F.expr(pair("", {**ENDED, 46: [31]})), row("ended")))
        aggs.append(
            F.when(F.coalesce(F.bool_or(F.col("CaseStatus").isin(10, 51, 52)), F.lit(False)), with_46)
            .otherwise(plain)
            .alias("s_ended")
        )
    summary = statuses.groupBy(KEY).agg(*aggs)
    if read is None:
        return summary
    kept = {v: F.struct(*[F.col(f"s_{v}.{c}") for c in dict.fromkeys([*read.get(v, [])] or [order])]) for v in variants}
    return summary.select(KEY, *[F.when(F.col(f"s_{v}").isNotNull(), row).alias(f"s_{v}") for v, row in kept.items()])


def main_party(people: DataFrame) -> DataFrame:
    """The person the case is about: the one without a relationship to another."""
    rows = people.filter(F.col("Relationship").isNull()).drop("Relationship")
    rest = [c for c in rows.columns if c != KEY]
    return ranking.earliest(rows, [KEY], rest)


def category_set(categories: DataFrame) -> DataFrame:
    """Distinct category ids per case; their number is bounded by the category lookup."""
    return categories.groupBy(KEY).agg(F.sort_array(F.collect_set("CategoryId")).alias("CategoryIds"))


def money_summary(transactions: DataFrame) -> DataFrame:
    """All payment figures of a case.

    A transaction that a reversal (type 6 or 19) refers to does not count for the balance, nor one that
    any other transaction refers to for what was paid. Both marks are joined once; the sums share one
    aggregate.
    """
    refers = transactions.filter(F.col("ReferringTransactionId").isNotNull())
    marks = refers.groupBy(F.col("ReferringTransactionId").alias("TransactionId")).agg(
        F.bool_or(F.col("TransactionTypeId").isin(6, 19)).alias("reversed"),
        F.bool_or(~F.col("TransactionTypeId").isin(6, 19)).alias("replaced"),
    )
    t = transactions.join(marks, "TransactionId", "left").withColumns(
        {"reversed": F.coalesce("reversed", F.lit(False)), "replaced": F.coalesce("replaced", F.lit(False))}
    )
    counted = ~F.col("reversed") & F.col("SumBalance")
    kind = F.col("TransactionTypeId")

    def total(cond: Column) -> Column:
        return aggregates.total("Amount", cond)

    return t.groupBy(KEY).agg(
        total(counted).alias("balance"),
        F.max(F.when(counted, F.struct("TransactionId", "TransactionTypeId"))).alias("last_counted"),
        F.abs(total(~F.col("replaced") & F.col("SumTotalPay"))).alias("paid"),
        F.bool_or(~F.col("replaced") & (kind == 3)).alias("has_payment"),
        F.abs(total((kind == 5) & (F.col("Status") != 3))).alias("remitted"),
        F.bool_or(kind == 5).alias("has_remission"),
        total(~F.col("reversed") & F.col("SumTotalFee")).alias("left_to_pay"),
    )


def judge_texts(judges: DataFrame) -> DataFrame:
    """Judge lines per case: all with their requirement, and the excluded ones alone.

    Distinct lines collapse map-side; a line names one judge of the judge list.
    """
    required = F.when(F.col("Required"), F.lit("Required")).when(~F.col("Required"), F.lit("Not Required"))
    title = F.col("Judge_Title")
    line = F.concat_ws(
        " ", "Judge_Surname", "Judge_Forenames", F.when(title.isNotNull(), "("), title, F.when(title.isNotNull(), ")"),
        F.when(required.isNotNull(), ":"), required,
    )
    excluded = F.when(
        ~F.col("Required"), F.concat("Judge_Surname", F.lit(", "), "Judge_Forenames", F.lit(" ("), title, F.lit(")"))
    )
    return judges.groupBy(KEY).agg(
        F.array_join(F.sort_array(F.collect_set(line)), "\n").alias("judge_lines"),
        F.nullif(F.array_join(F.sort_array(F.collect_set(excluded)), "\n"), F.lit("")).alias("excluded_judges"),
    )


def previous_location(history: DataFrame) -> DataFrame:
    """The file location before the current one, from the newest move that is no storage or upper tribunal."""
    kept = (
        (F.col("HistType") == 6)
        & ~F.col("Comment").like("%Castle Park Storage%")
        & ~F.col("Comment").like("%Field House%")
        & ~F.col("Comment").like("%UT (IAC)%")
    )
    newest = ranking.latest(history, [KEY], ["HistoryId", "Comment"], kept)
    return newest.select(KEY, F.split("Comment", ",")[0].alias("prev_location"))


def case_base(tables: CaseTables, variants: Mapping[str, Iterable[str]] | None = None, read: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """One row per case. Only the parts that are asked for, or whose tables are given, are joined."""
    sides = []
    if tables.people is not None:
        sides.append(main_party(tables.people))
    if variants:
        sides.append(status_summary(tables.statuses, variants, read=read))
    if tables.categories is not None:
        sides.append(category_set(tables.categories))
    if tables.transactions is not None:
        sides.append(money_summary(tables.transactions))
    if tables.judges is not None:
        sides.append(judge_texts(tables.judges))
    if tables.history is not None:
        sides.append(previous_location(tables.history))
    if tables.references is not None:
        sides.append(tables.references.select(KEY, F.coalesce("CleanHORef", "CleanFCONumber").alias("lu_HORef")))
    return joins.assemble(tables.header, sides, KEY)
