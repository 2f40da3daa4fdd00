"""Wide source records: raw tables joined by their keys, with only the columns that are used, under plain names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.operators import joins

# Over how many places rows without a reference are spread.
SPREAD = 1000

# Seat positions of a sitting.
CHAIR, SECOND_SEAT, THIRD_SEAT, CLERK = 10, 11, 12, 3


def follow(df: DataFrame, column: str, side: DataFrame, key: str, take: Mapping[str, str], required: bool = False) -> DataFrame:
    """``df`` with columns of the row that ``column`` refers to; ``take`` maps the side's names to new ones.

    ``side`` has one row per ``key``. Rows without a partner stay unless it is ``required``. One side may be
    followed several times in different roles, as nothing but the new names comes along. Rows that refer to nothing
    stay too, but have one key in common, the NULL; a second key spreads them over the tasks of a shuffle.
    """
    looked_up = side.select(F.col(key).alias("_followed"), *[F.col(c).alias(n) for c, n in take.items()])
    if required:
        return df.join(looked_up, F.col(column) == F.col("_followed")).drop("_followed")
    place = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind]), F.lit(SPREAD))
    spread = df.withColumn("_place", F.when(F.col(column).isNull(), place).otherwise(F.lit(0).cast("long")))
    # Always 0, but not as a literal, which the planner would take out of the keys.
    home = looked_up.withColumn("_home", F.pmod(F.xxhash64("_followed"), F.lit(1).cast("long")))
    return spread.join(home, (F.col(column) == F.col("_followed")) & (F.col("_place") == F.col("_home")), "left").drop("_followed", "_place", "_home")


def seats(sittings: DataFrame) -> DataFrame:
    """One row per list with an officer for each seat; cancelled sittings do not count.

    A seat filled twice would double every hearing if each seat were joined on its own.
    """
    roles = {"chair": CHAIR, "second": SECOND_SEAT, "third": THIRD_SEAT, "clerk": CLERK}
    return joins.role_pivot(sittings.filter(F.col("Cancelled") == 0), ["ListId"], "Position", roles, "AdjudicatorId")


def hearings(statuses: DataFrame, placements: DataFrame, lists: DataFrame, courts: DataFrame, sittings: DataFrame, officers: DataFrame) -> DataFrame:
    """Status rows with their list, court and bench.

    ``placements`` puts a status on a list; ``lists`` has its court and type, ``courts`` and ``officers`` names.
    """
    placed = follow(statuses, "StatusId", placements, "StatusId", {"ListId": "ListId", "TimeEstimate": "TimeEstimate"})
    listed = follow(placed, "ListId", lists, "ListId", {"CourtId": "CourtId", "ListTypeId": "ListTypeId"})
    wide = follow(listed, "CourtId", courts, "CourtId", {"CourtName": "court"})
    wide = follow(wide, "ListId", seats(sittings), "ListId", {c: f"_{c}" for c in ("chair", "second", "third", "clerk")})
    for seat in ("chair", "second", "third", "clerk"):
        wide = follow(wide, f"_{seat}", officers, "AdjudicatorId", {"Surname": seat}).drop(f"_{seat}")
    wide = follow(wide, "AdjudicatorId", officers, "AdjudicatorId", {"Surname": "allocated"})
    return follow(wide, "DeterminationBy", officers, "AdjudicatorId", {"Surname": "decided_by"})


def bench(assignments: DataFrame, officers: DataFrame) -> DataFrame:
    """Officers assigned to cases, without those who are not to be listed."""
    listed = officers.filter(F.col("DoNotList") == 0)
    return follow(assignments, "AdjudicatorId", listed, "AdjudicatorId", {"Surname": "judge"}, required=True)


def payments(transactions: DataFrame, types: DataFrame, users: DataFrame) -> DataFrame:
    """Transactions with their type and the names of who made and last changed them."""
    typed = follow(transactions, "TransactionTypeId", types, "TransactionTypeId", {"Description": "type"})
    made = follow(typed, "CreateUserId", users, "UserId", {"Name": "created_by"})
    return follow(made, "LastEditUserId", users, "UserId", {"Name": "changed_by"})
