"""Payload entries of linked cases.

The links of a case are the entries of all other members of its group. A group of n would need n(n-1) of them, so
each entry is made once: the member's own, and the group's members in fragments. The links of a case are those
entries but its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.cases.base import KEY
from docketry.operators import linking
from docketry.operators.aggregates import PART


def entry(reason: Column, case_type: str) -> Column:
    """The entry other cases have for a case, as JSON; its id comes from the case and the reason."""
    why = F.struct(
        F.sha2(F.concat_ws("|", F.col(KEY), reason), 256).alias("id"),
        F.struct(reason.alias("Reason")).alias("value"),
    )
    value = F.struct(F.lit(case_type).alias("CaseType"), F.col(KEY).alias("CaseReference"), F.array(why).alias("ReasonForLink"))
    return F.to_json(F.struct(F.col(KEY).alias("id"), value.alias("value")))


def payloads(members: DataFrame, group: str, coarse: Column, size: int = PART) -> DataFrame:
    """The entries of each group in the order of the case numbers, as JSON arrays of ``size`` entries.

    ``members`` has CaseNo, the group and an ``entry``; ``coarse`` follows the order of CaseNo.
    """
    parts = linking.group_members(members, group, F.col("entry"), [KEY], coarse, "entries", size)
    return parts.select(group, "part", F.size("entries").alias("members"), F.concat(F.lit("["), F.array_join("entries", ","), F.lit("]")).alias("payload"))
