"""Date expressions. The clock is always a parameter, never the time of the run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Minutes a listing may last (fixed values).
LISTING_MINUTES = [30, 60, 90, 120, 150, 180, 210, 240, 270, 300, 330, 360]


def retention_due(date: Column, months: int, as_of: str) -> Column:
    """The retention period has ended before ``as_of``."""
    return F.add_months(date, months) < F.lit(as_of).cast("date")


def ends_before(first: Column, first_months: int, second: Column, second_months: int) -> Column:
    """One period ends before another one does."""
    return F.add_months(first, first_months) < F.add_months(second, second_months)


def add_years(date: Column, years: int) -> Column:
    return F.add_months(date, 12 * years)


def iso_z(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS)


def parse_any(text: Column, patterns: Sequence[str]) -> Column:
    """The first pattern that parses; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])


def is_minor(birth: Column, at: Column, years: float = 18) -> Column:
    """Age below ``years`` by mean year length; a NULL birth date is not a minor."""
    return F.coalesce(F.datediff(at, birth) / F.lit(365.25) < F.lit(float(years)), F.lit(False))


def deadline(decided: Column, in_country: Column, days_in: int = 14, days_out: int = 28) -> Column:
    """Decision date plus the days allowed in or out of the country; NULL when the place is unknown."""
    return F.when(in_country, F.date_add(decided, days_in)).when(~in_country, F.date_add(decided, days_out))


def hours_minutes(minutes: Column) -> Column:
    """90 -> '1:30'."""
    return F.concat(
        F.floor(minutes / 60).cast("string"), F.lit(":"), F.lpad((minutes % 60).cast("string"), 2, "0")
    )


def duration_map(minutes: Column) -> Column:
    """Hours and minutes as text map entries; both NULL without a duration."""
    return F.create_map(
        F.lit("hours"), F.floor(minutes / 60).cast("string"),
        F.lit("minutes"), (minutes % 60).cast("string"),
    )


def half_hours(minutes: Column) -> Column:
    """Minutes moved to a half-hour grid as a struct (hours, minutes).

    Up to 44 odd minutes become 30, 45 and more become the next hour; 0 and NULL become half an hour.
    """
    odd, hours = minutes % 60, F.floor(minutes / 60)
    up = odd >= 45
    return F.struct(
        F.when(F.coalesce(minutes, F.lit(0)) == 0, F.lit(0)).when(up, hours + 1).otherwise(hours).cast("long").alias("hours"),
        F.when(F.coalesce(minutes, F.lit(0)) == 0, F.lit(30))
        .when((odd > 0) & ~up, F.lit(30))
        .otherwise(F.lit(0))
        .cast("long")
        .alias("minutes"),
    )


def nearest(value: Column, allowed: Sequence[int]) -> Column:
    """The allowed value closest to ``value``; the lower one wins a tie, the lowest stands for NULL."""
    ranked = F.array(*[F.struct(F.abs(F.lit(a) - value).alias("gap"), F.lit(a).alias("value")) for a in allowed])
    return F.array_min(ranked).getField("value")
