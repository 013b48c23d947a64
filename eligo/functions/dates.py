"""Date helpers: day numbers and gap flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day_number(col="hearing_date") -> Column:
    """Days since 1970-01-01 as an int; range frames order by this."""
    return F.unix_date(F.col(col) if isinstance(col, str) else col)


def from_day_number(col) -> Column:
    return F.date_from_unix_date(F.col(col) if isinstance(col, str) else col)


def gap_flag(delta, years: int, days_per_year: float) -> Column:
    """``delta < years`` with a year of ``days_per_year`` days; a null gap is False."""
    delta = F.col(delta) if isinstance(delta, str) else delta
    return F.coalesce(delta < F.lit(float(years) * days_per_year), F.lit(False))
