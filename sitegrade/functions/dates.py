"""Dates relative to an explicit as-of day instead of the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession, functions as F

AsOf = str | dt.date | Column | None


def as_of_date(as_of: AsOf) -> Column:
    """``None`` is the day the query runs."""
    if as_of is None:
        return F.current_date()
    return (as_of if isinstance(as_of, Column) else F.lit(str(as_of))).cast("date")


def resolved(spark: SparkSession, as_of: AsOf) -> AsOf:
    """``None`` settled as today's date, so that all jobs of a run take the same day."""
    return spark.range(1).select(F.current_date()).first()[0] if as_of is None else as_of


def as_of_midnight(as_of: AsOf) -> Column:
    return as_of_date(as_of).cast("timestamp_ntz")


def months_before(as_of: AsOf, months: int) -> Column:
    """Midnight ``months`` calendar months earlier, clamped at the month's end."""
    return F.add_months(as_of_date(as_of), -months).cast("timestamp_ntz")


def days_since(col: Column, as_of: AsOf) -> Column:
    """Calendar days, not elapsed 24-hour periods."""
    return F.datediff(as_of_date(as_of), col)


def within_trailing_months(col: Column, as_of: AsOf, months: int) -> Column:
    """Strictly after the cut-off and open at the top: later rows pass."""
    return col > months_before(as_of, months)


def between_days(col: Column, first: str, as_of: AsOf) -> Column:
    """Inclusive; the upper end is the as-of day's midnight."""
    return col.between(F.lit(first).cast("timestamp_ntz"), as_of_midnight(as_of))
