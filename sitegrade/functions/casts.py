"""Text-to-type casts that round fractional numbers instead of rejecting them.

``strict`` casts fail the job on text that is no such value, whatever the
session's ANSI mode; lenient ones give NULL.  The integer parse comes first
because nearly every value is a plain integer and parsing it is far cheaper than
going through double.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _checked(col: Column, parsed: Column, to: str, strict: bool) -> Column:
    if not strict:
        return parsed
    problem = F.concat(F.lit(f"not a value of type {to}: "), col.cast("string"))
    return F.coalesce(parsed, F.when(col.isNotNull(), F.raise_error(problem).cast(to)))


def _column(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def to_int(name: str | Column, strict: bool = True) -> Column:
    col = _column(name)
    rounded = F.round(col.try_cast("double")).try_cast("int")
    return _checked(col, F.coalesce(col.try_cast("int"), rounded), "int", strict)


def to_long(name: str | Column, strict: bool = True) -> Column:
    """Exact for long ids: the fallback is decimal, never double."""
    col = _column(name)
    rounded = F.round(col.try_cast("decimal(38,10)")).try_cast("bigint")
    return _checked(col, F.coalesce(col.try_cast("bigint"), rounded), "bigint", strict)


def to_double(name: str | Column, strict: bool = True) -> Column:
    col = _column(name)
    return _checked(col, col.try_cast("double"), "double", strict)


def to_coordinate(name: str | Column, strict: bool = True) -> Column:
    col = _column(name)
    return _checked(col, col.try_cast("decimal(18,12)"), "decimal(18,12)", strict)


def to_timestamp(name: str | Column, strict: bool = True) -> Column:
    """Zone-less, so no session time zone can move a day boundary."""
    col = _column(name)
    return _checked(col, col.try_cast("timestamp_ntz"), "timestamp_ntz", strict)
