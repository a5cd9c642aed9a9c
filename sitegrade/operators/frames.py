"""Sums over a trailing stretch of time, gaps to the row before, and ranks, for keys of any size.

Spark's window functions gather a key in one task and, for a range of time, walk
it row by row.  Here the sum over a stretch is the difference of two running
sums, at its end and as of its start, and a rank is a running count; running sums
go over blocks, see :mod:`sitegrade.operators.line`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitegrade.operators.line import ROWS_PER_BLOCK, carried, dealt, in_block, nearest, total, with_carried
from sitegrade.operators.temporal_joins import as_of_join
from sitegrade.sources.sinks import TableStore


def running_sums(points: DataFrame, store: TableStore, keys: Sequence[str], order: str, sums: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK, name: str = "running") -> DataFrame:
    """``points`` with the columns ``sums`` (whole numbers) replaced by their running sums, and the ``order`` of the point before.

    ``points`` has one row for each key and value of ``order``.  The value before
    is ``_previous``, null for a key's first.
    """
    line = dealt(points, store, name, keys, [order], rows_per_block)
    by_order = in_block(keys, order)
    for column in sums:
        before = carried(line, keys, F.sum(column), total())
        own = F.sum(column).over(by_order.rowsBetween(Window.unboundedPreceding, 0))
        line = with_carried(line.withColumn(f"_own_{column}", own), keys, before)
        line = line.withColumn(f"_own_{column}", F.col(f"_own_{column}") + F.coalesce("_carried", F.lit(0))).drop("_carried")
    line = with_carried(line.withColumn("_previous", F.lag(order).over(by_order)), keys, carried(line, keys, F.max(order), nearest()))
    first = [F.coalesce("_previous", "_carried").alias("_previous")]
    return line.select(*keys, order, *[F.col(f"_own_{c}").alias(c) for c in sums], *first)


def trailing_sums(
    rows: DataFrame, store: TableStore, keys: Sequence[str], at: str, months: int, measures: Mapping[str, Column], rows_per_block: int = ROWS_PER_BLOCK, name: str = "trailing"
) -> DataFrame:
    """For each key and moment the ``measures`` (sums or counts of whole numbers) over the ``months`` up to it, and ``days_since_previous``.

    The stretch is open at its start, as in the half-year models, and holds the
    moment itself.  Rows without a key or moment are left out.
    """
    counted = rows.dropna(subset=[*keys, at]).groupBy(*keys, at).agg(*[F.coalesce(m, F.lit(0)).cast("bigint").alias(n) for n, m in measures.items()])
    totals = store.save(running_sums(counted, store, keys, at, list(measures), rows_per_block, f"{name}_sums"), name, "totals")
    day = F.col(at).cast("date")
    start = F.add_months(day, -months).cast("timestamp_ntz") + (F.col(at).cast("timestamp_ntz") - day.cast("timestamp_ntz"))
    asked = totals.withColumn("_start", start)
    before = as_of_join(asked, totals, store, keys, "_start", at, list(measures), prefix="_before_", rows_per_block=rows_per_block, name=f"{name}_starts")
    inside = [(F.col(n) - F.coalesce(f"_before_{n}", F.lit(0))).alias(n) for n in measures]
    return before.select(*keys, at, *inside, F.datediff(at, "_previous").alias("days_since_previous"))


def percent_ranks(rows: DataFrame, store: TableStore, keys: Sequence[str], value: str, rank: str = "percentile", rows_per_block: int = ROWS_PER_BLOCK, name: str = "ranks") -> DataFrame:
    """``rows`` with the share of a key's other rows that have a smaller ``value``: 0 for the smallest, as for the only one.

    Equal values rank alike, a null key is a key, and a null value ranks below
    all others.  A value that many rows hold is counted before it is ordered.
    """
    given = store.save(rows, name, "rows")
    counts = given.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    line = dealt(counts, store, f"{name}_line", keys, [value], rows_per_block)
    below = F.coalesce(F.sum("_n").over(in_block(keys, value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = with_carried(line.withColumn("_below", below), keys, carried(line, keys, F.sum("_n"), total()))
    placed = placed.select(*keys, value, (F.col("_below") + F.coalesce("_carried", F.lit(0))).alias("_smaller"))
    placed = store.save(placed, name, "placed")
    sizes = store.save(given.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")), name, "sizes")
    out = given
    for side, on in ((placed, [*keys, value]), (sizes, list(keys))):
        named = side.select(*[F.col(c).alias(f"_of_{c}") for c in on], *[c for c in side.columns if c not in on])
        out = out.join(named, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on]).drop(*[f"_of_{c}" for c in on])
    share = F.when(F.col("_size") > 1, F.col("_smaller") / (F.col("_size") - 1)).otherwise(F.lit(0.0))
    return out.withColumn(rank, share).select(*rows.columns, rank)
