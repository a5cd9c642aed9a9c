"""Subtotals over several groupings at once, and distinct counts that can be merged."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F


def rollup_sets(columns: Sequence[str]) -> list[list[str]]:
    """All columns, all but the last, and so on to the total."""
    return [list(columns[:n]) for n in range(len(columns), -1, -1)]


def cube_sets(columns: Sequence[str]) -> list[list[str]]:
    """Every choice of columns."""
    return [list(chosen) for n in range(len(columns), -1, -1) for chosen in combinations(columns, n)]


def grouping_sets(rows: DataFrame, columns: Sequence[str], sets: Sequence[Sequence[str]], distinct: str, count: str = "rows", distinct_count: str = "distinct") -> DataFrame:
    """``columns``, ``grouping_id``, the number of rows and of distinct values of ``distinct``, for each of ``sets``.

    A column that a set leaves out is null and has its bit set in
    ``grouping_id`` (the first column has the highest), which tells a subtotal
    from a group whose value is null.

    Rows are counted by all columns and the distinct one first, and only these
    counts are multiplied by the number of sets.  Distinct values are counted in
    two steps, by group and value and then by group, so not even the total
    gathers the values in one task.
    """
    grain = rows.groupBy(*columns, F.col(distinct).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    grouped = grain.groupingSets([[F.col(c) for c in chosen] for chosen in sets], *[F.col(c) for c in columns])
    return grouped.agg(
        F.grouping_id(*columns).cast("int").alias("grouping_id"), F.sum("_n").alias(count), F.count_distinct("_value").alias(distinct_count)
    )


LG_REGISTERS = 12


def distinct_sketches(rows: DataFrame, keys: Sequence[str], distinct: str, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """``keys`` and ``sketch``, a HyperLogLog sketch of the values of ``distinct``: a few kilobytes, however many there are.

    Store it by key and, say, month; :func:`merged_estimates` then answers any
    union of them without the rows.
    """
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(distinct, lg_registers).alias("sketch"))


def merged_estimates(sketches: DataFrame, keys: Sequence[str], estimate: str = "estimate") -> DataFrame:
    """Distinct values in the union of all sketches of ``keys``; in what order they are merged does not matter."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(estimate))


def relative_error(lg_registers: int = LG_REGISTERS) -> float:
    """One standard deviation of a merged estimate."""
    return 1.04 / 2 ** (lg_registers / 2)


def trailing_estimates(sketches: DataFrame, keys: Sequence[str], month: str, months: int, estimate: str = "estimate") -> DataFrame:
    """For each key and month the distinct values of the ``months`` up to it.

    Each month's sketch is sent to the months that count it, so a window costs
    ``months`` sketches a key and month and no row is read again.
    """
    ahead = F.sequence(F.lit(0), F.lit(months - 1))
    sent = sketches.withColumn("_ahead", F.explode(ahead)).withColumn("_for", F.add_months(month, F.col("_ahead")))
    known: list[Column] = [F.col(k) for k in keys]
    there = sketches.select(*known, F.col(month).alias("_for")).distinct()
    merged = merged_estimates(sent.drop(month), [*keys, "_for"], estimate)
    return merged.join(there, [*keys, "_for"], "left_semi").withColumnRenamed("_for", month)
