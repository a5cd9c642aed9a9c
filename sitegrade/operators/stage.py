"""Visit scores, grades and validity filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitegrade import fixed_values as fixed
from sitegrade.functions.dates import AsOf, as_of_date, between_days, months_before
from sitegrade.functions.scoring import grade_of

VISIT_KEYS = ["camis", "inspection_date"]


def visit_avg_score(clean: DataFrame) -> DataFrame:
    """Mean violation score of each establishment's visit."""
    return clean.groupBy(*VISIT_KEYS).agg(F.avg("score").alias("avg_score"))


def attach_visit_score(clean: DataFrame, averages: DataFrame | None = None) -> DataFrame:
    """Every row with the mean of its whole visit, NULL where the establishment is unknown.

    The mean is pre-aggregated and joined back rather than taken by a window: a
    window would gather a visit, or all rows without an establishment, in one
    task.  ``averages`` are the stored rows of :func:`visit_avg_score`.  Only
    then does the join shuffle both sides, and a hot visit is split (adaptive
    skew join); an aggregate that is not stored already has the join's
    partitioning, and its hot partition stays whole.
    """
    if averages is None:
        averages = visit_avg_score(clean)
    return clean.join(averages.withColumnRenamed("avg_score", "computed_score"), VISIT_KEYS, "left")


def recency_flag(visited: Column, as_of: AsOf) -> Column:
    """``Z`` for a visit in the last month, else ``N``."""
    return F.when(visited >= months_before(as_of, fixed.RECENT_MONTHS), F.lit("Z")).otherwise(F.lit("N"))


def was_inspected(visited: Column) -> Column:
    """False for the date that stands for "not inspected yet"."""
    return visited != F.lit(fixed.UNINSPECTED_SENTINEL).cast("timestamp_ntz")


def stage_restaurant(clean: DataFrame, as_of: AsOf = None, averages: DataFrame | None = None) -> DataFrame:
    """Scored and graded rows of real visits with a building, postal code and violation.

    The visit mean covers rows that the filter drops; pass stored ``averages``
    on large tables, see :func:`attach_visit_score`.  No ``distinct`` follows:
    ``inspection_order_id`` is unique in ``clean`` and the join adds no rows.
    """
    dated = real_visits(attach_visit_score(clean, averages)).withColumn("grade_date", F.coalesce("grade_date", "inspection_date"))
    return graded(dated, as_of).select(
        "inspection_order_id", "camis", "dba", "dba_lower", "boro", "building", "street",
        "zipcode", "inspection_date", "critical_flag", "record_date", "bin", "bbl", "nta",
        "cuisine_description", "action", "violation_code", "violation_description", "score",
        "computed_score", "grade", "computed_grade", "grade_date", "latitude", "longitude", "extract_date",
    )


def real_visits(scored: DataFrame) -> DataFrame:
    """Rows of visits that took place, with a building, postal code and violation."""
    return scored.where(was_inspected(F.col("inspection_date"))).dropna(subset=["bin", "zipcode", "violation_code"])


def graded(scored: DataFrame, as_of: AsOf = None) -> DataFrame:
    """With the recency flag as ``grade`` and the grade of the visit's mean as ``computed_grade``."""
    flag, grade = recency_flag(F.col("inspection_date"), as_of), grade_of(F.col("computed_score"))
    return scored.withColumns({"grade": flag, "computed_grade": grade})


def building_coordinates(clean: DataFrame) -> DataFrame:
    """Distinct known coordinates of each building."""
    located = clean.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return located.select("bin", "latitude", "longitude").distinct()


def largest_coordinates(clean: DataFrame) -> DataFrame:
    """One pair of known coordinates of each building: the largest latitude and, with it, the largest longitude."""
    pair = F.max(F.struct(*[F.col(c).cast("double").alias(c) for c in ("latitude", "longitude")])).alias("pair")
    largest = building_coordinates(clean).where(F.col("bin").isNotNull()).groupBy("bin").agg(pair)
    return largest.select("bin", F.col("pair.latitude").alias("_latitude"), F.col("pair.longitude").alias("_longitude"))


def fill_coordinates(rats: DataFrame, coordinates: DataFrame) -> DataFrame:
    """A row that lacks a coordinate takes both from its building, where the building is known."""
    lacks = F.col("latitude").isNull() | F.col("longitude").isNull()
    filled = {c: F.when(lacks, F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in ("latitude", "longitude")}
    return rats.join(coordinates, "bin", "left").withColumns(filled).select(*rats.columns)


def stage_rat(clean: DataFrame, as_of: AsOf = None, geocode: str = "exact", coordinates: DataFrame | None = None) -> DataFrame:
    """Dated inspections of known buildings, without repeats.

    With ``geocode="exact"`` coordinates are filled from rows that match on
    those very coordinates, so a row with none never matches and a row that
    matches keeps its own: the fill changes nothing and is left out.  With
    ``"by_bin"`` they are filled from ``coordinates``, the (stored)
    :func:`largest_coordinates` of the other feed's buildings.  The ``distinct``
    stays, because work orders ``"7"`` and ``"07"`` become the same number.
    """
    if geocode not in ("exact", "by_bin"):
        raise ValueError(f"geocode is exact or by_bin, not {geocode}")
    if geocode == "by_bin":
        clean = fill_coordinates(clean, coordinates)
    return (
        clean.where(between_days(F.col("inspection_date"), fixed.EARLIEST_INSPECTION, as_of))
        .where(F.col("bin").isNotNull())
        .withColumn("extract_date", as_of_date(as_of))
        .distinct()
    )


def mart_restaurant(stage: DataFrame) -> DataFrame:
    return stage.where(F.col("inspection_date").isNotNull())


def mart_rat(stage: DataFrame) -> DataFrame:
    return stage.dropna(subset=["inspection_date", "bin"])
