"""Building, street and postal-area scores from rat inspections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitegrade import fixed_values as fixed
from sitegrade.functions.dates import AsOf, as_of_date, within_trailing_months
from sitegrade.functions.scoring import (
    band,
    building_recency_penalty,
    capped_weighted_score,
    evidence_penalty,
    safe_ratio,
)

BUILDING_KEYS = [
    "bin", "street", "zipcode", "bbl", "boro_code", "block", "lot", "house_number", "borough", "nta",
]


def outcome_counts() -> dict[str, Column]:
    """``FAILED`` is counted here; the failure *rate* is of another outcome."""
    result = F.col("result")
    return {
        "total_inspections_6m": F.count(F.lit(1)),
        "failed_inspections_6m": F.count_if(result == "FAILED"),
        "passed_inspections_6m": F.count_if(result == "PASSED"),
        "rat_activities_6m": F.count_if(result == "RAT ACTIVITY"),
    }


def inspection_type_counts() -> dict[str, Column]:
    kind = F.col("inspection_type")
    return {
        f"{name}_inspections_6m": F.count_if(kind.ilike(f"%{name}%"))
        for name in ("initial", "bait", "compliance")
    }


def outcome_rates() -> dict[str, Column]:
    def share(outcome: str) -> Column:
        return safe_ratio(F.count_if(F.col("result") == outcome), F.count(F.lit(1)))

    return {
        "failure_rate_6m": share("FAILED FOR OTHER R"),
        "rat_activity_rate_6m": share("RAT ACTIVITY"),
    }


def building_stats_6m(mart: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Each building description over the trailing half year."""
    measures = {
        "most_recent_inspection_date": F.max("inspection_date"),
        "most_recent_approved_date": F.max("approved_date"),
        **outcome_counts(),
        **inspection_type_counts(),
        **outcome_rates(),
        "latitude": F.max("latitude"),
        "longitude": F.max("longitude"),
    }
    return (
        mart.where(within_trailing_months(F.col("inspection_date"), as_of, fixed.TRAILING_MONTHS))
        .groupBy(*BUILDING_KEYS)
        .agg(*[col.alias(name) for name, col in measures.items()])
        .withColumn("extract_date", as_of_date(as_of))
    )


def area_stats(stats: DataFrame, key: str, prefix: str, buildings: str) -> DataFrame:
    """Buildings rolled up to one area column.

    Some measures are means of building rates, the others ratios of area sums.
    """
    inspections = F.sum("total_inspections_6m")
    ratios = {
        "failure_rate": "failed_inspections_6m",
        "rat_activity_rate": "rat_activities_6m",
        "initial_rate": "initial_inspections_6m",
        "bait_rate": "bait_inspections_6m",
        "compliance_rate": "compliance_inspections_6m",
    }
    return stats.groupBy(key).agg(
        F.countDistinct("bin").alias(buildings),
        F.avg("failure_rate_6m").alias(f"{prefix}_avg_failure_rate"),
        F.avg("rat_activity_rate_6m").alias(f"{prefix}_avg_rat_activity_rate"),
        *[safe_ratio(F.sum(of), inspections).alias(f"{prefix}_{name}") for name, of in ratios.items()],
        F.avg("total_inspections_6m").alias(f"{prefix}_avg_inspections"),
        F.avg("latitude").alias(f"{prefix}_latitude"),
        F.avg("longitude").alias(f"{prefix}_longitude"),
    )


def rat_street_stats(stats: DataFrame) -> DataFrame:
    return area_stats(stats, "street", "street", "buildings_on_street")


def rat_zip_stats(stats: DataFrame) -> DataFrame:
    return area_stats(stats, "zipcode", "zip", "buildings_in_zip")


def building_score(as_of: AsOf) -> Column:
    """Risk score of a :func:`building_stats_6m` row."""
    weights = fixed.BUILDING_WEIGHTS
    total = F.col("total_inspections_6m")

    def share(name: str) -> Column:
        return safe_ratio(F.col(f"{name}_inspections_6m"), total)

    return capped_weighted_score(
        [
            (F.col("rat_activity_rate_6m"), weights["rat_activity_rate"]),
            (F.col("failure_rate_6m"), weights["failure_rate"]),
            (share("failed"), weights["failed_share"]),
            (share("initial"), weights["initial_share"]),
            (share("bait"), weights["bait_share"]),
            (share("compliance"), weights["compliance_share"]),
        ],
        extras=[
            building_recency_penalty(F.col("most_recent_inspection_date"), as_of),
            evidence_penalty(total, F.col("failed_inspections_6m"), F.col("rat_activities_6m")),
        ],
    )


def rat_area_score(prefix: str, buildings: str, bands: list[tuple[int, int]]) -> Column:
    """Risk score of an :func:`area_stats` row."""
    terms = [(F.col(f"{prefix}_{name}"), weight) for name, weight in fixed.RAT_AREA_WEIGHTS.items()]
    return capped_weighted_score(terms, extras=[band(F.col(buildings), bands, F.lit(0))])


def rat_street_score() -> Column:
    return rat_area_score("street", "buildings_on_street", fixed.STREET_BUILDING_BANDS)


def rat_zip_score() -> Column:
    return rat_area_score("zip", "buildings_in_zip", fixed.ZIP_BUILDING_BANDS)


def rat_street_scores(stats: DataFrame) -> DataFrame:
    return rat_street_stats(stats).select("street", rat_street_score().alias("street_rr_score"))


def rat_zip_scores(stats: DataFrame) -> DataFrame:
    return rat_zip_stats(stats).select("zipcode", rat_zip_score().alias("zip_rr_score"))


def rat_risk(
    stats: DataFrame, as_of: AsOf = None, streets: DataFrame | None = None, zips: DataFrame | None = None
) -> DataFrame:
    """Three scores per building description from its :func:`building_stats_6m` row.

    Reads ``stats`` three times; stored area scores are joined without a hint
    for the same reason as on the restaurant side.
    """
    streets = rat_street_scores(stats) if streets is None else streets
    zips = rat_zip_scores(stats) if zips is None else zips
    return (
        stats.join(streets.where(F.col("street").isNotNull()), "street", "left")
        .join(zips.where(F.col("zipcode").isNotNull()), "zipcode", "left")
        .select(
            "bin",
            "street",
            "zipcode",
            "latitude",
            "longitude",
            building_score(as_of).alias("bin_rr_score"),
            F.coalesce("street_rr_score", F.lit(0.0)).alias("street_rr_score"),
            F.coalesce("zip_rr_score", F.lit(0.0)).alias("zip_rr_score"),
            "extract_date",
        )
    )
