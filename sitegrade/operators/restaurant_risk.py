"""Establishment, street and postal-area scores from restaurant violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitegrade import fixed_values as fixed
from sitegrade.functions.dates import AsOf, days_since, within_trailing_months
from sitegrade.functions.scoring import capped_weighted_score, grade_of, restaurant_recency_penalty, safe_ratio

VISIT_VARIANT_KEYS = ["camis", "dba", "bin", "inspection_date"]
SITE_KEYS = [
    "camis", "dba", "boro", "building", "street", "zipcode", "bin", "bbl", "nta",
    "cuisine_description",
]
_GRADES = ("A", "B", "C")


def _count_codes(codes: list[str]) -> Column:
    return F.count_if(F.col("violation_code").isin(codes))


def violation_counts(mart: DataFrame) -> DataFrame:
    """Severe and moderate violations of each visit variant, counted in one pass."""
    return mart.groupBy(*VISIT_VARIANT_KEYS).agg(
        _count_codes(fixed.SEVERE_CODES).alias("severe_vio_count"),
        _count_codes(fixed.MODERATE_CODES).alias("moderate_vio_count"),
    )


def severe_violations(mart: DataFrame) -> DataFrame:
    return violation_counts(mart).drop("moderate_vio_count")


def moderate_violations(mart: DataFrame) -> DataFrame:
    return violation_counts(mart).drop("severe_vio_count")


def site_visits(mart: DataFrame) -> DataFrame:
    """All that the half-year summary needs of the mart, one row per visit and site description.

    Grades are single letters; their maximum is taken over character codes,
    because Spark aggregates numbers by hashing but text only after a sort.
    Rows without an establishment belong to no visit.  A mart without scores
    gives sites without them, see :func:`visit_stats`.
    """
    known = mart.where(F.col("camis").isNotNull() & F.col("inspection_date").isNotNull())
    scores = [F.avg("computed_score").alias("avg_computed_score"), F.max(F.ascii("computed_grade")).alias("_grade_code")]
    return known.groupBy(*SITE_KEYS, "inspection_date").agg(
        _count_codes(fixed.SEVERE_CODES).alias("_severe"),
        _count_codes(fixed.MODERATE_CODES).alias("_moderate"),
        F.count_if(F.col("critical_flag") == "CRITICAL").alias("_critical_rows"),
        *(scores if "computed_score" in mart.columns else []),
        F.max("latitude").alias("latitude"),
        F.max("longitude").alias("longitude"),
        F.max("extract_date").alias("extract_date"),
    )


def visit_maxima(sites: DataFrame) -> DataFrame:
    """Per visit the worst counts of its variants, and the number of these.

    A variant's counts are the sums over its site descriptions.
    """
    variants = sites.groupBy(*VISIT_VARIANT_KEYS).agg(
        F.sum("_severe").alias("severe_vio_count"), F.sum("_moderate").alias("moderate_vio_count")
    )
    return variants.groupBy("camis", "inspection_date").agg(
        F.max("severe_vio_count").alias("severe_vio_count"),
        F.max("moderate_vio_count").alias("moderate_vio_count"),
        F.count(F.lit(1)).alias("_variants"),
    )


def visit_stats(mart: DataFrame, sites: DataFrame | None = None, maxima: DataFrame | None = None) -> DataFrame:
    """One row per visit and site description, with the visit's worst variant counts.

    A visit recorded under k variants (name or building spelled differently)
    pairs every row with k severe and k moderate counts.  Instead of producing
    those k * k copies, the maxima and k are aggregated per visit first; only
    ``total_critical_count`` depends on the copies and is multiplied.

    The mart is only read for ``sites``, its :func:`site_visits`; stored, they
    make one scan of the mart.  ``maxima`` are the stored :func:`visit_maxima` of
    the sites.  Only then does the join shuffle both sides, and a hot visit is
    split (adaptive skew join); maxima that are not stored already have the
    join's partitioning, and their hot partition stays whole.

    Every row of a visit has the visit's mean.  So ``sites`` of a mart without
    scores take it from ``maxima`` that have it as ``computed_score``, and its
    grade is found once a visit and site.
    """
    described = site_visits(mart) if sites is None else sites
    visits = visit_maxima(described) if maxima is None else maxima
    own = "avg_computed_score" in described.columns
    return described.join(visits, ["camis", "inspection_date"]).select(
        *SITE_KEYS,
        "inspection_date",
        "severe_vio_count",
        "moderate_vio_count",
        (F.col("_critical_rows") * F.col("_variants") * F.col("_variants")).alias("total_critical_count"),
        "avg_computed_score" if own else F.col("computed_score").alias("avg_computed_score"),
        (F.char("_grade_code") if own else grade_of(F.col("computed_score"))).alias("computed_grade"),
        "latitude",
        "longitude",
        "extract_date",
    )


def restaurant_stats_6m(visits: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Each establishment over the trailing half year, visits weighing alike.

    The date test reaches the scan below :func:`visit_stats`, because the date
    is one of its grouping and join keys.
    """
    def per_visit(total: Column) -> Column:
        return total.cast("double") / F.count(F.lit(1))

    recent = visits.where(within_trailing_months(F.col("inspection_date"), as_of, fixed.TRAILING_MONTHS))
    return recent.groupBy(*SITE_KEYS).agg(
        F.max("inspection_date").alias("most_recent_inspection_date"),
        F.sum("severe_vio_count").alias("total_severe_vio_count_6m"),
        per_visit(F.sum("severe_vio_count")).alias("avg_severe_vio_count_6m"),
        F.sum("moderate_vio_count").alias("total_moderate_vio_count_6m"),
        per_visit(F.sum("moderate_vio_count")).alias("avg_moderate_vio_count_6m"),
        per_visit(F.sum("avg_computed_score")).alias("avg_score_orig_6m"),
        *[F.count_if(F.col("computed_grade") == g).alias(f"grade_{g}_count_6m") for g in _GRADES],
        F.max("longitude").alias("longitude"),
        F.max("latitude").alias("latitude"),
        F.max("extract_date").alias("extract_date"),
    )


def area_stats(stats: DataFrame, key: str, prefix: str) -> DataFrame:
    """Establishments rolled up to one area column, names prefixed by its kind.

    Coordinates are averaged as decimals, so their means do not depend on the
    order of the rows.
    """
    def mean(name: str, of: str) -> Column:
        return safe_ratio(F.sum(name), F.count(F.lit(1) if of == "*" else F.col(of)))

    return stats.groupBy(key).agg(
        mean("avg_severe_vio_count_6m", of="camis").alias(f"{prefix}_avg_severe_vio_count_6m"),
        mean("avg_moderate_vio_count_6m", of="camis").alias(f"{prefix}_avg_moderate_vio_count_6m"),
        mean("avg_score_orig_6m", of="*").alias(f"{prefix}_avg_score"),
        *[F.sum(f"grade_{g}_count_6m").alias(f"{prefix}_grade_{g}_count") for g in _GRADES],
        F.avg("latitude").cast("double").alias(f"{prefix}_latitude"),
        F.avg("longitude").cast("double").alias(f"{prefix}_longitude"),
    )


def restaurant_street_stats(stats: DataFrame) -> DataFrame:
    return area_stats(stats, "street", "street")


def restaurant_zip_stats(stats: DataFrame) -> DataFrame:
    return area_stats(stats, "zipcode", "zip")


def _over_base(score: str) -> Column:
    return F.col(score) - fixed.BASE_INSPECTION_SCORE


def restaurant_score(as_of: AsOf) -> Column:
    """Risk score of a :func:`restaurant_stats_6m` row."""
    weights = fixed.RESTAURANT_WEIGHTS
    return capped_weighted_score(
        [
            (F.col("avg_severe_vio_count_6m"), weights["severe"]),
            (F.col("avg_moderate_vio_count_6m"), weights["moderate"]),
            (_over_base("avg_score_orig_6m"), weights["score_over_base"]),
            (F.col("grade_C_count_6m"), weights["grade_c"]),
            (F.col("grade_B_count_6m"), weights["grade_b"]),
            (F.col("grade_A_count_6m"), weights["grade_a"]),
        ],
        extras=[restaurant_recency_penalty(F.col("most_recent_inspection_date"), as_of)],
    )


def restaurant_area_score(prefix: str) -> Column:
    """Risk score of an :func:`area_stats` row."""
    weights = fixed.RESTAURANT_AREA_WEIGHTS
    counts = {g: F.col(f"{prefix}_grade_{g}_count") for g in _GRADES}
    graded = counts["A"] + counts["B"] + counts["C"]
    return capped_weighted_score(
        [
            (F.col(f"{prefix}_avg_severe_vio_count_6m"), weights["severe"]),
            (F.col(f"{prefix}_avg_moderate_vio_count_6m"), weights["moderate"]),
            (_over_base(f"{prefix}_avg_score"), weights["score_over_base"]),
            (safe_ratio(counts["C"], graded), weights["share_c"]),
            (safe_ratio(counts["B"], graded), weights["share_b"]),
            (safe_ratio(counts["A"], graded), weights["share_a"]),
        ]
    )


def restaurant_street_scores(stats: DataFrame) -> DataFrame:
    return restaurant_street_stats(stats).select(
        "street", restaurant_area_score("street").alias("street_risk_score")
    )


def restaurant_zip_scores(stats: DataFrame) -> DataFrame:
    return restaurant_zip_stats(stats).select("zipcode", restaurant_area_score("zip").alias("zip_risk_score"))


def restaurant_risk(
    stats: DataFrame, as_of: AsOf = None, streets: DataFrame | None = None, zips: DataFrame | None = None
) -> DataFrame:
    """Three scores per establishment from its :func:`restaurant_stats_6m` row.

    ``stats`` is read three times (rows, streets, areas): pass a materialised
    table, and the stored street and postal scores with it.  Area sizes are
    unknown, so the joins carry no broadcast hint; Spark broadcasts a stored
    roll-up whose size it has measured to be small and otherwise sort-merges,
    splitting a popular or missing area.  An establishment without a street or
    postal code matches none and its area terms count 0.
    """
    streets = restaurant_street_scores(stats) if streets is None else streets
    zips = restaurant_zip_scores(stats) if zips is None else zips
    return (
        stats.join(streets.where(F.col("street").isNotNull()), "street", "left")
        .join(zips.where(F.col("zipcode").isNotNull()), "zipcode", "left")
        .select(
            *SITE_KEYS,
            "most_recent_inspection_date",
            "avg_severe_vio_count_6m",
            "avg_moderate_vio_count_6m",
            "avg_score_orig_6m",
            *[f"grade_{g}_count_6m" for g in _GRADES],
            days_since(F.col("most_recent_inspection_date"), as_of)
            .cast("bigint")
            .alias("days_since_inspection"),
            restaurant_score(as_of).alias("restaurant_risk_score"),
            F.coalesce("street_risk_score", F.lit(0.0)).alias("street_risk_score"),
            F.coalesce("zip_risk_score", F.lit(0.0)).alias("zip_risk_score"),
            "longitude",
            "latitude",
            "extract_date",
        )
    )
