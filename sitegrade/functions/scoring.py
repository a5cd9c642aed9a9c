"""Bands, guarded ratios and capped weighted sums."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from sitegrade import fixed_values as fixed
from sitegrade.functions.dates import AsOf, days_since


def _first_match(cases: list[tuple[Column, object]], otherwise) -> Column:
    (condition, value), *rest = cases
    result = F.when(condition, F.lit(value))
    for condition, value in rest:
        result = result.when(condition, F.lit(value))
    return result.otherwise(otherwise)


def band(col: Column, bands: Iterable[tuple[float, object]], otherwise) -> Column:
    """Value of the first band whose upper bound is not exceeded; NULL is in no band."""
    return _first_match(
        [(col.isNotNull() if math.isinf(upper) else col <= upper, value) for upper, value in bands],
        otherwise,
    )


def band_from(col: Column, bands: Iterable[tuple[float, object]], otherwise) -> Column:
    """Value of the first band whose lower bound is reached."""
    return _first_match([(col >= lower, value) for lower, value in bands], otherwise)


def safe_ratio(part: Column, whole: Column) -> Column:
    """NULL instead of an error where the whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def capped_weighted_score(
    terms: Iterable[tuple[Column, float]], extras: Iterable[Column] = (), cap: float = fixed.SCORE_CAP
) -> Column:
    """Sum of weighted terms, a missing term counting 0, cut off at ``cap``.

    There is no floor: a clean record may score below zero.
    """
    total = None
    for col, weight in terms:
        term = F.coalesce(col.cast("double") * F.lit(float(weight)), F.lit(0.0))
        total = term if total is None else total + term
    for extra in extras:
        total = total + extra.cast("double")
    return F.least(F.lit(float(cap)), total)


def grade_of(score: Column) -> Column:
    return F.when(score < fixed.GRADE_FLOOR, F.lit(fixed.GRADE_OTHERWISE)).otherwise(
        band(score, fixed.GRADE_BANDS, F.lit(fixed.GRADE_OTHERWISE))
    )


def _day_penalty(days: Column, bands: list[tuple[int, int]], base: int) -> Column:
    last_bound = bands[-1][0]
    tail = F.least(F.lit(float(fixed.DAY_TAIL_CAP)), (days - last_bound) * fixed.DAY_TAIL_SLOPE)
    return band(days, [(d, float(p)) for d, p in bands], F.lit(float(base)) + tail)


def restaurant_recency_penalty(last_visit: Column, as_of: AsOf) -> Column:
    days = days_since(last_visit, as_of)
    return _day_penalty(days, fixed.RESTAURANT_DAY_BANDS, fixed.RESTAURANT_DAY_BASE)


def building_recency_penalty(last_visit: Column, as_of: AsOf) -> Column:
    days = days_since(last_visit, as_of)
    return F.when(last_visit.isNull(), F.lit(float(fixed.BUILDING_NO_DATE_PENALTY))).otherwise(
        _day_penalty(days, fixed.BUILDING_DAY_BANDS, fixed.BUILDING_DAY_BASE)
    )


def evidence_penalty(inspections: Column, failed: Column, rat_activity: Column) -> Column:
    """Extra points where few inspections stand behind a building's rates."""
    return (
        F.when(inspections == 0, F.lit(fixed.NO_INSPECTION_PENALTY))
        .when((inspections <= 1) & (rat_activity > 0), F.lit(fixed.ONE_INSPECTION_WITH_RATS_PENALTY))
        .when(
            (inspections <= 2) & ((failed > 0) | (rat_activity > 0)),
            F.lit(fixed.TWO_INSPECTIONS_WITH_TROUBLE_PENALTY),
        )
        .otherwise(F.lit(0))
    )


def risk_category(score: Column) -> Column:
    return band_from(score, fixed.RISK_BANDS, F.lit(fixed.RISK_OTHERWISE))
