"""Compose the layers; tables read more than once are written first."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields

from pyspark import InheritableThread
from pyspark.sql import DataFrame, functions as F

from sitegrade import fixed_values as fixed
from sitegrade.functions.dates import AsOf, months_before, resolved, within_trailing_months
from sitegrade.operators import building_risk, clean, combined_risk, restaurant_risk, stage
from sitegrade.operators.dedup import repeated_words
from sitegrade.sources.sinks import TableStore


@dataclass(frozen=True)
class Tables:
    """Every model of a run, each a scan of its written table."""

    clean_restaurant: DataFrame
    clean_rat: DataFrame
    stage_restaurant: DataFrame
    stage_rat: DataFrame
    mart_restaurant: DataFrame
    mart_rat: DataFrame
    restaurant_risk: DataFrame
    rat_risk: DataFrame
    risk_model: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def serving(self) -> dict[str, DataFrame]:
        return {
            "mart_rat_inspection": self.mart_rat,
            "mart_rat_risk_model": self.risk_model,
            "mart_restaurant_inspection": self.mart_restaurant,
        }


def side_by_side(parts: Sequence[Callable[[], object]]) -> list:
    """Results of functions that submit jobs of their own, run at the same time.

    The threads inherit the caller's job group, pool and cancellation.
    """
    results: list = [None] * len(parts)
    errors: list[BaseException] = []

    def call(at: int) -> None:
        try:
            results[at] = parts[at]()
        except BaseException as error:
            errors.append(error)

    threads = [InheritableThread(target=call, args=(at,)) for at in range(len(parts))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if errors:
        raise errors[0]
    return results


def run(
    raw_restaurant: DataFrame, raw_rat: DataFrame, store: TableStore, as_of: AsOf = None, strict: bool = True
) -> Tables:
    """Full refresh of all nine models.

    Each is written once and read back, so no model is computed twice and each
    stage of the run restarts from stored tables.  The two half-year summaries,
    read three times each, are stored as well.  The two feeds meet only in the
    last model, so their jobs are submitted side by side.  The as-of day is
    settled once, so a run over midnight does not mix two days.
    """
    day = resolved(raw_rat.sparkSession, as_of)
    restaurants, rats = side_by_side(
        [lambda: _restaurant_side(raw_restaurant, store, day, strict), lambda: _rat_side(raw_rat, store, day, strict)]
    )
    models = {**restaurants, **rats}
    model = combined_risk.risk_model(models["restaurant_risk"], models["rat_risk"])
    return Tables(**models, risk_model=store.save(model, "mart", "mart_rat_risk_model"))


def latest_restaurant_columns(raw: DataFrame, store: TableStore, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """``columns`` of the deduplicated restaurant rows, for summaries that need few of them.

    ``raw`` is evaluated twice: the narrow rows are stored, then the whole rows of
    keys that may be repeated, mostly few.
    """
    narrow = store.save(clean.narrow_restaurant_rows(raw, columns, strict), "raw", "restaurant_columns")
    words = store.save(repeated_words(narrow, clean.KEY_HASH), "raw", "repeated_restaurant_keys")
    repeated = store.save(clean.repeated_restaurant_rows(raw, words), "raw", "repeated_restaurant_inspection")
    return clean.latest_restaurant_columns(narrow, words, repeated, columns, strict)


def _restaurant_side(raw: DataFrame, store: TableStore, as_of: AsOf, strict: bool) -> dict[str, DataFrame]:
    cleaned = store.save(clean.clean_restaurant(raw, as_of, strict), "clean", "clean_restaurant_inspection")
    staged = store.save(staged_restaurant(cleaned, store, as_of), "stage", "stg_restaurant_inspection")
    mart = save_by_month(stage.mart_restaurant(staged), store, "mart_restaurant_inspection", "inspection_order_id")
    scores = restaurant_scores(mart, store, as_of)
    return {
        "clean_restaurant": cleaned,
        "stage_restaurant": staged,
        "mart_restaurant": mart.drop(MONTH),
        "restaurant_risk": store.save(scores, "mart", "mart_restaurant_risk_analysis"),
    }


def _rat_side(raw: DataFrame, store: TableStore, as_of: AsOf, strict: bool) -> dict[str, DataFrame]:
    cleaned = store.save(clean.clean_rat(raw, as_of, strict), "clean", "clean_rat_inspection")
    staged = store.save(stage.stage_rat(cleaned, as_of), "stage", "stg_rat_inspection")
    mart = save_by_month(stage.mart_rat(staged), store, "mart_rat_inspection", "work_order_id", "job_id")
    scores = rat_scores(mart, store, as_of)
    return {
        "clean_rat": cleaned,
        "stage_rat": staged,
        "mart_rat": mart.drop(MONTH),
        "rat_risk": store.save(scores, "mart", "mart_rat_inspection_analysis"),
    }


MONTH = "inspection_month"


def save_by_month(mart: DataFrame, store: TableStore, table: str, *spread: str) -> DataFrame:
    """A mart stored with a folder for each month of ``inspection_date``, and the month as an extra column."""
    month = F.trunc(F.col("inspection_date").cast("date"), "month")
    return store.save(mart.withColumn(MONTH, month), "mart", table, MONTH, spread)


def recent_rows(mart: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Rows of the trailing half year.

    Spark's parquet reader skips nothing by a zone-less timestamp, so a mart
    stored by month is also filtered by it: older folders are not even listed.
    """
    recent = mart.where(within_trailing_months(F.col("inspection_date"), as_of, fixed.TRAILING_MONTHS))
    if MONTH not in mart.columns:
        return recent
    first = F.trunc(months_before(as_of, fixed.TRAILING_MONTHS).cast("date"), "month")
    return recent.where(F.col(MONTH) >= first).drop(MONTH)


def staged_restaurant(cleaned: DataFrame, store: TableStore, as_of: AsOf = None) -> DataFrame:
    """The staged rows over stored visit means; ``cleaned`` is read twice and should be stored."""
    averages = store.save(stage.visit_avg_score(cleaned), "stage", "visit_avg_score")
    return stage.stage_restaurant(cleaned, as_of, averages)


def restaurant_summary(mart: DataFrame, store: TableStore, as_of: AsOf = None) -> DataFrame:
    """Stored half-year summary per establishment; the visits it needs are read from the mart once."""
    stats = restaurant_risk.restaurant_stats_6m(stored_visits(recent_rows(mart, as_of), store, "_6m"), as_of)
    return store.save(stats, "mart", "restaurant_stats_6m")


def stored_visits(mart: DataFrame, store: TableStore, suffix: str = "", averages: DataFrame | None = None) -> DataFrame:
    """The visits of a mart over their stored site descriptions and maxima, which a hot visit's join needs to be split.

    Rows of a mart without scores get them from ``averages``, the stored means of
    the visits: they join the maxima, one row a visit, and not every violation.
    """
    sites = store.save(restaurant_risk.site_visits(mart), "mart", f"site_visits{suffix}")
    maxima = restaurant_risk.visit_maxima(sites)
    scored = maxima if averages is None else stage.attach_visit_score(maxima, averages)
    maxima = store.save(scored, "mart", f"visit_maxima{suffix}")
    return restaurant_risk.visit_stats(mart, sites, maxima)


def restaurant_scores(mart: DataFrame, store: TableStore, as_of: AsOf = None) -> DataFrame:
    """Scores over the stored summary and stored area scores."""
    stats = restaurant_summary(mart, store, as_of)
    streets = store.save(restaurant_risk.restaurant_street_scores(stats), "mart", "restaurant_street_scores")
    zips = store.save(restaurant_risk.restaurant_zip_scores(stats), "mart", "restaurant_zip_scores")
    return restaurant_risk.restaurant_risk(stats, as_of, streets, zips)


def building_summary(mart: DataFrame, store: TableStore, as_of: AsOf = None) -> DataFrame:
    """Stored half-year summary per building description."""
    return store.save(building_risk.building_stats_6m(recent_rows(mart, as_of), as_of), "mart", "building_stats_6m")


def rat_scores(mart: DataFrame, store: TableStore, as_of: AsOf = None) -> DataFrame:
    """Scores over the stored summary and stored area scores."""
    stats = building_summary(mart, store, as_of)
    streets = store.save(building_risk.rat_street_scores(stats), "mart", "rat_street_scores")
    zips = store.save(building_risk.rat_zip_scores(stats), "mart", "rat_zip_scores")
    return building_risk.rat_risk(stats, as_of, streets, zips)
