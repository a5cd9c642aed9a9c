"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, reduce
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parity import TIE_NUDGE, star_feeds
from sitegrade import fixed_values as fixed
from sitegrade.functions import dates, scoring
from sitegrade.functions.casts import to_coordinate, to_double, to_int, to_long, to_timestamp
from sitegrade.functions.keys import hash_key
from sitegrade.operators import building_risk, clean, combined_risk, frames, history, quality, restaurant_risk, rollups, stage, temporal_joins
from sitegrade.plans import incremental, pipeline
from sitegrade.session import configure, scratch_root
from sitegrade.sources.sinks import TableStore, serving_cast, serving_clean
from sitegrade.streaming import latest, windows

AS_OF = star_feeds.AS_OF

# What the scores read of the clean table.
SCORED_COLUMNS = [
    *restaurant_risk.SITE_KEYS, "inspection_date", "critical_flag", "violation_code", "score", "latitude", "longitude", "extract_date",
]


class Layers:
    """The models over one folder of test tables, each built on first use.

    All is lazy except what is read more than once or joined to its own
    aggregate: the raw rows of the restaurant feed where they are deduplicated,
    the deduplicated ones, visit means and maxima and the half-year summaries
    are written to the shared scratch folder first.
    """

    # Full refreshes by session and folder: the checks of one session read the same stored tables.
    refreshed: ClassVar[dict[tuple[str, str], pipeline.Tables]] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    @cached_property
    def store(self) -> TableStore:
        return TableStore(scratch_root(self.spark))

    def table(self, name: str) -> DataFrame:
        return star_feeds.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw_restaurant(self) -> DataFrame:
        return star_feeds.raw_restaurant(self.spark, self.sf_dir)

    @cached_property
    def raw_rat(self) -> DataFrame:
        return star_feeds.raw_rat(self.spark, self.sf_dir)

    @cached_property
    def landed_restaurant(self) -> DataFrame:
        """The raw rows as a stored raw table, for the dedupe, which reads them three times."""
        return self.store.save(self.raw_restaurant, "raw", "restaurant_inspection")

    @cached_property
    def clean_restaurant(self) -> DataFrame:
        return clean.clean_restaurant(self.landed_restaurant, AS_OF)

    @cached_property
    def clean_rat(self) -> DataFrame:
        return clean.clean_rat(self.raw_rat, AS_OF)

    @cached_property
    def stage_restaurant(self) -> DataFrame:
        cleaned = self.store.save(self.clean_restaurant, "clean", "clean_restaurant_inspection")
        return pipeline.staged_restaurant(cleaned, self.store, AS_OF)

    @cached_property
    def stage_rat(self) -> DataFrame:
        return stage.stage_rat(self.clean_rat, AS_OF)

    @cached_property
    def mart_restaurant(self) -> DataFrame:
        return stage.mart_restaurant(self.stage_restaurant)

    @cached_property
    def mart_rat(self) -> DataFrame:
        return stage.mart_rat(self.stage_rat)

    @cached_property
    def visits(self) -> DataFrame:
        cleaned, averages = self.scored_columns
        return pipeline.stored_visits(stage.mart_restaurant(stage.real_visits(cleaned)), self.store, averages=averages)

    @cached_property
    def restaurant_stats(self) -> DataFrame:
        recent = pipeline.recent_rows(self.recent_mart, AS_OF)
        return restaurant_risk.restaurant_stats_6m(pipeline.stored_visits(recent, self.store, "_6m"), AS_OF)

    @cached_property
    def building_stats(self) -> DataFrame:
        return building_risk.building_stats_6m(self.mart_rat, AS_OF)

    def _scored(self, clean_rows: DataFrame, suffix: str = "") -> tuple[DataFrame, DataFrame]:
        cleaned = self.store.save(clean_rows.select(*SCORED_COLUMNS), "clean", f"scored_columns{suffix}")
        return cleaned, self.store.save(stage.visit_avg_score(cleaned), "stage", f"visit_avg_score{suffix}")

    @cached_property
    def scored_columns(self) -> tuple[DataFrame, DataFrame]:
        """The stored clean rows with the columns that scores read, and the stored means of their visits."""
        return self._scored(self.clean_restaurant)

    @cached_property
    def recent_mart(self) -> DataFrame:
        """The mart of the trailing half year with the columns that scores read; older raw rows are read and left out."""
        recent = clean.recent_restaurant_rows(self.raw_restaurant, AS_OF)
        landed = self.store.save(recent, "raw", "recent_restaurant_inspection")
        staged = stage.attach_visit_score(*self._scored(clean.clean_restaurant(landed, AS_OF), "_6m"))
        return stage.mart_restaurant(stage.graded(stage.real_visits(staged), AS_OF))

    @cached_property
    def restaurant_risk(self) -> DataFrame:
        return pipeline.restaurant_scores(self.recent_mart, self.store, AS_OF)

    @cached_property
    def rat_risk(self) -> DataFrame:
        return pipeline.rat_scores(self.mart_rat, self.store, AS_OF)

    @cached_property
    def risk_model(self) -> DataFrame:
        """Both sides store tables on the way, so they are built side by side."""
        return combined_risk.risk_model(*pipeline.side_by_side([lambda: self.restaurant_risk, lambda: self.rat_risk]))

    @property
    def stored(self) -> pipeline.Tables:
        key = self.spark.sparkContext.applicationId, self.sf_dir
        if key not in self.refreshed:
            self.refreshed[key] = pipeline.run(self.landed_restaurant, self.raw_rat, self.store, AS_OF)
        return self.refreshed[key]


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines hand over alike: 6-digit doubles, dates as text."""
    def column(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.DecimalType)):
            col = F.round(col.cast("double") + TIE_NUDGE, 6)
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        return col.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


# ------------------------------------------------------------------- scalars


def _hash_key(layers: Layers) -> DataFrame:
    return layers.raw_restaurant.select(
        *clean.ORDER_KEY_COLUMNS, hash_key(*clean.ORDER_KEY_COLUMNS).alias("inspection_order_id")
    )


def _normalise_case(layers: Layers) -> DataFrame:
    return layers.raw_restaurant.select(
        "dba",
        F.lower("dba").alias("dba_lower"),
        F.upper("boro").alias("boro"),
        F.upper("critical_flag").alias("critical_flag"),
        F.upper("violation_code").alias("violation_code"),
    )


def _typed_casts(layers: Layers) -> DataFrame:
    price = F.col("l_extendedprice").cast("string")
    return layers.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        to_int(price).alias("price_int"),
        to_int(F.concat(F.lit("-"), price)).alias("negative_price_int"),
        to_long(F.concat(F.lit("10000"), F.col("l_orderkey").cast("string"))).alias("long_id"),
        to_double(price).alias("price_double"),
        to_coordinate(F.col("l_discount").cast("string")).cast("string").alias("discount_decimal"),
        to_timestamp(F.col("l_shipdate").cast("string")).alias("shipped_at"),
    )


def _recency_days(layers: Layers) -> DataFrame:
    ordered = F.col("o_orderdate")
    return layers.table("orders").select(
        "o_orderkey",
        dates.days_since(ordered, AS_OF).cast("bigint").alias("days"),
        dates.months_before(AS_OF, fixed.RECENT_MONTHS).alias("one_month_before"),
        dates.months_before(AS_OF, fixed.TRAILING_MONTHS).alias("six_months_before"),
    )


def _safe_ratio(layers: Layers) -> DataFrame:
    def quantity(condition) -> F.Column:
        return F.coalesce(F.sum(F.when(condition, F.col("l_quantity"))), F.lit(0.0))

    ratio = scoring.safe_ratio(
        quantity(F.col("l_returnflag") == "R"), quantity(F.col("l_linestatus") == "F")
    )
    return layers.table("lineitem").groupBy("l_orderkey").agg(ratio.alias("ratio"))


def _capped_sum(layers: Layers) -> DataFrame:
    price = F.col("o_totalprice") / 1000
    known = F.when(F.col("o_custkey") % 7 != 0, price)
    late = F.when(F.col("o_orderstatus") == "F", F.lit(18)).otherwise(F.lit(0))
    score = scoring.capped_weighted_score([(price, 0.2), (known, 0.5), (price - 10, -0.5)], extras=[late])
    return layers.table("orders").select("o_orderkey", score.alias("score"))


# ------------------------------------------------------- filters and measures


def _date_range_filter(layers: Layers) -> DataFrame:
    seen = to_timestamp("inspection_date")
    return layers.raw_rat.select("job_id", seen.alias("inspection_date")).where(
        dates.between_days(F.col("inspection_date"), fixed.EARLIEST_INSPECTION, AS_OF)
    )


def _sentinel_filter(layers: Layers) -> DataFrame:
    typed = clean.type_restaurant_rows(layers.raw_restaurant)
    return typed.where(stage.was_inspected(F.col("inspection_date"))).select(
        "inspection_order_id", "camis", "inspection_date"
    )


def _trailing_window(layers: Layers) -> DataFrame:
    recent = dates.within_trailing_months(F.col("o_orderdate"), AS_OF, fixed.TRAILING_MONTHS)
    return layers.table("orders").where(recent).select("o_orderkey", "o_orderdate")


def _per_bin(layers: Layers, *measure_sets) -> DataFrame:
    # These counts have no window.
    measures = {name.removesuffix("_6m"): col for measures in measure_sets for name, col in measures.items()}
    return layers.clean_rat.groupBy("bin").agg(*[col.alias(name) for name, col in measures.items()])


def _visit_score(layers: Layers) -> DataFrame:
    """The key travels as its 16 bytes, half of its text."""
    key = F.unhex("inspection_order_id").alias("key")
    cleaned = layers.store.save(layers.clean_restaurant.select(key, "camis", "inspection_date", "score"), "clean", "scores")
    averages = layers.store.save(stage.visit_avg_score(cleaned), "stage", "visit_avg_score")
    return stage.attach_visit_score(cleaned, averages).select(
        F.lower(F.hex("key")).alias("inspection_order_id"), "camis", "inspection_date", "score", "computed_score"
    )


# ------------------------------------------------------------ bands and scores


def _grade_bands(layers: Layers) -> DataFrame:
    shifted = F.avg(F.when(F.col("l_orderkey") % 97 != 0, F.col("l_quantity") - 5))
    means = layers.table("lineitem").groupBy("l_orderkey").agg(shifted.alias("mean"))
    return means.withColumn("grade", scoring.grade_of(F.col("mean")))


def _recency_flag(layers: Layers) -> DataFrame:
    return layers.table("orders").select(
        "o_orderkey", stage.recency_flag(F.col("o_orderdate"), AS_OF).alias("grade")
    )


def _recency_penalty(layers: Layers) -> DataFrame:
    return layers.table("orders").select(
        "o_orderkey", scoring.restaurant_recency_penalty(F.col("o_orderdate"), AS_OF).alias("penalty")
    )


def _building_recency_penalty(layers: Layers) -> DataFrame:
    seen = F.when(F.col("o_orderkey") % 211 != 0, F.col("o_orderdate"))
    return layers.table("orders").select(
        "o_orderkey", scoring.building_recency_penalty(seen, AS_OF).alias("penalty")
    )


def _evidence_penalty(layers: Layers) -> DataFrame:
    counts = building_risk.outcome_counts()
    grouped = layers.clean_rat.groupBy("bin", "inspection_date").agg(
        *[col.alias(name) for name, col in counts.items()]
    )
    penalty = scoring.evidence_penalty(
        F.col("total_inspections_6m"), F.col("failed_inspections_6m"), F.col("rat_activities_6m")
    )
    return grouped.select("bin", "inspection_date", penalty.alias("penalty"))


def _restaurant_score(layers: Layers) -> DataFrame:
    score = restaurant_risk.restaurant_score(AS_OF).alias("restaurant_risk_score")
    return layers.restaurant_stats.select(*restaurant_risk.SITE_KEYS, score)


def _restaurant_street_score(layers: Layers) -> DataFrame:
    score = restaurant_risk.restaurant_area_score("street").alias("street_risk_score")
    return restaurant_risk.restaurant_street_stats(layers.restaurant_stats).select("street", score)


def _restaurant_zip_score(layers: Layers) -> DataFrame:
    score = restaurant_risk.restaurant_area_score("zip").alias("zip_risk_score")
    return restaurant_risk.restaurant_zip_stats(layers.restaurant_stats).select("zipcode", score)


def _building_score(layers: Layers) -> DataFrame:
    score = building_risk.building_score(AS_OF).alias("bin_rr_score")
    return layers.building_stats.select(*building_risk.BUILDING_KEYS, score)


def _rat_street_score(layers: Layers) -> DataFrame:
    score = building_risk.rat_street_score().alias("street_rr_score")
    return building_risk.rat_street_stats(layers.building_stats).select("street", score)


def _rat_zip_score(layers: Layers) -> DataFrame:
    score = building_risk.rat_zip_score().alias("zip_rr_score")
    return building_risk.rat_zip_stats(layers.building_stats).select("zipcode", score)


# ------------------------------------------------------------ joins on time


def _visits(layers: Layers) -> DataFrame:
    real = layers.clean_restaurant.where(stage.was_inspected(F.col("inspection_date")))
    return layers.store.save(real.select("camis", "bin", "zipcode", "inspection_date").distinct(), "stage", "visits")


def _rat_state_at_visit(layers: Layers, **which) -> DataFrame:
    return temporal_joins.as_of_join(
        _visits(layers), layers.clean_rat, layers.store, ["bin"], "inspection_date", "inspection_date",
        ["work_order_id", "result"], ["approved_date"], prefix="rat_", **which,
    )


def _rat_findings_near_visits(layers: Layers) -> DataFrame:
    findings = layers.clean_rat.where(F.col("result") == "RAT ACTIVITY")
    return temporal_joins.interval_join(
        _visits(layers), findings, layers.store, ["zipcode"], "inspection_date", "inspection_date",
        ["work_order_id", "bin", "street"], before=dt.timedelta(days=90), prefix="rat_",
    )


# ------------------------------------------ histories, frames and subtotals

DESCRIPTION = ["dba", "boro", "building", "street", "zipcode", "cuisine_description"]
PLACES = ["boro", "zipcode", "street", "cuisine_description"]


def _described(layers: Layers) -> DataFrame:
    real = layers.clean_restaurant.where(stage.was_inspected(F.col("inspection_date")))
    return real.select("camis", "inspection_date", *DESCRIPTION)


def _establishment_history(layers: Layers) -> DataFrame:
    seen = history.observations(_described(layers), ["camis"], "inspection_date", DESCRIPTION)
    return history.history(seen, layers.store, ["camis"], "inspection_date", DESCRIPTION)


def _merged_history(layers: Layers) -> DataFrame:
    """The later half of the rows first, so the others come late and split stretches."""
    rows = layers.store.save(_described(layers), "stage", "described")
    late = F.col("inspection_date") < F.lit("1998-04-01").cast("timestamp_ntz")
    for part in (~late, late):
        merged = history.merge_history(rows.where(part), layers.store, ["camis"], "inspection_date", DESCRIPTION, "establishments")
    return merged


def _trailing_visit_scores(layers: Layers) -> DataFrame:
    measures = {"rows_6m": F.count(F.lit(1)), "scored_6m": F.count("score"), "score_6m": F.sum("score")}
    real = layers.clean_restaurant.where(stage.was_inspected(F.col("inspection_date"))).select("camis", "inspection_date", "score")
    return frames.trailing_sums(real, layers.store, ["camis"], "inspection_date", fixed.TRAILING_MONTHS, measures)


def _area_percentiles(layers: Layers) -> DataFrame:
    real = layers.clean_restaurant.where(stage.was_inspected(F.col("inspection_date")))
    visits = real.groupBy("camis", "zipcode", "inspection_date").agg(F.sum("score").alias("score"))
    return frames.percent_ranks(visits, layers.store, ["zipcode"], "score")


def _place_subtotals(layers: Layers, sets: list[list[str]]) -> DataFrame:
    """Most rows are counted by their place and building alone, so only these columns of them are stored."""
    latest = pipeline.latest_restaurant_columns(layers.raw_restaurant, layers.store, [*PLACES, "bin"])
    return rollups.grouping_sets(latest, PLACES, sets, "bin", "violations", "buildings")


def _sketched_buildings(layers: Layers) -> DataFrame:
    """Buildings inspected in the half year up to each month, by street: counted, and estimated from stored monthly sketches."""
    seen = layers.clean_rat.select("street", "zipcode", "bin", F.trunc(F.col("inspection_date").cast("date"), "month").alias("month"))
    seen = layers.store.save(seen.where(F.col("zipcode").isNotNull() & F.col("bin").isNotNull()), "stage", "seen_buildings")
    sketches = layers.store.save(rollups.distinct_sketches(seen, ["zipcode", "month"], "bin"), "mart", "building_sketches")
    estimates = rollups.trailing_estimates(sketches, ["zipcode"], "month", fixed.TRAILING_MONTHS)
    sent = seen.distinct().withColumn("_for", F.explode(F.transform(F.sequence(F.lit(0), F.lit(fixed.TRAILING_MONTHS - 1)), lambda k: F.add_months("month", k))))
    exact = sent.groupBy("zipcode", F.col("_for").alias("month")).agg(F.count_distinct("bin").alias("buildings"))
    close = F.abs(F.col("estimate") - F.col("buildings")) <= F.greatest(F.lit(1.0), 4 * rollups.relative_error() * F.col("buildings"))
    return exact.join(estimates, ["zipcode", "month"]).select("zipcode", "month", "buildings", close.alias("estimate_is_close"))


# ------------------------------------------------------- batches of the feeds


def _incremental(layers: Layers) -> pipeline.Tables:
    """All rows of both feeds in two batches: those recorded until the year's end, and the others."""
    early = [F.col("record_date") < "2001", F.coalesce(F.col("approved_date") < "2001", F.lit(False))]
    feeds = layers.raw_restaurant, layers.raw_rat
    incremental.update(*(raw.where(part) for raw, part in zip(feeds, early)), layers.store, AS_OF)
    return incremental.update(*(raw.where(~part) for raw, part in zip(feeds, early)), layers.store, AS_OF)


# ------------------------------------------------------------------- streams


def _event_files(layers: Layers) -> str:
    """As a pattern: a stream takes a folder or a pattern, and the table may be one file."""
    return f"{layers.sf_dir.rstrip('/')}/event[s].parquet"


def _event_windows(layers: Layers) -> DataFrame:
    path, folder = _event_files(layers), scratch_root(layers.spark)
    closed, _ = windows.run(
        layers.spark, path, layers.table("events").schema, f"{folder}/closed", f"{folder}/state", at="ts", width="1 day", delay="2 days",
        ids=["event_id"], keys=["event_type"], measures={"events": F.count(F.lit(1)), "total": F.sum("value")},
    )
    return closed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _streamed_work_orders(layers: Layers) -> DataFrame:
    folder, key = scratch_root(layers.spark), "job_ticket_or_work_order_id"
    events = layers.spark.readStream.schema(layers.table("events").schema).parquet(_event_files(layers))
    raw = layers.spark.sql(star_feeds.RAW_RAT_SQL, events=events)
    dated = raw.withColumns({c: to_timestamp(c) for c in ("inspection_date", "approved_date")})
    rows = dated.select(key, "inspection_date", "approved_date", *clean.RAT_TIE_BREAK)
    return latest.run(
        layers.spark, rows, [key], ["inspection_date", "approved_date"], clean.RAT_TIE_BREAK, f"{folder}/news", f"{folder}/state", dt.timedelta(days=30)
    )


# -------------------------------------------------------------- sinks, checks


def _serving_clean(layers: Layers) -> DataFrame:
    """Blank text and zoned timestamps, as a feed may deliver them, made loadable."""
    delivered = layers.raw_restaurant.select(
        "camis",
        F.coalesce("street", F.lit("")).alias("street"),
        F.coalesce("violation_code", F.lit("")).alias("violation_code"),
        F.coalesce("grade", F.lit("")).alias("grade"),
        to_timestamp("record_date").cast("timestamp").alias("record_date"),
    )
    return serving_clean(delivered)


def _checked_tables(layers: Layers) -> dict[str, DataFrame]:
    return {"raw_restaurant": layers.raw_restaurant, "raw_rat": layers.raw_rat, **layers.stored.as_dict()}


def _checks(layers: Layers, kind: str) -> DataFrame:
    """All checks of a kind, over all tables that have any."""
    chosen = {name: {kind: kinds[kind]} for name, kinds in fixed.DATA_CHECKS.items() if kind in kinds}
    return quality.check_tables(_checked_tables(layers), chosen)


def _stage_rat_by_bin(layers: Layers) -> DataFrame:
    coordinates = layers.store.save(stage.largest_coordinates(layers.clean_restaurant), "stage", "building_coordinates")
    return stage.stage_rat(layers.clean_rat, AS_OF, "by_bin", coordinates)


def _freshness(layers: Layers) -> DataFrame:
    reports = [
        quality.freshness(layers.clean_restaurant, "clean_restaurant", as_of=AS_OF),
        quality.freshness(layers.clean_rat, "clean_rat", as_of=AS_OF),
        quality.freshness(layers.clean_rat, "clean_rat", "inspection_date", AS_OF),
        quality.freshness(layers.clean_rat, "clean_rat", "approved_date", AS_OF),
        quality.freshness(layers.table("orders"), "orders", "o_orderdate", AS_OF),
        quality.freshness(layers.table("events"), "events", "ts", AS_OF),
    ]
    return reduce(DataFrame.unionByName, reports)


def _report(layers: Layers) -> DataFrame:
    return quality.check_tables(_checked_tables(layers))


_QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    # models
    "clean_restaurant": lambda x: x.clean_restaurant,
    "clean_rat": lambda x: x.clean_rat,
    "stage_restaurant": lambda x: x.stage_restaurant,
    "stage_rat": lambda x: x.stage_rat,
    "stage_rat_by_bin": _stage_rat_by_bin,
    "mart_restaurant": lambda x: serving_cast(x.mart_restaurant, "mart_restaurant_inspection"),
    "mart_rat": lambda x: serving_cast(x.mart_rat, "mart_rat_inspection"),
    "restaurant_risk": lambda x: x.restaurant_risk,
    "rat_risk": lambda x: x.rat_risk,
    "risk_model": lambda x: x.risk_model,
    # steps of the models
    "dedup_by_hash_key": lambda x: clean.latest_restaurant_rows(clean.type_restaurant_rows(x.landed_restaurant)),
    "dedup_latest_work_order": lambda x: clean.latest_work_orders(x.raw_rat),
    "visit_avg_score": lambda x: stage.visit_avg_score(x.clean_restaurant),
    "attach_visit_score": _visit_score,
    "building_coordinates": lambda x: stage.building_coordinates(x.clean_restaurant),
    "severe_violations": lambda x: restaurant_risk.severe_violations(x.mart_restaurant),
    "moderate_violations": lambda x: restaurant_risk.moderate_violations(x.mart_restaurant),
    "visit_stats": lambda x: x.visits,
    "restaurant_stats_6m": lambda x: x.restaurant_stats,
    "restaurant_street_stats": lambda x: restaurant_risk.restaurant_street_stats(x.restaurant_stats),
    "restaurant_zip_stats": lambda x: restaurant_risk.restaurant_zip_stats(x.restaurant_stats),
    "building_stats_6m": lambda x: x.building_stats,
    "rat_street_stats": lambda x: building_risk.rat_street_stats(x.building_stats),
    "rat_zip_stats": lambda x: building_risk.rat_zip_stats(x.building_stats),
    "serving_clean": _serving_clean,
    # scalars
    "hash_key": _hash_key,
    "normalise_case": _normalise_case,
    "typed_casts": _typed_casts,
    "recency_days": _recency_days,
    "safe_ratio": _safe_ratio,
    "capped_sum": _capped_sum,
    # filters and measures
    "date_range_filter": _date_range_filter,
    "sentinel_filter": _sentinel_filter,
    "trailing_window": _trailing_window,
    "inspection_type_counts": lambda x: _per_bin(x, building_risk.inspection_type_counts()),
    "outcome_counts": lambda x: _per_bin(x, building_risk.outcome_counts(), building_risk.outcome_rates()),
    # whole tables in presentation order
    "top_risk_restaurants": lambda x: combined_risk.ranked(
        x.restaurant_risk, "restaurant_risk_score", *restaurant_risk.SITE_KEYS
    ),
    "top_risk_buildings": lambda x: combined_risk.ranked(
        x.rat_risk, "bin_rr_score", "bin", "street", "zipcode", "latitude", "longitude"
    ),
    # bands and scores
    "grade_bands": _grade_bands,
    "recency_flag": _recency_flag,
    "recency_penalty": _recency_penalty,
    "restaurant_score": _restaurant_score,
    "restaurant_street_score": _restaurant_street_score,
    "restaurant_zip_score": _restaurant_zip_score,
    "building_recency_penalty": _building_recency_penalty,
    "evidence_penalty": _evidence_penalty,
    "building_score": _building_score,
    "rat_street_score": _rat_street_score,
    "rat_zip_score": _rat_zip_score,
    "combined_score": lambda x: x.risk_model.select("camis", "dba", "bin", "rat_risk_score"),
    "risk_category_counts": lambda x: combined_risk.risk_category_counts(x.risk_model),
    # joins on time
    "rat_state_at_visit": _rat_state_at_visit,
    "rat_state_before_visit": lambda x: _rat_state_at_visit(x, exact=False, oldest="90 days"),
    "rat_findings_near_visits": _rat_findings_near_visits,
    # histories, frames and subtotals
    "establishment_history": _establishment_history,
    "merged_establishment_history": _merged_history,
    "trailing_visit_scores": _trailing_visit_scores,
    "area_percentiles": _area_percentiles,
    "place_rollup": lambda x: _place_subtotals(x, rollups.rollup_sets(PLACES)),
    "place_cube": lambda x: _place_subtotals(x, rollups.cube_sets(PLACES)),
    "sketched_buildings": _sketched_buildings,
    # batches of the feeds
    "incremental_risk_model": lambda x: _incremental(x).risk_model,
    # streams
    "event_windows": _event_windows,
    "streamed_work_orders": _streamed_work_orders,
    # data checks
    "dq_not_null": lambda x: _checks(x, "not_null"),
    "dq_accepted_values": lambda x: _checks(x, "accepted_values"),
    "dq_accepted_range": lambda x: _checks(x, "accepted_range"),
    "dq_unique": lambda x: _checks(x, "unique"),
    "dq_row_count": lambda x: _checks(x, "row_count"),
    "dq_freshness": _freshness,
    "dq_report": _report,
}


def build(name: str, layers: Layers) -> DataFrame:
    """A query's result in the operator's own types."""
    return _QUERIES[name](layers)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: comparable(build(name, Layers(spark, sf_dir)))

    return {name: bind(name) for name in _QUERIES}
