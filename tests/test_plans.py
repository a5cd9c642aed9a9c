"""Physical plans: what must be pruned, pushed, split or absent at scale."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from parity.spark_queries import Layers, build, registry
from rows import AS_OF, inspections, values, violations
from sitegrade.functions import dates
from sitegrade.operators import building_risk, clean, restaurant_risk, stage
from sitegrade.plans import pipeline
from sitegrade.sources.sinks import TableStore


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def layers(spark, sf_dir):
    return Layers(spark, sf_dir)


def test_dedupes_prune_before_the_shuffle(layers):
    for df in (layers.clean_restaurant, layers.clean_rat):
        text = plan(df)
        limits = [m.start() for m in re.finditer("WindowGroupLimit", text)]
        exchange = text.index("Exchange hashpartitioning")
        assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_no_python_no_products_no_whole_sorts(spark, layers):
    for df in (layers.risk_model, layers.stage_restaurant, layers.stage_rat):
        text = plan(df)
        for absent in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "rangepartitioning"):
            assert absent not in text


def test_stage_shuffles_the_deduped_rows_once(layers):
    """Rows and visit means share one dedupe exchange."""
    assert "ReusedExchange" in final_plan(stage.stage_restaurant(layers.clean_restaurant, "2001-07-01"))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    layers = Layers(spark, sf_dir)
    store = TableStore(str(tmp_path_factory.mktemp("tables")))
    return pipeline.run(layers.raw_restaurant, layers.raw_rat, store, "2001-07-01"), store


def test_half_year_reaches_both_scans_of_the_mart(stored):
    tables, _ = stored
    text = plan(restaurant_risk.restaurant_stats_6m(restaurant_risk.visit_stats(tables.mart_restaurant), "2001-07-01"))
    pushed = re.findall(r"PushedFilters: \[(.*?)\]", text)
    assert len(pushed) == 2
    assert all("GreaterThan(inspection_date,2001-01-01T00:00" in p for p in pushed)
    schemas = re.findall(r"ReadSchema: (struct<.*)", text)
    assert not any("violation_description" in s or "action" in s for s in schemas)


def test_stored_sites_read_the_mart_once(stored):
    tables, store = stored
    sites = restaurant_risk.site_visits(tables.mart_restaurant)
    assert plan(sites).count("FileScan parquet") == 1 and final_plan(sites).count("Exchange hashpartitioning") == 1
    kept = store.save(sites, "test", "sites")
    text = plan(restaurant_risk.visit_stats(tables.mart_restaurant, kept))
    assert text.count("test/sites") == text.count("FileScan parquet") == 2
    lazy = restaurant_risk.visit_stats(tables.mart_restaurant)
    assert lazy.exceptAll(restaurant_risk.visit_stats(tables.mart_restaurant, kept)).isEmpty()


def scanned(df):
    """Files and rows that the scan of a query reads."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    metrics = execution.executedPlan().collectLeaves().apply(0).metrics()
    return [metrics.get(name).get().value() for name in ("numFiles", "numOutputRows")]


def test_half_year_leaves_out_files(spark, sf_dir, tmp_path):
    layers, store = Layers(spark, sf_dir), TableStore(str(tmp_path))
    restaurants = pipeline.save_by_month(layers.mart_restaurant, store, "restaurants", "inspection_order_id")
    rats = pipeline.save_by_month(layers.mart_rat, store, "rats", "work_order_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for mart, as_of, share in ((restaurants, "2001-07-01", 0.2), (rats, "2001-10-01", 0.6)):
            recent = pipeline.recent_rows(mart, as_of).select("bin", "inspection_date")
            files, rows = scanned(recent)
            assert 0 < recent.count() <= rows < share * mart.count()
            assert files < len(mart.inputFiles())
            assert recent.count() == mart.where(dates.within_trailing_months(F.col("inspection_date"), as_of, 6)).count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_day_for_a_run(spark, tmp_path):
    tables = pipeline.run(violations(spark, {}), inspections(spark, {}), TableStore(str(tmp_path)))
    today = spark.range(1).select(F.current_date()).first()[0]
    frames = (tables.clean_restaurant, tables.clean_rat, tables.mart_restaurant)
    days = {r.extract_date for t in frames for r in t.select("extract_date").collect()}
    assert days <= {today} and tables.clean_restaurant.count() == 1
    text = plan(clean.clean_rat(inspections(spark, {}), today))
    assert "current_date" not in text


def test_building_summary_reads_only_its_columns(stored):
    tables, _ = stored
    text = plan(building_risk.building_stats_6m(tables.mart_rat, "2001-07-01"))
    schema = re.search(r"ReadSchema: (struct<.*)", text).group(1)
    assert "job_id" not in schema and "work_order_id" not in schema
    assert "GreaterThan(inspection_date" in text


def test_pipeline_equals_the_lazy_models(spark, sf_dir, stored):
    tables, _ = stored
    lazy = Layers(spark, sf_dir)
    for name in ("clean_rat", "stage_restaurant", "mart_rat"):
        written, direct = getattr(tables, name), getattr(lazy, name)
        assert written.columns == direct.columns
        assert written.exceptAll(direct).isEmpty() and direct.exceptAll(written).isEmpty()
    assert tables.risk_model.count() == lazy.risk_model.count()


def test_pipeline_is_a_full_refresh(spark, tmp_path):
    store = TableStore(str(tmp_path))
    rats = inspections(spark, {})
    pipeline.run(violations(spark, {"camis": "1"}, {"camis": "2"}), rats, store, AS_OF)
    tables = pipeline.run(violations(spark, {"camis": "3"}), rats, store, AS_OF)
    assert values(tables.risk_model, "camis") == [3]
    assert set(tables.serving()) == {"mart_rat_inspection", "mart_rat_risk_model", "mart_restaurant_inspection"}


@contextlib.contextmanager
def splitting(spark):
    """No broadcasts, and partitions small enough for the test rows to be skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("popular", [7, None])
def test_hot_visit_is_split_by_the_join(spark, tmp_path, popular):
    """A third of the rows on one visit, or without an establishment: the join's hot partition is cut into several tasks."""
    store = TableStore(str(tmp_path))
    with splitting(spark):
        hot = F.col("id") % 3 == 0
        rows = spark.range(0, 6000, 1, 8).select(
            F.when(hot, F.lit(popular).cast("int")).otherwise(F.col("id").cast("int") + 100).alias("camis"),
            F.when(hot, F.lit("2024-06-01")).otherwise(F.concat(F.lit("2024-06-"), (F.col("id") % 28 + 1).cast("string"))).cast("timestamp_ntz").alias("inspection_date"),
            (F.col("id") % 40).cast("int").alias("score"),
            F.sha2(F.col("id").cast("string"), 512).alias("payload"),
        )
        rows = store.save(rows, "test", "rows")
        averages = store.save(stage.visit_avg_score(rows), "test", "averages")
        scored = stage.attach_visit_score(rows, averages)
        assert "skew=true" in final_plan(scored)
        means = {r.camis: r.m for r in scored.groupBy("camis").agg(F.avg("computed_score").alias("m")).where("camis = 7").collect()}
        if popular:
            assert means[7] == pytest.approx(sum(i % 40 for i in range(0, 6000, 3)) / 2000)
        assert scored.count() == 6000


@pytest.mark.parametrize("popular", ["Main St", None])
@pytest.mark.parametrize("area", ["street", "zipcode"])
@pytest.mark.parametrize("side", ["restaurants", "buildings"])
def test_hot_areas_are_split_by_the_join(spark, stored, tmp_path, side, area, popular):
    tables, models = stored
    store = TableStore(str(tmp_path))
    summary, module, names = {
        "restaurants": ("restaurant_stats_6m", restaurant_risk, ("restaurant_street_scores", "restaurant_zip_scores")),
        "buildings": ("building_stats_6m", building_risk, ("rat_street_scores", "rat_zip_scores")),
    }[side]
    few = models.read(spark, "mart", summary).limit(60)
    copies = 9000 // few.count()
    with splitting(spark):
        many = few.drop(area).crossJoin(spark.range(0, copies, 1, 8)).withColumn(
            area, F.when(F.col("id") % 3 == 0, F.lit(popular)).otherwise(F.concat(F.lit("a"), F.col("id").cast("string"), F.col("bin").cast("string")))
        )
        payload = {"nta": F.sha2(F.col("id").cast("string"), 512)} if side == "restaurants" else {"latitude": F.rand(1), "longitude": F.rand(2)}
        stats = store.save(many.withColumns(payload), "test", "stats")
        streets, zips = (store.save(getattr(module, n)(stats), "test", n) for n in names)
        scores = module.restaurant_risk if side == "restaurants" else module.rat_risk
        assert "skew=true" in final_plan(scores(stats, "2001-07-01", streets, zips))


@pytest.mark.parametrize("variants", [1, 3])
def test_a_hot_visit_of_many_sites_is_split_by_the_join(spark, tmp_path, variants):
    """A third of the site descriptions belong to one visit; its maxima are stored, so the join shuffles both sides."""
    store = TableStore(str(tmp_path))
    with splitting(spark):
        hot = F.col("id") % 3 == 0
        text = lambda name: F.sha2(F.concat(F.lit(name), F.col("id").cast("string")), 256).alias(name)
        sites = spark.range(0, 12_000, 1, 8).select(
            F.when(hot, F.lit(7)).otherwise(F.col("id").cast("int") + 100).alias("camis"),
            F.concat(F.lit("d"), (F.col("id") % (3 * variants)).cast("string")).alias("dba"),
            *[text(c) for c in ("boro", "building", "street", "zipcode")],
            F.lit(1).alias("bin"), *[text(c) for c in ("bbl", "nta", "cuisine_description")],
            F.when(hot, F.lit("2024-06-01")).otherwise(F.lit("2024-06-02")).cast("timestamp_ntz").alias("inspection_date"),
            (F.col("id") % 5).alias("_severe"), (F.col("id") % 2).alias("_moderate"), F.lit(1).cast("bigint").alias("_critical_rows"),
            F.lit(3.0).alias("avg_computed_score"), F.lit(65).alias("_grade_code"), F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"),
            F.lit("2024-07-01").cast("date").alias("extract_date"),
        )
        sites = store.save(sites, "test", "sites")
        maxima = store.save(restaurant_risk.visit_maxima(sites), "test", "maxima")
        visits = restaurant_risk.visit_stats(sites, sites, maxima)
        assert "skew=true" in final_plan(visits)
        own = [i for i in range(0, 12_000, 3)]
        found = visits.where("camis = 7").select("severe_vio_count", "moderate_vio_count", "total_critical_count").distinct().collect()
        counts = [[sum(f(i) for i in own if i % (3 * variants) == v) for v in {i % (3 * variants) for i in own}] for f in (lambda i: i % 5, lambda i: i % 2)]
        assert [tuple(r) for r in found] == [(max(counts[0]), max(counts[1]), variants * variants)]
        assert visits.count() == 12_000


def test_the_visit_query_joins_stored_maxima(spark, sf_dir):
    read = lambda df: {re.search(r"/(\w+)/version-", f).group(1) for f in df.inputFiles()}
    assert read(Layers(spark, sf_dir).visits) == {"site_visits", "visit_maxima"}
    assert read(Layers(spark, sf_dir).stage_restaurant) == {"clean_restaurant_inspection", "visit_avg_score"}


def test_checks_of_a_session_share_one_refresh(spark, sf_dir):
    first, second = Layers(spark, sf_dir).stored, Layers(spark, sf_dir).stored
    assert first is second


def test_every_query_has_sql():
    from parity import oracle_sql

    assert set(registry()) == set(oracle_sql.registry()) and len(registry()) == 71


def test_strictness_reaches_every_cast(spark, tmp_path):
    raw = violations(spark, {"bin": "x"}, {"camis": "2"})
    tables = pipeline.run(raw, inspections(spark, {"bbl": "?"}), TableStore(str(tmp_path)), AS_OF, strict=False)
    assert values(tables.mart_restaurant, "camis") == [2]
    assert values(tables.mart_rat, "bbl") == [None]
    assert clean.clean_restaurant(raw, AS_OF, strict=False).count() == 2


def test_aggregates_hash_instead_of_sorting(stored):
    tables, _ = stored
    visits = restaurant_risk.visit_stats(tables.mart_restaurant)
    for df in (visits, restaurant_risk.restaurant_stats_6m(visits, "2001-07-01"),
               building_risk.building_stats_6m(tables.mart_rat, "2001-07-01")):
        assert "SortAggregate" not in plan(df) and "ObjectHashAggregate" not in plan(df)


def test_the_dedupe_reads_stored_raw_rows(spark, sf_dir):
    """The feed's own joins run once, not in each of the three passes over the raw rows."""
    cleaned = Layers(spark, sf_dir).clean_restaurant
    assert all("/raw/restaurant_inspection/" in file for file in cleaned.inputFiles())
    assert "l_orderkey" not in plan(cleaned)


def test_visit_means_join_visits_and_not_violations(spark, tmp_path):
    """Rows without scores and the stored means give the visits that scored rows give; two variants, a null score, a visit without any."""
    store = TableStore(str(tmp_path))
    cleaned = store.save(clean.clean_restaurant(violations(
        spark, {"score": "9"}, {"violation_code": "04B", "score": "20", "dba": "Diner"}, {"violation_code": "04C", "score": None},
        {"inspection_date": "2024-05-01T00:00:00.000", "score": None}, {"violation_code": None, "score": "40"}, {"camis": None},
    ), AS_OF), "clean", "rows")
    averages = store.save(stage.visit_avg_score(cleaned), "stage", "means")
    scored = stage.graded(stage.real_visits(stage.attach_visit_score(cleaned, averages)), AS_OF)
    late = pipeline.stored_visits(stage.real_visits(cleaned), store, "_late", averages)
    early = pipeline.stored_visits(scored, store, "_early")
    assert late.dtypes == early.dtypes and values(late, *late.columns) == values(early, *early.columns)
    assert values(late, "dba", "avg_computed_score", "computed_grade") == [("Cafe", 23.0, "B"), ("Cafe", None, "N"), ("Diner", 23.0, "B")]


def test_half_year_summary_gathers_recent_visits_only(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    assert layers.restaurant_stats.count() > 0
    seen = layers.store.read(spark, "mart", "site_visits_6m").where(~dates.within_trailing_months(F.col("inspection_date"), "2001-07-01", 6))
    assert seen.count() == 0


def test_half_year_summary_dedupes_recent_rows_only(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    found = layers.restaurant_stats
    landed = layers.store.read(spark, "raw", "recent_restaurant_inspection")
    assert 0 < landed.count() < 0.2 * layers.raw_restaurant.count()
    assert landed.where(~dates.within_trailing_months(F.col("inspection_date").cast("timestamp_ntz"), "2001-07-01", 6)).isEmpty()
    staged = stage.stage_restaurant(layers.clean_restaurant, "2001-07-01")
    whole = restaurant_risk.restaurant_stats_6m(restaurant_risk.visit_stats(stage.mart_restaurant(staged)), "2001-07-01")
    assert whole.columns == found.columns and whole.count() == found.count()
    exact = [c for c in whole.columns if dict(whole.dtypes)[c] != "double"]
    assert whole.select(exact).exceptAll(found.select(exact)).isEmpty()


def test_recent_rows_before_the_dedupe_leave_its_survivors(spark):
    """Repeats, a date on the cut, one not known, and an old and a late visit whose keys are one text."""
    raw = violations(
        spark, {}, {"score": "30"}, {"record_date": "2024-06-09T00:00:00.000", "dba": "Late"}, {"inspection_date": "2024-01-01T00:00:00.000"},
        {"inspection_date": "2023-12-31T00:00:00.000", "camis": "2"}, {"inspection_date": None}, {"inspection_date": "2024-01-02T00:00:00.000", "camis": "3"},
        {"camis": "4", "violation_code": "04A1", "inspection_date": "2023-02-03", "dba": "Old"}, {"camis": "4", "inspection_date": "12023-02-03", "dba": "Far"},
    )
    shown = lambda df: values(df.withColumn("inspection_date", F.col("inspection_date").cast("string")), "camis", "dba", "score", "inspection_date")
    before = clean.clean_restaurant(clean.recent_restaurant_rows(raw, AS_OF), AS_OF)
    after = clean.clean_restaurant(raw, AS_OF).where(dates.within_trailing_months(F.col("inspection_date"), AS_OF, 6))
    assert shown(before) == shown(after) and [row[:2] for row in shown(before)] == [(1, "Late"), (3, "Cafe"), (4, "Far")]


def test_customers_join_orders_and_not_lines(spark, layers):
    with splitting(spark):
        lines = plan(layers.raw_restaurant).splitlines()
    depth = lambda line: re.search(r"\w", line.replace("*(", " (")).start()
    at = next(i for i, line in enumerate(lines) if "Join [o_custkey" in line)
    below = []
    for line in lines[at + 1 :]:
        if depth(line) <= depth(lines[at]):
            break
        below.append(line)
    assert any("c_name" in line for line in below) and not any("l_orderkey" in line for line in below)


@pytest.mark.parametrize("query", ["place_rollup", "place_cube"])
def test_subtotals_store_whole_rows_of_repeated_keys_only(spark, sf_dir, query):
    layers = Layers(spark, sf_dir)
    assert build(query, layers).count() > 0
    kept = layers.store.read(spark, "raw", "repeated_restaurant_inspection")
    assert 0 < kept.count() < 0.2 * layers.raw_restaurant.count() and kept.columns == layers.raw_restaurant.columns
    assert layers.store.read(spark, "raw", "restaurant_columns").columns == ["boro", "zipcode", "street", "cuisine_description", "bin", "key_hash"]
    assert not layers.store.exists(spark, "raw", "restaurant_inspection")
