"""Batches against one refresh of all rows, and what a batch leaves alone."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parity import star_feeds
from rows import AS_OF, inspections, values, violations
from sitegrade.operators import combined_risk
from sitegrade.plans import incremental, pipeline
from sitegrade.sources.feeds import RAT_FEED, RESTAURANT_FEED
from sitegrade.sources.sinks import TableStore


def rounded(df):
    """Rows with numbers to six digits: sums depend on the order of their terms."""
    plain = lambda v: round(float(v), 6) + 0.0 if isinstance(v, (float, Decimal)) else v
    return sorted((tuple(map(plain, row)) for row in df.select(*sorted(df.columns)).collect()), key=repr)


def assert_equal(found, wanted):
    for name, table in wanted.as_dict().items():
        other = found.as_dict()[name]
        assert sorted(other.columns) == sorted(table.columns), name
        assert rounded(other) == rounded(table), name


def none(spark, feed):
    return spark.createDataFrame([], feed.schema)


@pytest.fixture(scope="module")
def feeds(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    out = []
    for name, raw in (("restaurants", star_feeds.raw_restaurant(spark, sf_dir)), ("rats", star_feeds.raw_rat(spark, sf_dir))):
        # Few months, the sentinel's and rows without a date: each month is a folder to write.
        recent = F.coalesce((F.col("inspection_date") >= "2000-11") | (F.col("inspection_date") < "1995"), F.lit(True))
        raw.where(recent).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return out


@pytest.fixture(scope="module")
def refreshed(feeds, tmp_path_factory):
    return pipeline.run(*feeds, TableStore(str(tmp_path_factory.mktemp("whole"))), star_feeds.AS_OF)


SPLITS = {
    # Any rows in any batch, some of them twice; batches by date; the newest first.
    "at random": lambda date: [F.col("_at") < 60, F.col("_at") >= 40],
    "by date": lambda date: [F.coalesce(F.col(date) < "2000-10", F.lit(True)), F.col(date) >= "2000-10"],
    "newest first": lambda date: [F.col(date) >= "2001-03", F.coalesce(F.col(date) < "2001-03", F.lit(True))],
}


@pytest.mark.parametrize("split", SPLITS)
def test_batches_equal_a_refresh(feeds, refreshed, tmp_path, split):
    store = TableStore(str(tmp_path))
    spread = [raw.withColumn("_at", F.pmod(F.xxhash64(*raw.columns[:8]), F.lit(100))) for raw in feeds]
    dates = ("record_date", "inspection_date")
    for first, second in zip(*(SPLITS[split](date) for date in dates)):
        tables = incremental.update(*(raw.where(part).drop("_at") for raw, part in zip(spread, (first, second))), store, star_feeds.AS_OF)
    assert_equal(tables, refreshed)


def files(store, layer, table):
    base = store.path(layer, table)
    return {folder: sorted(os.listdir(f"{base}/{folder}")) for folder in os.listdir(base) if "=" in folder}


BY_MONTH = [
    ("clean", "clean_restaurant_inspection"), ("stage", "stg_restaurant_inspection"), ("mart", "mart_restaurant_inspection"),
    ("clean", "rat_work_orders"), ("clean", "clean_rat_inspection"), ("stage", "stg_rat_inspection"), ("mart", "mart_rat_inspection"),
]


def test_only_touched_months_are_written(spark, feeds, tmp_path):
    store = TableStore(str(tmp_path))
    incremental.update(*feeds, store, star_feeds.AS_OF)
    before = {table: files(store, *table) for table in BY_MONTH}
    late = {"inspection_date": "2001-02-03T00:00:00.000"}
    incremental.update(violations(spark, {**late, "camis": "5"}), inspections(spark, {**late, "job_ticket_or_work_order_id": "999999"}), store, star_feeds.AS_OF)
    for table in BY_MONTH:
        after = files(store, *table)
        changed = {folder for folder in before[table].keys() | after.keys() if before[table].get(folder) != after.get(folder)}
        assert changed == {"inspection_month=2001-02-01"} and len(after) > 4, table
    stats = store.read(spark, "state", "touched_restaurant_stats")
    assert values(stats.select("camis").distinct(), "camis") == [5]
    assert store.read(spark, "state", "touched_building_stats").count() == store.read(spark, "mart", "building_stats_6m").where("bin = 100").count() > 0
    assert store.read(spark, "state", "rats_changed").count() < store.read(spark, "mart", "building_stats_6m").select("bin").distinct().count()


def rat(order, date, **other):
    return {"job_ticket_or_work_order_id": order, "inspection_date": date and f"{date}T00:00:00.000", **other}


def test_a_work_order_moves_and_vanishes(spark, tmp_path):
    store, empty = TableStore(str(tmp_path)), none(spark, RESTAURANT_FEED)
    batches = [
        [rat("1", "2024-03-05", bin="7", street_name="A"), rat("2", "2024-04-01", bin="8", street_name="A"), rat(None, "2024-03-09", bin="9")],
        [rat("1", "2024-05-06", bin="6", street_name="B"), rat(None, "2024-06-09", bin="5")],  # moves, and leaves its month empty
        [rat("1", "2024-01-01", bin="4")],  # older: changes nothing
        [rat("2", "2031-01-01", bin="8"), rat("3", None, bin="8")],  # newest out of range, and one without a date
    ]
    bins = [[7, 8, 9], [5, 6, 8], [5, 6, 8], [5, 6]]
    for k, batch in enumerate(batches):
        tables = incremental.update(empty, inspections(spark, *batch), store, AS_OF)
        assert values(tables.mart_rat, "bin") == bins[k]
        assert ("inspection_month=2024-03-01" in files(store, "mart", "mart_rat_inspection")) == (k == 0)
    everything = inspections(spark, *[row for batch in batches for row in batch])
    assert_equal(tables, pipeline.run(empty, everything, TableStore(str(tmp_path / "whole")), AS_OF))


def test_streets_that_a_site_left_are_scored_anew(spark, tmp_path):
    store, empty = TableStore(str(tmp_path)), none(spark, RAT_FEED)
    first = [{"camis": str(n), "bin": str(n), "street": "A", "zipcode": "1", "score": str(10 * n)} for n in range(1, 4)]
    # The same key as before with a later record: establishment 3 is now on another street.
    moved = {**first[2], "street": "B", "zipcode": None, "record_date": "2024-06-09T00:00:00.000"}
    incremental.update(violations(spark, *first), empty, store, AS_OF)
    tables = incremental.update(violations(spark, moved), empty, store, AS_OF)
    assert_equal(tables, pipeline.run(violations(spark, *first, moved), empty, TableStore(str(tmp_path / "whole")), AS_OF))
    assert values(tables.restaurant_risk, "camis") == [1, 2]


def test_a_run_that_failed_is_repaired_by_the_next(spark, feeds, refreshed, tmp_path, monkeypatch):
    store = TableStore(str(tmp_path))
    early, late = ([raw.where(part) for raw, part in zip(feeds, parts)] for parts in zip(*(SPLITS["by date"](d) for d in ("record_date", "inspection_date"))))
    incremental.update(*early, store, star_feeds.AS_OF)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(combined_risk, "risk_model", fail)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.update(*late, store, star_feeds.AS_OF)
    assert not store.read(spark, "state", "rats").isEmpty()
    # The summaries are new and the model is old; the same batch again leaves nothing of that.
    assert_equal(incremental.update(*late, store, star_feeds.AS_OF), refreshed)
    assert store.read(spark, "state", "rats").isEmpty()


def test_another_day_computes_all_anew(feeds, tmp_path):
    store = TableStore(str(tmp_path))
    early, late = ([raw.where(part) for raw, part in zip(feeds, parts)] for parts in zip(*(SPLITS["by date"](d) for d in ("record_date", "inspection_date"))))
    incremental.update(*early, store, star_feeds.AS_OF)
    tables = incremental.update(*late, store, "2001-06-15")
    assert_equal(tables, pipeline.run(*feeds, TableStore(str(tmp_path / "whole")), "2001-06-15"))
