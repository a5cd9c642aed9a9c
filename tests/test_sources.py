import json
import time

import pytest
from pyspark.sql import functions as F

from rows import INSPECTION, VIOLATION, inspections, values, violations
from sitegrade import session
from sitegrade.sources import feeds, sinks
from sitegrade.sources.feeds import RAT_FEED, RESTAURANT_FEED
from sitegrade.streaming.landing import append_new_landings


def test_declared_schemas():
    assert len(RESTAURANT_FEED.schema) == 23 and len(RAT_FEED.schema) == 30
    assert RAT_FEED.schema["location"].dataType.simpleString() == (
        "struct<human_address:string,latitude:string,longitude:string>"
    )


def test_pages_are_arrays_of_records(spark, tmp_path):
    location = {"human_address": "x", "latitude": "40.5", "longitude": "-73.5"}
    pages = [[{**INSPECTION, "location": location, ":@computed_region_92fq_4b7q": "9"}, {"bin": "5"}], [{"bin": "6", "extra": "?"}]]
    for i, page in enumerate(pages):
        (tmp_path / f"RAT_120000_{i}.json").write_text(json.dumps(page, indent=1))
    df = feeds.read_pages(spark, str(tmp_path), RAT_FEED)
    assert df.schema == RAT_FEED.schema
    assert values(df, "bin", "location.latitude", "`:@computed_region_92fq_4b7q`") == [
        ("100", "40.5", "9"), ("5", None, None), ("6", None, None),
    ]


def test_conform_fills_casts_and_drops(spark):
    df = spark.createDataFrame([(7, "x", 1)], "bin int, nta string, surplus int")
    row = feeds.conform(df, RAT_FEED)
    assert row.schema.simpleString() == RAT_FEED.schema.simpleString()
    assert (row.first().bin, row.first().nta, row.first().location) == ("7", "x", None)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_landing_round_trip(spark, tmp_path, fmt):
    store = str(tmp_path)
    for date, camis in (("20240601", "1"), ("20240601", "2"), ("20240602", "3")):
        feeds.land(violations(spark, {"camis": camis, "grade": None}), RESTAURANT_FEED, store, date, fmt)
    assert values(feeds.read_landed(spark, RESTAURANT_FEED, store, "20240601", fmt), "camis") == ["1", "2"]
    everything = feeds.read_landed(spark, RESTAURANT_FEED, store, fmt=fmt)
    assert everything.schema == RESTAURANT_FEED.schema
    assert values(everything, "camis", "grade", "dba")[-1] == ("3", None, "Cafe")


def test_unknown_format_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="csv"):
        feeds.land(violations(spark, {}), RESTAURANT_FEED, str(tmp_path), "20240601", "csv")


def test_append_raw_reads_columns_by_name(spark, tmp_path):
    store, raw = str(tmp_path / "store"), str(tmp_path / "raw")
    shuffled = violations(spark, {"camis": "1"}).select(*reversed(VIOLATION))
    shuffled.write.parquet(feeds.landing_dir(store, "20240601", "parquet"))
    feeds.append_raw(spark, RESTAURANT_FEED, store, "20240601", raw)
    feeds.append_raw(spark, RESTAURANT_FEED, store, "20240601", raw)
    assert values(feeds.read_raw(spark, RESTAURANT_FEED, raw), "camis", "dba") == [("1", "Cafe")] * 2


def test_streaming_appends_each_file_once(spark, tmp_path):
    store, raw, checkpoint = (str(tmp_path / p) for p in ("store", "raw", "checkpoint"))

    def run():
        append_new_landings(spark, RAT_FEED, store, raw, checkpoint, files_per_batch=1).awaitTermination()
        return values(feeds.read_raw(spark, RAT_FEED, raw), "job_id")

    feeds.land(inspections(spark, {"job_id": "a"}), RAT_FEED, store, "20240601")
    feeds.land(inspections(spark, {"job_id": "b"}), RAT_FEED, store, "20240602")
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    feeds.land(inspections(spark, {"job_id": "c"}), RAT_FEED, store, "20240602")
    assert run() == ["a", "b", "c"]


def test_table_store_replaces(spark, tmp_path):
    store = sinks.TableStore(str(tmp_path))
    assert store.path("mart", "t") == f"{tmp_path}/mart/t"
    store.save(spark.range(5).toDF("id"), "mart", "t")
    assert store.save(spark.range(2).toDF("id"), "mart", "t").count() == 2
    assert store.read(spark, "mart", "t").count() == 2


def test_a_failed_write_leaves_the_table_readable(spark, tmp_path):
    store = sinks.TableStore(str(tmp_path))
    assert not store.exists(spark, "mart", "t")
    with pytest.raises(FileNotFoundError):
        store.read(spark, "mart", "t")
    old = store.save(spark.range(10), "mart", "t")
    # Fails on the last rows, when other tasks have written theirs.
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        store.save(broken, "mart", "t")
    assert old.count() == store.read(spark, "mart", "t").count() == 10
    # The next write may read the table itself, and takes the place of the failed one.
    new = store.save(store.read(spark, "mart", "t").where("id < 3"), "mart", "t")
    assert new.count() == store.read(spark, "mart", "t").count() == 3
    assert old.count() == 10  # a reader of the version before is not disturbed
    store.save(spark.range(1), "mart", "t")
    assert len(list((tmp_path / "mart/t").glob("version-*"))) == 2


def test_export(spark, tmp_path):
    path = sinks.export_path(str(tmp_path), "WH", "mart", "20240701", "risk")
    assert path == f"{tmp_path}/WH/mart/20240701/risk.parquet"
    df = spark.range(100).repartition(4)
    sinks.export_mart(df, path)
    assert len(list((tmp_path / "WH/mart/20240701/risk.parquet").glob("part-*.parquet"))) == 4
    assert spark.read.parquet(path).count() == 100


def test_all_marts_export_in_one_call(spark, tmp_path):
    marts = {table: spark.range(n + 1) for n, table in enumerate(sinks.SERVING_TABLES)}
    paths = sinks.export_marts(marts, str(tmp_path), "WH", "mart", "20240701")
    assert list(paths) == list(sinks.SERVING_TABLES)
    assert [spark.read.parquet(p).count() for p in paths.values()] == [1, 2, 3]


def test_tables_in_folders(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS day")
    stored = sinks.TableStore(str(tmp_path)).save(rows, "mart", "t", "day", ("id",))
    assert stored.columns == rows.columns and stored.exceptAll(rows).isEmpty() and stored.count() == 1000
    assert sorted(p.name for p in (tmp_path / "mart/t/version-00000001").iterdir() if p.is_dir()) == [f"day={d}" for d in range(7)]


def test_serving_clean(spark):
    df = spark.createDataFrame([("", " ", 1)], "a string, b string, n int").withColumn(
        "t", F.lit("2024-07-01 10:00:00").cast("timestamp")
    )
    cleaned = sinks.serving_clean(df)
    assert dict(cleaned.dtypes)["t"] == "timestamp_ntz"
    row = cleaned.first()
    assert (row.a, row.b, row.n, str(row.t)) == (None, " ", 1, "2024-07-01 10:00:00")


def test_serving_types(spark):
    assert [len(sinks.serving_schema(t)) for t in sinks.SERVING_TABLES] == [20, 19, 26]


def test_serving_cast_orders_and_types(spark):
    schema = sinks.serving_schema("mart_rat_inspection")
    text = spark.createDataFrame([tuple(None for _ in schema)], ", ".join(f"{n} string" for n in reversed(schema.names)))
    assert sinks.serving_cast(text, "mart_rat_inspection").schema.simpleString() == schema.simpleString()


def test_jdbc_options(spark):
    options = sinks.jdbc_options("jdbc:postgresql://host/db", "mart_rat_inspection", connections=4)
    assert options["dbtable"] == "public.mart_rat_inspection"
    assert (options["truncate"], options["batchsize"], options["numPartitions"]) == ("true", "1000", "4")
    assert "createTableColumnTypes" not in options  # the defaults are right, and only Spark's own type names parse


def test_load_marts_reports_each_table(spark):
    def write(df, table):
        if table == "mart_rat_risk_model":
            raise RuntimeError("no space")

    frames = {"mart_rat_inspection": spark.range(1), "mart_rat_risk_model": spark.range(1)}
    with pytest.raises(sinks.LoadFailed, match="no space") as failed:
        sinks.load_marts(frames, write)
    assert sinks.load_marts({t: spark.range(1) for t in sinks.SERVING_TABLES}, lambda df, table: None) == dict.fromkeys(sinks.SERVING_TABLES, "loaded")
    assert failed.value.outcome == {
        "mart_rat_inspection": "loaded",
        "mart_rat_risk_model": "failed: no space",
        "mart_restaurant_inspection": "missing",
    }


def test_scratch_root_is_under_the_session_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    one, two = session.scratch_root(spark), session.scratch_root(spark)
    assert one != two and (not shared or one.startswith(shared))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_a_write_gives_back_its_shuffle_files(spark, tmp_path):
    store, before = sinks.TableStore(str(tmp_path)), shuffle_files(spark)
    saved = store.save(spark.range(1000).repartition(3, "id"), "stage", "t")
    assert saved.count() == 1000
    for _ in range(50):  # files go in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before


def test_rows_that_lie_in_folders_are_written_without_a_shuffle(spark, tmp_path):
    store, numbers = sinks.TableStore(str(tmp_path)), spark.sparkContext._jsc.sc().newShuffleId
    rows = spark.range(1000).selectExpr("id", "cast(id % 3 as int) as part")
    store.save_folders(rows, "stage", "t", "part", [0, 1, 2])
    staged = store.read_folders(spark, "stage", "t", rows.schema)
    last = numbers()
    store.save_folders(staged.where("id % 2 = 0"), "mart", "t", "part", [0, 1, 2], lies_in_folders=True)
    assert numbers() == last + 1
    assert sorted(store.read_folders(spark, "mart", "t", rows.schema).collect()) == sorted(rows.where("id % 2 = 0").collect())
