from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import AS_OF, inspections, values, violations
from sitegrade.operators import clean, stage
from sitegrade.operators.dedup import latest_of_mostly_single, latest_per_key
from sitegrade.plans import pipeline
from sitegrade.sources.sinks import TableStore


def test_clean_restaurant_contract(spark):
    row = clean.clean_restaurant(violations(spark, {"score": "12.5", "violation_code": "04a"}), AS_OF)
    assert row.dtypes[:4] == [
        ("inspection_order_id", "string"), ("camis", "int"), ("dba", "string"), ("dba_lower", "string")
    ]
    assert dict(row.dtypes)["latitude"] == "decimal(18,12)" and dict(row.dtypes)["row_num"] == "bigint"
    assert len(row.columns) == 26
    got = row.first()
    assert (got.dba_lower, got.boro, got.violation_code, got.score, got.row_num) == ("cafe", "BRONX", "04A", 13, 1)


def test_key_uses_raw_case(spark):
    df = clean.clean_restaurant(violations(spark, {"violation_code": "04a"}, {"violation_code": "04A"}), AS_OF)
    assert df.count() == 2


def test_dedupe_is_deterministic_and_idempotent(spark):
    raw = violations(
        spark,
        {"score": "5", "record_date": "2024-06-02T00:00:00.000"},
        {"score": "9", "record_date": "2024-06-09T00:00:00.000"},
        {"score": "11", "record_date": "2024-06-09T00:00:00.000"},
        {"inspection_date": None},
    )
    once = clean.clean_restaurant(raw, AS_OF)
    assert values(once, "score") == [11]
    again = clean.latest_restaurant_rows(once.drop("row_num"))
    assert values(again, "inspection_order_id") == values(once, "inspection_order_id")
    assert values(clean.clean_restaurant(raw.orderBy("score"), AS_OF), "score") == [11]


def test_strict_and_lenient_numbers(spark):
    raw = violations(spark, {"score": "abc"})
    with pytest.raises(Exception):
        clean.clean_restaurant(raw, AS_OF).collect()
    assert values(clean.clean_restaurant(raw, AS_OF, strict=False), "score") == [None]


def test_work_order_with_late_newest_row_vanishes(spark):
    raw = inspections(
        spark,
        {"job_ticket_or_work_order_id": "1"},
        {"job_ticket_or_work_order_id": "1", "inspection_date": "2024-08-01T00:00:00.000"},
        {"job_ticket_or_work_order_id": "2"},
        {"job_ticket_or_work_order_id": "3", "inspection_date": "2024-07-01T10:00:00.000"},
    )
    assert values(clean.clean_rat(raw, AS_OF), "work_order_id") == [2]


def test_missing_work_orders_are_one_key(spark):
    raw = inspections(spark, *[{"job_ticket_or_work_order_id": None, "job_id": str(i)} for i in range(3)])
    assert values(clean.clean_rat(raw, AS_OF), "job_id") == ["2"]


def test_approved_date_breaks_ties_and_nulls_come_last(spark):
    raw = inspections(
        spark,
        {"job_id": "a", "approved_date": None},
        {"job_id": "b", "approved_date": "2024-06-03T00:00:00.000"},
        {"job_id": "c", "approved_date": "2024-06-04T00:00:00.000"},
    )
    assert values(clean.clean_rat(raw, AS_OF), "job_id") == ["c"]


def test_clean_rat_contract(spark):
    df = clean.clean_rat(inspections(spark, {}), AS_OF)
    types = dict(df.dtypes)
    assert len(df.columns) == 20
    assert (types["bbl"], types["latitude"], types["inspection_date"]) == ("bigint", "double", "timestamp_ntz")
    row = df.first()
    assert (row.inspection_type, row.borough, row.result, row.street) == ("INITIAL", "BRONX", "PASSED", "Main St")


def test_visit_score_covers_filtered_rows(spark):
    raw = violations(
        spark,
        {"violation_code": "04A", "score": "10"},
        {"violation_code": "04B", "score": "20"},
        {"violation_code": None, "score": "60"},
        {"violation_code": "04C", "score": None},
    )
    staged = stage.stage_restaurant(clean.clean_restaurant(raw, AS_OF), AS_OF)
    assert values(staged, "violation_code", "computed_score", "computed_grade") == [
        ("04A", 30.0, "C"), ("04B", 30.0, "C"), ("04C", 30.0, "C"),
    ]


def test_unknown_establishment_has_no_visit_score(spark):
    raw = violations(spark, {"camis": None}, {"camis": None, "violation_code": "04B"})
    staged = stage.stage_restaurant(clean.clean_restaurant(raw, AS_OF), AS_OF)
    assert values(staged, "computed_score", "computed_grade") == [(None, "N"), (None, "N")]


def test_stage_restaurant_filters_and_flags(spark):
    raw = violations(
        spark,
        {"camis": "1", "inspection_date": "1900-01-01T00:00:00.000"},
        {"camis": "2", "bin": None},
        {"camis": "3", "zipcode": None},
        {"camis": "4", "violation_code": None},
        {"camis": "5", "inspection_date": "2024-06-01T00:00:00.000", "grade_date": None},
        {"camis": "6", "inspection_date": "2024-05-31T00:00:00.000"},
    )
    staged = stage.stage_restaurant(clean.clean_restaurant(raw, AS_OF), AS_OF)
    assert len(staged.columns) == 26
    assert values(staged, "camis", "grade") == [(5, "Z"), (6, "N")]
    assert staged.where("camis = 5").first().grade_date == datetime(2024, 6, 1)


def test_stage_rat_merges_equal_numbers_only(spark):
    raw = inspections(
        spark,
        {"job_ticket_or_work_order_id": "7"},
        {"job_ticket_or_work_order_id": "07"},
        {"job_ticket_or_work_order_id": "8", "bin": None},
        {"job_ticket_or_work_order_id": "9", "latitude": None},
    )
    staged = stage.stage_rat(clean.clean_rat(raw, AS_OF), AS_OF)
    assert values(staged, "work_order_id", "latitude") == [(7, 40.5), (9, None)]


def test_building_coordinates_are_distinct_and_known(spark):
    raw = violations(spark, {}, {"violation_code": "04B"}, {"violation_code": "04C", "latitude": None})
    assert stage.building_coordinates(clean.clean_restaurant(raw, AS_OF)).count() == 1


def test_row_counts_never_grow(spark, sf_dir):
    from parity import star_feeds

    raw = star_feeds.raw_restaurant(spark, sf_dir)
    cleaned = clean.clean_restaurant(raw, star_feeds.AS_OF)
    staged = stage.stage_restaurant(cleaned, star_feeds.AS_OF)
    counts = [raw.count(), cleaned.count(), staged.count(), stage.mart_restaurant(staged).count()]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert staged.select("inspection_order_id").distinct().count() == counts[2]


def test_latest_per_key_matches_brute_force(spark):
    rows = [(i % 3 if i % 5 else None, i % 4, (i * 7) % 11, i) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, a int, b int, id int")
    best = {}
    for row in rows:
        best[row[0]] = max(best.get(row[0], row), row, key=lambda r: r[1:])
    assert values(latest_per_key(df, ["k"], ["a", "b"], ["id"]), "k", "a", "b", "id") == sorted(best.values(), key=repr)


def test_coordinates_filled_by_building(spark):
    known = spark.createDataFrame(
        [(1, 40.5, -73.5), (1, 40.6, -73.9), (1, 40.6, -73.4), (2, None, -73.0), (None, 41.0, -70.0)], "bin int, latitude double, longitude double"
    )
    rats = clean.clean_rat(
        inspections(spark, {"bin": "1", "job_ticket_or_work_order_id": "1", "latitude": None}, {"bin": "2", "job_ticket_or_work_order_id": "2", "latitude": None},
                    {"bin": "1", "job_ticket_or_work_order_id": "3"}), AS_OF)
    filled = stage.stage_rat(rats, AS_OF, "by_bin", stage.largest_coordinates(known))
    assert filled.columns == stage.stage_rat(rats, AS_OF).columns
    assert values(filled, "work_order_id", "latitude", "longitude") == [(1, 40.6, -73.4), (2, None, -73.5), (3, 40.5, -73.5)]
    assert values(stage.stage_rat(rats, AS_OF), "work_order_id", "latitude") == [(1, None), (2, None), (3, 40.5)]
    with pytest.raises(ValueError):
        stage.stage_rat(rats, AS_OF, "nearest")


def test_latest_of_mostly_single_matches_brute_force(spark):
    """Single keys, repeated ones, a null key, a key with a third of all rows, and nothing but repeated keys."""
    single = [(k, None if k % 7 == 0 else k % 5, k % 3, k) for k in range(300)]
    again = [(k, k % 4 or None, k % 2, 1000 + k) for k in range(0, 300, 20)]
    crowd = [(7, k % 11, k % 13, 2000 + k) for k in range(200)] + [(None, 1, 1, 3000), (None, None, 2, 3001)]
    for rows in (single + again + crowd, single, crowd, []):
        df = spark.createDataFrame(rows, "k int, a int, b int, id int")
        one, other = (f(df, ["k"], ["a", "b"], ["id"], "n") for f in (latest_of_mostly_single, latest_per_key))
        assert one.dtypes == other.dtypes and values(one, "k", "a", "b", "id", "n") == values(other, "k", "a", "b", "id", "n")
        assert latest_of_mostly_single(df, ["k"], ["a", "b"], ["id"]).columns == df.columns


def test_rows_of_single_keys_are_not_shuffled(spark):
    """Of 2,000 keys, two have more than one row; all others pass the dedupe where they are."""
    rows = violations(spark, *[{"camis": str(k)} for k in range(2000)], {"camis": "5", "score": "1"}, {"camis": "6", "score": "2"})
    execution = clean.clean_restaurant(rows, AS_OF)._jdf.queryExecution()
    assert execution.toRdd().count() == 2000
    plan = execution.executedPlan().executedPlan()
    stack, shuffled = [plan], []
    while stack:
        node = stack.pop()
        if node.nodeName() == "Exchange":
            names = [node.output().apply(k).name() for k in range(node.output().size())]
            if "violation_description" in names:
                shuffled.append(node.metrics().get("shuffleRecordsWritten").get().value())
        if node.nodeName().endswith("QueryStage"):
            stack.append(node.plan())
        stack += [node.children().apply(k) for k in range(node.children().size())]
    assert len(shuffled) == 1 and 4 <= shuffled[0] < 20


@pytest.mark.parametrize("columns", [["boro", "street", "bin"], ["score"], ["inspection_date", "latitude", "camis", "violation_code"]])
def test_few_columns_of_the_latest_rows(spark, tmp_path, columns):
    """Repeats that each order column decides, an undated row of a dated one's key, two visits whose keys are one text, nulls."""
    raw = violations(
        spark, {}, {"record_date": "2024-06-09T00:00:00.000", "boro": "Late", "score": "3"}, {"record_date": "2024-06-09T00:00:00.000", "street": "Tie", "score": "2"},
        {"camis": "2", "street": "Tie A"}, {"camis": "2", "street": "Tie B"}, {"camis": "2", "inspection_date": None, "boro": "Undated"},
        {"camis": "3", "bin": "1", "violation_code": ""}, {"camis": "31", "bin": "", "violation_code": None, "boro": "Same text"}, {"camis": "5", "bin": None, "score": None},
        {"camis": None, "inspection_date": None}, *[{"camis": str(k), "street": None} for k in range(100, 150)],
        {"camis": "6", "violation_code": "04A1", "inspection_date": "2023-02-03", "boro": "Old"}, {"camis": "6", "inspection_date": "12023-02-03", "boro": "Far"},
    )
    shown = lambda df: [tuple(map(str, r)) for r in df.select(*[F.col(c).cast("string") for c in columns]).collect()]
    raw = raw.withColumn("bin", F.nullif("bin", F.lit("")))
    found = pipeline.latest_restaurant_columns(raw, TableStore(str(tmp_path)), columns)
    whole = clean.latest_restaurant_rows(clean.type_restaurant_rows(raw)).select(*columns)
    assert found.dtypes == whole.dtypes and sorted(shown(found)) == sorted(shown(whole)) and found.count() == 55


def test_strictness_reaches_few_columns(spark, tmp_path):
    raw = violations(spark, {"bin": "abc"}, {"camis": "2"})
    assert values(pipeline.latest_restaurant_columns(raw, TableStore(str(tmp_path)), ["bin"], strict=False), "bin") == [100, None]
    with pytest.raises(Exception, match="not a value of type int"):
        pipeline.latest_restaurant_columns(raw, TableStore(str(tmp_path)), ["bin"]).collect()
