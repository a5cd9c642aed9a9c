from rows import AS_OF, values, violations
from sitegrade import fixed_values as fixed
from sitegrade.operators import quality
from sitegrade.plans.audit import audit
from sitegrade.sources.sinks import TableStore

CHECKS = {
    "not_null": ["k"],
    "accepted_values": {"v": ["A", "B"]},
    "accepted_range": {"n": (0, 100)},
    "unique": ["k"],
    "row_count": (1, 5),
}
ROWS = [(1, "A", 0), (1, "X", 100), (2, "X", 101), (2, "Y", -1), (None, None, None), (None, "B", 5)]


def sample(spark):
    return spark.createDataFrame(ROWS, "k int, v string, n int")


def report(df, checks=CHECKS):
    rows = quality.check_table(df, "t", checks).collect()
    return {(r.column_name, r.check_name): (r.failures, r.status) for r in rows}


def test_every_kind_of_check(spark):
    assert report(sample(spark)) == {
        ("k", "not_null"): (2, "warn"),
        ("v", "accepted_values"): (2, "warn"),
        ("n", "accepted_range"): (2, "warn"),
        ("k", "unique"): (2, "warn"),
        ("*", "row_count"): (1, "warn"),
    }


def test_clean_table_passes(spark):
    good = spark.createDataFrame([(1, "A", 1), (2, None, None)], "k int, v string, n int")
    assert set(report(good).values()) == {(0, "pass")}


def test_empty_table(spark):
    result = report(sample(spark).limit(0))
    assert result["*", "row_count"] == (1, "warn")
    assert result["v", "accepted_values"] == result["k", "unique"] == (0, "pass")


def test_failing_rows_once_per_check(spark):
    failed = quality.failing_rows(sample(spark), CHECKS)
    assert failed.columns == ["check_name", "column_name", "k", "v", "n"]
    counts = {r.check_name: r["count"] for r in failed.groupBy("check_name").count().collect()}
    assert counts == {"not_null": 2, "accepted_values": 3, "accepted_range": 2}


def test_unaccepted_and_repeated_values(spark):
    unaccepted = quality.unaccepted_values(sample(spark), CHECKS["accepted_values"])
    assert {(r["value"], r["rows"]) for r in unaccepted.collect()} == {("X", 2), ("Y", 1)}
    repeated = quality.repeated_values(sample(spark), "k")
    assert {(r["value"], r["rows"]) for r in repeated.collect()} == {(1, 2), (2, 2)}


def test_raw_checks_expect_upper_case(spark):
    """Raw boroughs come in mixed case, so the raw check warns by design."""
    raw = violations(spark, {"boro": "Bronx"}, {"boro": "BRONX"})
    assert report(raw, fixed.DATA_CHECKS["raw_restaurant"])["boro", "accepted_values"] == (1, "warn")


def test_freshness_limits(spark):
    def status(day):
        df = spark.createDataFrame([(day,)], "d string").selectExpr("cast(d as date) AS extract_date")
        return quality.freshness(df, "t", as_of=AS_OF).first().status

    assert [status(d) for d in ("2024-07-01", "2024-06-30", "2024-06-29", "2024-06-28", "2024-06-27", None)] == [
        "pass", "pass", "warn", "warn", "error", "error",
    ]


def test_number_of_declared_checks():
    tables = fixed.DATA_CHECKS.values()
    assert sum(len(t.get("not_null", [])) for t in tables) == 51
    assert sum(len(t.get("accepted_values", {})) for t in tables) == 16
    assert sum(len(t.get("accepted_range", {})) for t in tables) == 4


def test_single_row_checks_share_one_scan(spark, tmp_path):
    sample(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    single = {k: CHECKS[k] for k in ("not_null", "accepted_range", "accepted_values", "row_count")}
    plan = quality.check_table(df, "t", single)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_audit_stores_failures(spark, tmp_path):
    store = TableStore(str(tmp_path))
    result = audit({"t": sample(spark), "unchecked": spark.range(1)}, store, {"t": CHECKS})
    assert {r.check_name: r.failures for r in result.collect()}["unique"] == 2
    nulls = spark.read.parquet(store.path("audit", "t")).where("check_name = 'not_null' AND column_name = 'k'")
    assert values(nulls, "v", "n") == [("B", 5), (None, None)]
    assert values(store.read(spark, "audit", "t_k"), "value", "rows") == [(1, 2), (2, 2)]


def test_audit_stores_the_age_of_both_feeds(spark, tmp_path):
    store = TableStore(str(tmp_path))
    day = spark.range(1).selectExpr("DATE'2024-06-28' AS extract_date", "id AS k")
    audit({"t": sample(spark), "clean_restaurant": day, "clean_rat": day}, store, {"t": CHECKS}, as_of=AS_OF)
    assert values(store.read(spark, "audit", "freshness"), "table_name", "status") == [("clean_rat", "warn"), ("clean_restaurant", "warn")]
