from collections import Counter

import pytest
from pyspark.sql import functions as F

from rows import AS_OF, inspections, values, violations
from sitegrade.operators import building_risk, clean, combined_risk, restaurant_risk, stage


def restaurant_mart(spark, *changes):
    return stage.mart_restaurant(stage.stage_restaurant(clean.clean_restaurant(violations(spark, *changes), AS_OF), AS_OF))


def rat_mart(spark, *changes):
    numbered = [{"job_ticket_or_work_order_id": str(i), **c} for i, c in enumerate(changes)]
    return stage.mart_rat(stage.stage_rat(clean.clean_rat(inspections(spark, *numbered), AS_OF), AS_OF))


def restaurant_stats(spark, *changes):
    return restaurant_risk.restaurant_stats_6m(restaurant_risk.visit_stats(restaurant_mart(spark, *changes)), AS_OF)


def codes(*names, **extra):
    return [{"violation_code": n, **extra} for n in names]


def test_variants_of_a_visit(spark):
    """Two names for one visit: maxima over both, critical rows counted 2 * 2 times."""
    mart = restaurant_mart(
        spark,
        *codes("04A", "04B", "02A"),
        *codes("06A", "06B", dba="Cafe Annex", critical_flag="Not Critical"),
        *codes("05A", dba="Cafe Annex"),
    )
    visits = restaurant_risk.visit_stats(mart)
    got = values(visits, "dba", "severe_vio_count", "moderate_vio_count", "total_critical_count")
    assert got == [("Cafe Annex", 2, 2, 4), ("Cafe", 2, 2, 12)]
    mart.createOrReplaceTempView("visit_mart")
    paired = spark.sql("""
        WITH c AS (SELECT camis, dba, bin, inspection_date FROM visit_mart GROUP BY ALL)
        SELECT m.dba, count_if(m.critical_flag = 'CRITICAL') AS n FROM visit_mart m
        JOIN c s ON s.camis = m.camis AND s.inspection_date = m.inspection_date
        JOIN c t ON t.camis = m.camis AND t.inspection_date = m.inspection_date GROUP BY m.dba""")
    assert values(paired, "dba", "n") == [(g[0], g[3]) for g in got]


def test_unknown_establishments_have_no_visits(spark):
    assert restaurant_risk.visit_stats(restaurant_mart(spark, {"camis": None}, {"camis": "2"})).count() == 1


def test_half_year_weighs_visits_alike(spark):
    stats = restaurant_stats(
        spark,
        *codes("04A", "04B", "04C", inspection_date="2024-06-01T00:00:00.000", score="10"),
        *codes("02A", inspection_date="2024-05-01T00:00:00.000", score="20"),
        *codes("04A", inspection_date="2023-12-31T00:00:00.000", score="90"),
        *codes("04D", inspection_date="2024-01-01T00:00:00.000", score="90"),
    ).first()
    assert (stats.avg_severe_vio_count_6m, stats.avg_moderate_vio_count_6m) == (1.5, 0.5)
    assert stats.avg_score_orig_6m == 15.0
    assert (stats.grade_A_count_6m, stats.grade_B_count_6m, stats.grade_C_count_6m) == (1, 1, 0)


def test_clean_record_scores_below_zero(spark):
    row = restaurant_risk.restaurant_risk(restaurant_stats(spark, {"violation_code": "10F", "score": "0"}), AS_OF).first()
    assert (row.restaurant_risk_score, row.street_risk_score, row.zip_risk_score) == (-7.0, -20.0, -20.0)
    assert row.days_since_inspection == 30


def test_restaurant_scores_by_hand(spark):
    """Two establishments on one street: severe 1 and 0, scores 20 (B) and 4 (A)."""
    stats = restaurant_stats(
        spark,
        {"camis": "1", "violation_code": "04A", "score": "20"},
        {"camis": "2", "violation_code": "02A", "score": "4", "zipcode": "10002"},
    )
    rows = {r.camis: r for r in restaurant_risk.restaurant_risk(stats, AS_OF).collect()}
    assert rows[1].restaurant_risk_score == pytest.approx(15 + 5 + 3)
    assert rows[2].restaurant_risk_score == pytest.approx(6 - 3 - 2)
    assert rows[1].street_risk_score == rows[2].street_risk_score == pytest.approx(10 + 4 + 3 + 7.5 - 2.5)
    assert rows[1].zip_risk_score == pytest.approx(20 + 15 + 15)
    assert rows[2].zip_risk_score == pytest.approx(8 - 9 - 5)


def test_missing_street_scores_zero(spark):
    row = restaurant_risk.restaurant_risk(restaurant_stats(spark, {"street": None}), AS_OF).first()
    assert row.street is None and row.street_risk_score == 0.0 and row.zip_risk_score != 0.0


def test_building_measures(spark):
    mart = rat_mart(
        spark,
        {"result": "Failed", "inspection_type": "initial visit"},
        {"result": "Failed for Other R", "inspection_type": "BAIT"},
        {"result": "Rat Activity", "inspection_type": "Compliance"},
        {"result": "Passed", "inspection_type": "Stoppage"},
        {"result": "Rat Activity", "inspection_date": "2024-01-01T00:00:00.000"},
    )
    row = building_risk.building_stats_6m(mart, AS_OF).first()
    assert (row.total_inspections_6m, row.failed_inspections_6m, row.passed_inspections_6m, row.rat_activities_6m) == (4, 1, 1, 1)
    assert (row.initial_inspections_6m, row.bait_inspections_6m, row.compliance_inspections_6m) == (1, 1, 1)
    assert (row.failure_rate_6m, row.rat_activity_rate_6m) == (0.25, 0.25)


def test_building_scores_by_hand(spark):
    stats = building_risk.building_stats_6m(rat_mart(spark, {"result": "Rat Activity"}), AS_OF)
    row = building_risk.rat_risk(stats, AS_OF).first()
    assert row.bin_rr_score == pytest.approx(35 + 15 + 0 + 8)
    assert row.street_rr_score == pytest.approx(40 + 15 + 8)
    assert row.zip_rr_score == pytest.approx(40 + 15 + 5)


def test_rates_of_sums_differ_from_means_of_rates(spark):
    mart = rat_mart(spark, {"bin": "1", "result": "Rat Activity"}, *[{"bin": "2"}] * 3)
    row = building_risk.rat_street_stats(building_risk.building_stats_6m(mart, AS_OF)).first()
    assert (row.buildings_on_street, row.street_avg_rat_activity_rate, row.street_rat_activity_rate) == (2, 0.5, 0.25)


def test_building_without_street_or_zip(spark):
    stats = building_risk.building_stats_6m(rat_mart(spark, {"street_name": None, "zip_code": None}), AS_OF)
    row = building_risk.rat_risk(stats, AS_OF).first()
    assert (row.street_rr_score, row.zip_rr_score) == (0.0, 0.0)


def model(spark, restaurants, rats):
    r = restaurant_risk.restaurant_risk(restaurant_stats(spark, *restaurants), AS_OF)
    b = building_risk.rat_risk(building_risk.building_stats_6m(rat_mart(spark, *rats), AS_OF), AS_OF)
    return combined_risk.risk_model(r, b)


def test_model_fans_out_over_building_descriptions(spark):
    df = model(spark, [{"camis": "1"}, {"camis": "2", "bin": "999"}], [{"lot": "1"}, {"lot": "2"}])
    assert values(df, "camis") == [1, 1, 2]
    lonely = df.where("camis = 2").first()
    assert lonely.bin_rat_score is None and lonely.street_rat_score is None
    expected = 0.3 * lonely.restaurant_risk_score + 0.15 * lonely.street_risk_score + 0.05 * lonely.zip_risk_score
    assert lonely.rat_risk_score == pytest.approx(expected)


def test_model_invariants(spark, sf_dir):
    from parity.spark_queries import Layers

    rows = Layers(spark, sf_dir).risk_model.collect()
    assert rows and max(r.rat_risk_score for r in rows) <= 100

    def category(score):
        return next((c for low, c in [(75, "VERY HIGH"), (55, "HIGH"), (20, "MODERATE")] if score >= low), "LOW") + " RISK"

    assert all(r.risk_category == category(r.rat_risk_score) for r in rows)


def test_ranked_keeps_every_row(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0), (4, 5.0)], "id int, score double")
    assert [r.id for r in combined_risk.ranked(df, "score", "id").collect()] == [3, 1, 4, 2]


def test_hot_keys_give_the_same_result(spark):
    """A third of the rows on one visit without an establishment, a third on another visit."""
    rows = []
    for i in range(300):
        kind = i % 3
        rows.append({
            "camis": None if kind == 0 else "7" if kind == 1 else str(100 + i),
            "bin": str(i), "score": str(i % 50), "violation_code": f"{i % 7:02d}A",
        })
    scored = stage.attach_visit_score(clean.clean_restaurant(violations(spark, *rows), AS_OF))
    assert scored.count() == 300
    totals, counts = Counter(), Counter()
    for row in rows:
        totals[row["camis"]] += int(row["score"])
        counts[row["camis"]] += 1
    for row in scored.collect():
        key = None if row.camis is None else str(row.camis)
        expected = None if key is None else totals[key] / counts[key]
        assert row.computed_score == (None if expected is None else pytest.approx(expected))


def test_null_bin_never_joins(spark):
    left = restaurant_risk.restaurant_risk(restaurant_stats(spark, {}), AS_OF).withColumn("bin", F.lit(None).cast("int"))
    right = building_risk.rat_risk(building_risk.building_stats_6m(rat_mart(spark, {}), AS_OF), AS_OF)
    row = combined_risk.risk_model(left, right.withColumn("bin", F.lit(None).cast("int"))).first()
    assert row.bin_rat_score is None
