import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sitegrade.functions import dates, scoring
from sitegrade.functions.casts import to_coordinate, to_double, to_int, to_long, to_timestamp
from sitegrade.functions.keys import hash_key


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def apply(spark, data, ddl, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {ddl}")
    return [r.y for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def test_to_int_rounds_text(spark):
    texts = ["12.5", "-12.5", "13.5", "1e2", " 12 ", "12", None]
    assert apply(spark, texts, "string", to_int) == [13, -13, 14, 100, 12, 12, None]


@pytest.mark.parametrize("cast", [to_int, to_long, to_double, to_timestamp, to_coordinate])
def test_bad_text_fails_or_is_null(spark, cast):
    for text in ("", "abc"):
        with pytest.raises(Exception):
            one(spark, cast(F.lit(text)))
        assert one(spark, cast(F.lit(text), strict=False)) is None


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("cast", [to_int, to_long, to_double, to_timestamp, to_coordinate])
def test_strict_does_not_depend_on_the_session(spark, cast, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a value"):
            one(spark, cast(F.lit("abc")))
        assert one(spark, cast(F.lit(None).cast("string"))) is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC" and spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_to_long_is_exact(spark):
    texts = ["9007199254740993", "1e2", "3000000000"]
    assert apply(spark, texts, "string", to_long) == [9007199254740993, 100, 3000000000]


def test_coordinate_keeps_twelve_digits(spark):
    assert str(one(spark, to_coordinate(F.lit("40.71234567890123456")))) == "40.712345678901"


def test_timestamp_has_no_zone(spark):
    df = spark.range(1).select(to_timestamp(F.lit("2023-05-01T00:00:00.000")).alias("x"))
    assert df.dtypes == [("x", "timestamp_ntz")]
    assert df.first().x == datetime(2023, 5, 1)


def test_hash_key_is_md5_of_raw_text(spark):
    df = spark.createDataFrame([("1", None, "04a", "2024-01-01")], "a string, b string, c string, d string")
    expected = hashlib.md5(b"104a2024-01-01").hexdigest()
    assert df.select(hash_key("a", "b", "c", "d")).first()[0] == expected


def test_months_clamp_to_month_end(spark):
    assert one(spark, dates.months_before("2024-08-31", 6)) == datetime(2024, 2, 29)


def test_days_are_calendar_days(spark):
    seen = F.lit("2024-06-30 23:00:00").cast("timestamp_ntz")
    assert one(spark, dates.days_since(seen, "2024-07-01")) == 1


def test_as_of_kinds(spark):
    assert one(spark, dates.as_of_date("2024-07-01")) == date(2024, 7, 1)
    assert one(spark, dates.as_of_date(date(2024, 7, 1))) == date(2024, 7, 1)
    assert one(spark, dates.as_of_date(F.lit("2024-07-01"))) == date(2024, 7, 1)
    assert one(spark, dates.as_of_date(None) == F.current_date()) is True


def test_range_ends_at_midnight(spark):
    stamps = ["1999-12-31 23:59:59", "2000-01-01 00:00:00", "2024-07-01 00:00:00", "2024-07-01 10:00:00"]
    inside = apply(
        spark, stamps, "string",
        lambda c: dates.between_days(c.cast("timestamp_ntz"), "2000-01-01", "2024-07-01"),
    )
    assert inside == [False, True, True, False]


def test_trailing_window_is_strict_and_open(spark):
    stamps = ["2024-01-01 00:00:00", "2024-01-01 00:00:01", "2030-01-01 00:00:00"]
    inside = apply(
        spark, stamps, "string",
        lambda c: dates.within_trailing_months(c.cast("timestamp_ntz"), "2024-07-01", 6),
    )
    assert inside == [False, True, True]


def test_grades(spark):
    scores = [0.0, 13.0, 13.5, 27.0, 27.5, -1.0, None]
    assert apply(spark, scores, "double", scoring.grade_of) == list("AABBCNN")


DAYS = [-5, 30, 31, 90, 91, 180, 181, 365, 366, 765]


def penalties(spark, penalty):
    return apply(spark, DAYS, "int", lambda d: penalty(F.date_sub(F.lit("2024-07-01"), d), "2024-07-01"))


def test_restaurant_recency(spark):
    assert penalties(spark, scoring.restaurant_recency_penalty) == pytest.approx(
        [0, 0, 0, 0, 3, 3, 10, 10, 18.05, 33]
    )


def test_building_recency(spark):
    assert penalties(spark, scoring.building_recency_penalty) == pytest.approx(
        [0, 0, 2, 2, 5, 5, 12, 12, 20.05, 35]
    )
    unknown = F.lit(None).cast("timestamp_ntz")
    assert one(spark, scoring.building_recency_penalty(unknown, "2024-07-01")) == 20


@pytest.mark.parametrize(
    "total, failed, rats, expected",
    [(0, 0, 0, 15), (1, 0, 1, 8), (1, 1, 0, 5), (2, 0, 1, 5), (2, 1, 0, 5), (2, 0, 0, 0), (3, 3, 3, 0), (1, 0, 0, 0)],
)
def test_evidence(spark, total, failed, rats, expected):
    assert one(spark, scoring.evidence_penalty(F.lit(total), F.lit(failed), F.lit(rats))) == expected


def test_categories(spark):
    scores = [20.0, 55.0, 75.0, 19.999, -3.0, None, 100.0]
    assert apply(spark, scores, "double", scoring.risk_category) == [
        "MODERATE RISK", "HIGH RISK", "VERY HIGH RISK", "LOW RISK", "LOW RISK", "LOW RISK", "VERY HIGH RISK",
    ]


def test_first_matching_band_wins(spark):
    assert apply(spark, [1, 2, 3, None], "int", lambda c: scoring.band(c, [(2, 8), (1, 15)], F.lit(0))) == [8, 8, 0, 0]


def test_capped_score_has_no_floor(spark):
    def score(x):
        return scoring.capped_weighted_score([(x, 3)], extras=[F.lit(1)])

    assert apply(spark, [40.0, -40.0, None, 33.0], "double", score) == [100.0, -119.0, 1.0, 100.0]


def test_safe_ratio(spark):
    assert one(spark, scoring.safe_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, scoring.safe_ratio(F.lit(1), F.lit(4))) == 0.25
