"""Raw feeds to typed, normalised, deduplicated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sitegrade import fixed_values as fixed
from sitegrade.functions.casts import to_coordinate, to_double, to_int, to_long, to_timestamp
from sitegrade.functions.dates import AsOf, as_of_date, between_days, within_trailing_months
from sitegrade.functions.keys import hash_key, key_text
from sitegrade.operators.dedup import latest_of_mostly_single, latest_per_key, with_repeated

ORDER_KEY_COLUMNS = ("camis", "bin", "violation_code", "inspection_date")

# Payload columns of the two dedupes, used to break ties between equal dates.
RESTAURANT_TIE_BREAK = (
    "score", "violation_description", "violation_code", "critical_flag", "action", "grade",
    "grade_date", "camis", "dba", "boro", "building", "street", "zipcode", "phone", "bin", "bbl",
    "nta", "cuisine_description", "latitude", "longitude",
)
RAT_TIE_BREAK = (
    "job_id", "inspection_type", "result", "job_progress", "bbl", "boro_code", "block", "lot",
    "house_number", "street_name", "zip_code", "latitude", "longitude", "borough", "bin", "nta",
)

RESTAURANT_ORDER = ("inspection_date", "record_date")
KEY_HASH = "key_hash"


def type_restaurant_rows(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Cast and normalise every violation row and give it its surrogate key.

    The key hashes the raw text, before the violation code is upper-cased.
    """
    return raw.select(
        hash_key(*ORDER_KEY_COLUMNS).alias("inspection_order_id"),
        to_int("camis", strict).alias("camis"),
        "dba",
        F.upper("boro").alias("boro"),
        "building",
        "street",
        "zipcode",
        "phone",
        to_timestamp("inspection_date", strict).alias("inspection_date"),
        F.upper("critical_flag").alias("critical_flag"),
        to_timestamp("record_date", strict).alias("record_date"),
        to_int("bin", strict).alias("bin"),
        "bbl",
        "nta",
        "cuisine_description",
        "action",
        F.upper("violation_code").alias("violation_code"),
        "violation_description",
        to_int("score", strict).alias("score"),
        "grade",
        to_timestamp("grade_date", strict).alias("grade_date"),
        to_coordinate("latitude", strict).alias("latitude"),
        to_coordinate("longitude", strict).alias("longitude"),
    )


def recent_restaurant_rows(raw: DataFrame, as_of: AsOf = None, strict: bool = True) -> DataFrame:
    """Raw violations of the trailing half year, for summaries of it.

    Taken before the dedupe or after it, they are the same: a key's survivor is
    the row of its newest visit, so if that is too old, all rows of the key are.
    A visit's mean is over one date and does not change either.
    """
    return raw.where(within_trailing_months(to_timestamp("inspection_date", strict), as_of, fixed.TRAILING_MONTHS))


def latest_restaurant_rows(typed: DataFrame) -> DataFrame:
    """One dated row per surrogate key, with its ``row_num`` of 1.

    The order takes in every column, so the survivor is the same on every run.
    Most keys have one row, and those rows are not shuffled.
    """
    return latest_of_mostly_single(
        typed.where(F.col("inspection_date").isNotNull()),
        keys=["inspection_order_id"],
        newest_first=RESTAURANT_ORDER,
        tie_break=RESTAURANT_TIE_BREAK,
        rank_column="row_num",
    )


def narrow_restaurant_rows(raw: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """``columns`` of all dated raw rows and a hash of the text of their key."""
    dated = raw.where(to_timestamp("inspection_date", strict).isNotNull())
    return dated.select(*columns, F.xxhash64(key_text(*ORDER_KEY_COLUMNS)).alias(KEY_HASH))


def repeated_restaurant_rows(raw: DataFrame, words: DataFrame) -> DataFrame:
    """The raw rows whose key may have several, by the bitmap of the narrow rows' hashes."""
    hashed = raw.withColumn(KEY_HASH, F.xxhash64(key_text(*ORDER_KEY_COLUMNS)))
    return with_repeated(hashed, KEY_HASH, words, "_repeated").where("_repeated").select(*raw.columns)


def latest_restaurant_columns(narrow: DataFrame, words: DataFrame, repeated: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """``columns`` of :func:`latest_restaurant_rows`, from the narrow rows, their bitmap and the repeated rows.

    Only rows whose key may be repeated have all columns and are ranked.  Of the
    others nothing but ``columns`` is kept or typed.
    """
    typed = type_restaurant_rows(repeated, strict).where(F.col("inspection_date").isNotNull())
    newest = latest_per_key(typed, ["inspection_order_id"], RESTAURANT_ORDER, RESTAURANT_TIE_BREAK)
    single = with_repeated(narrow, KEY_HASH, words, "_repeated").where("not _repeated")
    # Raw and typed columns have the same names; those that are not asked are null here and not evaluated.
    missing = {c: F.lit(None).cast("string") for c in (*RESTAURANT_ORDER, *RESTAURANT_TIE_BREAK) if c not in columns}
    return newest.select(*columns).unionByName(type_restaurant_rows(single.withColumns(missing), strict).select(*columns))


def clean_restaurant(raw: DataFrame, as_of: AsOf = None, strict: bool = True) -> DataFrame:
    """Deduplicated typed rows; columns that follow from others are added after the shuffle."""
    return finished_restaurant(latest_restaurant_rows(type_restaurant_rows(raw, strict)), as_of)


def finished_restaurant(latest: DataFrame, as_of: AsOf = None) -> DataFrame:
    """:func:`latest_restaurant_rows` with the columns that follow from others."""
    return latest.select(
        "inspection_order_id", "camis", "dba", F.lower("dba").alias("dba_lower"), "boro", "building",
        "street", "zipcode", "phone", "inspection_date", "critical_flag", "record_date", "bin", "bbl",
        "nta", "cuisine_description", "action", "violation_code", "violation_description", "score",
        "grade", "grade_date", "latitude", "longitude",
        as_of_date(as_of).alias("extract_date"),
        "row_num",
    )


def latest_work_orders(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The newest row of each work order; only its dates are typed yet."""
    dated = raw.withColumns(
        {c: to_timestamp(c, strict) for c in ("inspection_date", "approved_date")}
    ).select("job_ticket_or_work_order_id", "inspection_date", "approved_date", *RAT_TIE_BREAK)
    return latest_per_key(
        dated,
        keys=["job_ticket_or_work_order_id"],
        newest_first=["inspection_date", "approved_date"],
        tie_break=RAT_TIE_BREAK,
    )


def clean_rat(raw: DataFrame, as_of: AsOf = None, strict: bool = True) -> DataFrame:
    """The date range is tested after the dedupe, on purpose.

    A work order whose newest row lies outside the range vanishes as a whole; an
    older row inside the range must not take its place.
    """
    return finished_rat(latest_work_orders(raw, strict), as_of, strict)


def finished_rat(latest: DataFrame, as_of: AsOf = None, strict: bool = True) -> DataFrame:
    """:func:`latest_work_orders` inside the date range, typed."""
    return latest.where(between_days(F.col("inspection_date"), fixed.EARLIEST_INSPECTION, as_of)).select(
        F.upper("inspection_type").alias("inspection_type"),
        to_int("job_ticket_or_work_order_id", strict).alias("work_order_id"),
        "job_id",
        to_int("job_progress", strict).alias("job_progress"),
        to_long("bbl", strict).alias("bbl"),
        to_int("boro_code", strict).alias("boro_code"),
        "block",
        "lot",
        "house_number",
        F.col("street_name").alias("street"),
        F.col("zip_code").alias("zipcode"),
        to_double("latitude", strict).alias("latitude"),
        to_double("longitude", strict).alias("longitude"),
        F.upper("borough").alias("borough"),
        "inspection_date",
        F.upper("result").alias("result"),
        "approved_date",
        to_int("bin", strict).alias("bin"),
        "nta",
        as_of_date(as_of).alias("extract_date"),
    )
