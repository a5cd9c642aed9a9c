"""Hand-made feed rows: a plain record with the given fields changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitegrade.sources.feeds import RAT_FEED, RESTAURANT_FEED

AS_OF = "2024-07-01"

VIOLATION = {
    "camis": "1", "dba": "Cafe", "boro": "Bronx", "building": "10", "street": "Main St",
    "zipcode": "10001", "phone": "555", "inspection_date": "2024-06-01T00:00:00.000",
    "critical_flag": "Critical", "record_date": "2024-06-02T00:00:00.000", "bin": "100",
    "bbl": "2000010001", "nta": "BX01", "cuisine_description": "Coffee", "action": "cited",
    "violation_code": "04A", "violation_description": "none", "score": "12", "grade": "A",
    "grade_date": "2024-06-01T00:00:00.000", "latitude": "40.5", "longitude": "-73.5",
    "inspection_type": "Cycle",
}

INSPECTION = {
    "inspection_type": "Initial", "job_ticket_or_work_order_id": "7", "job_id": "PC7",
    "job_progress": "1", "bbl": "2000010001", "boro_code": "2", "block": "1", "lot": "1",
    "house_number": "10", "street_name": "Main St", "zip_code": "10001", "latitude": "40.5",
    "longitude": "-73.5", "borough": "Bronx", "inspection_date": "2024-06-01T00:00:00.000",
    "result": "Passed", "approved_date": "2024-06-03T00:00:00.000", "bin": "100", "nta": "BX01",
}


def violations(spark: SparkSession, *changes: dict) -> DataFrame:
    return spark.createDataFrame([{**VIOLATION, **c} for c in changes], RESTAURANT_FEED.schema)


def inspections(spark: SparkSession, *changes: dict) -> DataFrame:
    return spark.createDataFrame([{**INSPECTION, **c} for c in changes], RAT_FEED.schema)


def values(df: DataFrame, *columns: str) -> list:
    """Sorted rows as tuples, or bare values for a single column."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted((r[0] if len(columns) == 1 else r for r in rows), key=repr)
