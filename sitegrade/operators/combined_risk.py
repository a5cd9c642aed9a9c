"""Restaurant and building scores combined into one score and category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitegrade import fixed_values as fixed
from sitegrade.functions.scoring import capped_weighted_score, risk_category


def combined_score() -> Column:
    return capped_weighted_score([(F.col(name), weight) for name, weight in fixed.COMBINED_WEIGHTS.items()])


def risk_model(restaurants: DataFrame, buildings: DataFrame) -> DataFrame:
    """Every establishment with each building description of its building number.

    A building number described k times yields k rows.  Establishments without
    rat inspections keep NULL rat scores, which count 0.
    """
    rats = buildings.where(F.col("bin").isNotNull()).select(
        "bin",
        F.col("bin_rr_score").alias("bin_rat_score"),
        F.col("street_rr_score").alias("street_rat_score"),
        F.col("zip_rr_score").alias("zip_rat_score"),
    )
    return (
        restaurants.join(rats, "bin", "left")
        .withColumn("rat_risk_score", combined_score())
        .withColumn("risk_category", risk_category(F.col("rat_risk_score")))
        .select(
            "camis", "dba", "boro", "building", "bin", "cuisine_description", "latitude", "longitude",
            "zipcode", "most_recent_inspection_date", "restaurant_risk_score", "street_risk_score",
            "zip_risk_score", "bin_rat_score", "street_rat_score", "zip_rat_score", "rat_risk_score",
            "risk_category", "extract_date",
        )
    )


def risk_category_counts(model: DataFrame) -> DataFrame:
    return model.groupBy("risk_category").agg(F.count(F.lit(1)).alias("rows"))


def ranked(df: DataFrame, score: str, *tie_break: str) -> DataFrame:
    """Whole table by descending score, for presentation; tables are written unsorted."""
    return df.orderBy(F.col(score).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break])
