"""The two inspection feeds: declared schemas, landing files and the raw tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sitegrade import fixed_values as fixed


def _feed_schema(columns: list[str], structs: dict[str, list[str]]) -> T.StructType:
    def field_type(name: str) -> T.DataType:
        if name not in structs:
            return T.StringType()
        return T.StructType([T.StructField(part, T.StringType()) for part in structs[name]])

    return T.StructType([T.StructField(name, field_type(name)) for name in columns])


@dataclass(frozen=True)
class Feed:
    """A feed's raw table name and declared schema."""

    table: str
    schema: T.StructType


RESTAURANT_FEED = Feed("restaurant_inspection", _feed_schema(fixed.RESTAURANT_FEED_COLUMNS, {}))
RAT_FEED = Feed("rat_inspection", _feed_schema(fixed.RAT_FEED_COLUMNS, fixed.RAT_FEED_STRUCTS))

_LANDING_DIRS = {"json": "RAW/JSON", "parquet": "PARQUET"}


def landing_dir(store: str, date: str, fmt: str) -> str:
    """Folder of one day's landed files, ``date`` as ``yyyymmdd`` (or a glob)."""
    if fmt not in _LANDING_DIRS:
        raise ValueError(f"unknown landing format {fmt!r}; use one of {sorted(_LANDING_DIRS)}")
    return f"{store.rstrip('/')}/{date}/{_LANDING_DIRS[fmt]}"


def read_pages(spark: SparkSession, path: str, feed: Feed, arrays: bool = True) -> DataFrame:
    """Fetched pages with the declared schema; keys a record lacks are NULL.

    A page is one JSON array of records, parsed by one task; pages are bounded
    by the fetch size, so parallelism grows with their number.  ``arrays=False``
    reads one record per line, which Spark splits within a file.
    """
    return spark.read.schema(feed.schema).option("multiLine", arrays).json(path)


def conform(df: DataFrame, feed: Feed) -> DataFrame:
    """The feed's columns in order and type; missing ones NULL, extra ones dropped."""
    present = set(df.columns)

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`") if field.name in present else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in feed.schema.fields])


def land(df: DataFrame, feed: Feed, store: str, date: str, fmt: str = "parquet") -> str:
    """Append conformed records to a day's landing folder and return that folder."""
    folder = landing_dir(store, date, fmt)
    conform(df, feed).write.mode("append").format(fmt).save(folder)
    return folder


def read_landed(spark: SparkSession, feed: Feed, store: str, date: str = "*", fmt: str = "parquet") -> DataFrame:
    """A day's landed files by column name; a glob as ``date`` reads several days."""
    folder = landing_dir(store, date, fmt)
    if fmt == "json":
        return read_pages(spark, folder, feed, arrays=False)
    return spark.read.schema(feed.schema).parquet(folder)


def append_raw(spark: SparkSession, feed: Feed, store: str, date: str, raw_path: str) -> None:
    """Copy a day's landed parquet into the raw table.

    Running it twice appends twice, which the cleaning dedupes absorb; use
    :func:`sitegrade.streaming.landing.append_new_landings` to append each
    landed file once.
    """
    read_landed(spark, feed, store, date).write.mode("append").parquet(raw_path)


def read_raw(spark: SparkSession, feed: Feed, raw_path: str) -> DataFrame:
    return spark.read.schema(feed.schema).parquet(raw_path)
