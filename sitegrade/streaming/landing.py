"""Append landed files to the raw table exactly once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from sitegrade.sources.feeds import Feed, landing_dir


def append_new_landings(
    spark: SparkSession,
    feed: Feed,
    store: str,
    raw_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start a run that appends every landed parquet file not appended before, then stops.

    ``checkpoint`` remembers the files across runs and must lie on shared
    storage; the file sink commits each batch atomically, so a restarted run
    neither loses nor repeats a file.  Readers of ``raw_path`` then see only what
    streams committed, so do not mix it with :func:`sitegrade.sources.feeds.append_raw`.
    """
    source = spark.readStream.schema(feed.schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    landed = source.parquet(landing_dir(store, "*", "parquet"))
    return (
        landed.writeStream.format("parquet")
        .option("path", raw_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
