"""Event-time windows over a stream of files, with a rule for rows that come late."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery


def windowed(events: DataFrame, at: str, width: str, delay: str, ids: Sequence[str], keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """``window_start, window_end, keys, measures`` of a stream; a window comes out once, when no row of it is awaited any more.

    The watermark is the newest time of earlier batches less ``delay``.  A row
    behind it is late and left out, and a row whose ``ids`` were seen within
    ``delay`` is a repeat and left out; both are judged row by row, before any
    sum, so their number is exact (:func:`late_rows`).  A row that is not late
    lies in a window that is still open.  So as long as no row is late, the order
    of the files makes no difference.

    State holds the ids of the last ``delay`` and one row for each open window
    and key, whatever the length of the stream.
    """
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    counted = timed.dropDuplicatesWithinWatermark(list(ids)).groupBy(F.window(at, width).alias("window"), *keys)
    found = counted.agg(*[measure.alias(name) for name, measure in measures.items()])
    return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *measures)


class Progress(NamedTuple):
    rows: int
    late: int


def late_rows(query: StreamingQuery) -> Progress:
    """Rows that a run has read, and how many of them were late: those that its first stateful step, the one of single rows, left out."""
    batches = query.recentProgress
    # The steps are listed from the last to the first.
    late = sum(batch["stateOperators"][-1]["numRowsDroppedByWatermark"] for batch in batches if batch["stateOperators"])
    return Progress(sum(batch["numInputRows"] for batch in batches), late)


def run(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, files_per_batch: int | None = None, **window) -> tuple[DataFrame, Progress]:
    """Take in all parquet files of ``source`` that earlier runs did not, and return all closed windows and this run's progress.

    ``window`` is what :func:`windowed` takes.  ``checkpoint`` holds the state
    and must lie on shared storage; a run that is stopped goes on from the last
    batch that ended, and each window is written once.
    """
    files = spark.readStream.schema(schema)
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", files_per_batch)
    closed = windowed(files.parquet(source), **window)
    query = (
        closed.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(closed.schema).parquet(target), late_rows(query)
