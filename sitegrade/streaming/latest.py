"""The newest row of each key of a stream, kept in state that expires."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sitegrade.operators.dedup import latest_per_key

_STATE = "newest string"
_NEWS = "row string"
BUCKETS = 16_384


def _rank(order: Sequence[str | None]) -> tuple:
    """Sorts as descending columns with nulls last do: a null is the smallest."""
    return tuple((value is not None, value or "") for value in order)


def newest_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], keep: timedelta, buckets: int = BUCKETS) -> DataFrame:
    """A stream of ``rows`` that were the newest of their key when they came, by ``order`` (as text, largest first).

    State holds one order for each key; it is dropped when its key has been quiet
    for ``keep``, by the time at which rows arrive.  That time is also the
    watermark, so no row is ever dropped as late, however old its own dates are.  A key that comes back after that sends its newest row again, as
    the first of a new state; whoever reads the news takes the newest of them
    (:func:`newest_of`), so that an expired key loses nothing.

    A call of Python for each key would cost milliseconds a key.  So keys share
    ``buckets`` states by their hash, and one call goes through all rows of a
    bucket.  A checkpoint is bound to its number of buckets; a bucket's state, a
    few hundred bytes a key, is written whole when a row of it comes.
    """
    milliseconds = keep // timedelta(milliseconds=1)

    def advance(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = json.loads(state.get[0]) if state.exists else {}  # key -> time of its last row, order
        held = {key: kept for key, kept in held.items() if kept[0] + milliseconds >= now}
        best, news = {}, {}
        if not state.hasTimedOut:
            for part in parts:
                for key, arrived, given, row in zip(part["key"], part["arrived_ms"], part["order"], part["row"]):
                    if key not in best:
                        best[key] = _rank(json.loads(held[key][1])) if key in held else None
                    rank = _rank(json.loads(given))
                    if best[key] is None or rank > best[key]:
                        best[key], news[key] = rank, row
                        held[key] = [max(int(arrived), now), given]
                    else:
                        held[key][0] = max(int(arrived), held[key][0])
        if not held:
            state.remove()
            return
        state.update((json.dumps(held),))
        state.setTimeoutTimestamp(max(min(kept[0] for kept in held.values()) + milliseconds, now + 1))
        if news:
            yield pd.DataFrame({"row": list(news.values())})

    texts = F.to_json(F.array(*[F.col(c).cast("string") for c in order]), {"ignoreNullFields": "false"})
    packed = rows.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "0 seconds").select(
        "arrived", F.unix_millis("arrived").alias("arrived_ms"),
        F.to_json(F.array(*[F.col(c).cast("string") for c in keys]), {"ignoreNullFields": "false"}).alias("key"),
        texts.alias("order"), F.to_json(F.struct(*rows.columns)).alias("row"),
    ).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    return packed.groupBy("bucket").applyInPandasWithState(advance, _NEWS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run(
    spark: SparkSession, rows: DataFrame, keys: Sequence[str], newest_first: Sequence[str], tie_break: Sequence[str], target: str, checkpoint: str, keep: timedelta
) -> DataFrame:
    """Take in what the stream ``rows`` has that earlier runs did not, and return the newest row of every key so far.

    ``checkpoint`` holds the state and must lie on shared storage; a run that is
    stopped goes on from the last batch that ended.  ``target`` gets the news,
    which are fewer than the rows; the newest of them are the newest of all rows.
    """
    news = newest_rows(rows, keys, [*newest_first, *tie_break], keep)
    query = (
        news.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return newest_of(spark, target, rows.schema, keys, newest_first, tie_break)


def newest_of(spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str], newest_first: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """The newest row of every key among the news in ``target``."""
    news = spark.read.schema(_NEWS).parquet(target)
    return latest_per_key(news.select(F.from_json("row", schema).alias("row")).select("row.*"), keys, newest_first, tie_break)
