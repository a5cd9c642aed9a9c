"""The history of a description: which values held from when to when."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sitegrade.operators.line import ROWS_PER_BLOCK, carried, dealt, in_block, nearest, with_carried
from sitegrade.operators.temporal_joins import newest_per_instant
from sitegrade.sources.sinks import TableStore

BUCKETS = 16
BUCKET = "history_bucket"


def observations(rows: DataFrame, keys: Sequence[str], at: str, attributes: Sequence[str]) -> DataFrame:
    """``keys, at, attributes``: what is known of each key at each moment; of several descriptions the largest, column by column."""
    found = newest_per_instant(rows, keys, at, [], attributes)
    return found.select(*keys, F.col("_moment").alias(at), *[F.col(f"found.v_{c}").alias(c) for c in attributes])


def history(seen: DataFrame, store: TableStore, keys: Sequence[str], at: str, attributes: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK, name: str = "history") -> DataFrame:
    """``keys, attributes, valid_from, valid_to`` of :func:`observations`: one row for each stretch of equal values.

    A stretch begins with the first moment that differs from the one before and
    ends where the next begins; the last one is open (``valid_to`` is null).
    Nulls are values.  Keys of any size are cut into blocks, see
    :mod:`sitegrade.operators.line`.
    """
    line = dealt(seen, store, f"{name}_seen", keys, [at], rows_per_block)
    values = F.struct(*attributes)
    by_time = in_block(keys, at)
    before = with_carried(
        line.withColumns({"_before": F.lag(values).over(by_time), "_place": F.row_number().over(by_time)}), keys,
        carried(line, keys, F.max_by(values, at), nearest()),
    ).withColumn("_before", F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_before")))
    starts = before.where(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(values)).select("_block", *keys, at, *attributes)
    starts = store.save(starts, f"{name}_starts", "starts")
    ends = with_carried(
        starts.withColumn("_next", F.lead(at).over(by_time)), keys, carried(starts, keys, F.min(at), nearest(), forward=False)
    )
    return ends.select(*keys, *attributes, F.col(at).alias("valid_from"), F.coalesce("_next", "_carried").alias("valid_to"))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_history(
    rows: DataFrame, store: TableStore, keys: Sequence[str], at: str, attributes: Sequence[str], table: str,
    buckets: int = BUCKETS, rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Take a batch of rows into a stored history, and return the whole of it.

    Rows may come late, in any order and again: a late one splits the stretch it
    falls into, one that is known already changes nothing, so a batch whose run
    failed is simply given again.  What is known of each key and moment is stored
    beside the history, because a stretch does not tell where it was confirmed.
    Both lie in ``buckets`` folders by key; a batch reads and writes those of its
    keys, and works out the stretches of its keys only.
    """
    spark = rows.sparkSession
    batch = store.save(observations(rows, keys, at, attributes).withColumn(BUCKET, _bucket(keys, buckets)), "history", f"{table}_batch")
    touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
    own = batch.select(*keys).distinct()

    known = store.read_folders(spark, "history", f"{table}_seen", batch.schema)
    both = known.where(F.col(BUCKET).isin(touched)).unionByName(batch)
    seen = observations(both, keys, at, attributes).withColumn(BUCKET, _bucket(keys, buckets))
    fields = [f for f in batch.schema.fields if f.name not in (at, BUCKET)]
    moment = batch.schema[at].dataType
    schema = T.StructType([*fields, T.StructField("valid_from", moment), T.StructField("valid_to", moment), T.StructField(BUCKET, T.IntegerType())])
    if touched:
        store.save_folders(seen, "history", f"{table}_seen", BUCKET, touched)
        again = store.read_folders(spark, "history", f"{table}_seen", batch.schema).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        fresh = history(again.join(own, list(keys), "left_semi"), store, keys, at, attributes, rows_per_block, f"{table}_merge")
        before = store.read_folders(spark, "history", table, schema).where(F.col(BUCKET).isin(touched))
        kept = before.join(own, list(keys), "left_anti")
        store.save_folders(kept.unionByName(fresh.withColumn(BUCKET, _bucket(keys, buckets))), "history", table, BUCKET, touched)
    return store.read_folders(spark, "history", table, schema).drop(BUCKET)
