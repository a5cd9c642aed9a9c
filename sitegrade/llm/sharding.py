"""Two-pass external shuffle of documents into shards of equal row counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitegrade.llm.common import scratch, stored

BUCKET_BYTES = 16 << 20
_GROUP = 4096


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text, none for a null one, plus one."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")


def running_offsets(counts: DataFrame, key: str, value: str, offset: str) -> DataFrame:
    """``counts`` with the sum of ``value`` over all smaller ``key``; no task holds more than a group of keys."""
    grouped = counts.withColumn("__group", F.floor(F.col(key) / _GROUP))
    groups = grouped.groupBy("__group").agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("__group", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__group").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    within = grouped.withColumn("__within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return within.join(groups, "__group").withColumn(offset, F.col("__before") + F.col("__within")).drop("__group", "__before", "__within")


def _numbered(docs: DataFrame, folder: str) -> DataFrame:
    """``__row, __key, __other, __number, __size``: rows of equal content are numbered.

    Equal rows are the same to any reader, so they are not numbered one by one
    but counted, before the shuffle as well, and made again from one of them.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*own).alias("__row"), F.xxhash64(*own).alias("__key"), F.xxhash64(F.lit("other"), *own).alias("__other"), text_size().alias("__size"))
    key = ["__key", "__other"]
    repeated = stored(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"), folder, "repeated")
    number = F.lit(0).cast("long").alias("__number")
    if repeated.isEmpty():
        return keyed.select("*", number)
    single = keyed.join(repeated, key, "left_anti").select("*", number)
    one = keyed.join(repeated, key).groupBy(*key, "__n").agg(F.first("__row").alias("__row"), F.first("__size").alias("__size"))
    copies = one.select("__row", *key, "__size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)).alias("__number"))
    return single.unionByName(copies)


def shuffled_shards(docs: DataFrame, shards: int, seed: int, folder: str | None = None, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows of ``docs``, written in random order to ``shards`` shard folders, and read back.

    Pass one scatters the rows by a seeded hash into buckets that fit in the
    memory of a task; bucket k goes to task k.  Pass two shuffles each bucket
    (``shuffle`` of an array is Spark's Fisher-Yates), lines the buckets up and
    cuts the line into shards whose row counts are at most one apart.  The hash
    covers the whole content and the number of a row among those of equal
    content, so rows with one id, or without an id, and repeated rows scatter
    like any others.  Everything follows from the content of the rows, not from
    the files or tasks they come from: buckets are put in order of content before
    they are shuffled, so a retried task does the same again.

    Returns the columns of ``docs`` with ``shard`` and ``slot`` (gapless from 0
    in each shard); the files lie under ``folder`` (default: scratch), one
    folder for each shard, in order of the slot.  Equal texts are rows like any
    others and spread evenly.  An empty table gives no rows; null ids and texts
    stay as they are; columns of ``docs`` called ``shard`` or ``slot`` are
    replaced.  Columns must be of types that can be ordered.
    """
    docs, folder = docs.drop("shard", "slot"), folder or scratch(docs.sparkSession)
    numbered = _numbered(docs, folder)
    keyed = numbered.select("__row", F.xxhash64(F.lit(seed), "__key", "__other", "__number").alias("__order"), "__size")
    # Narrow: sizes and counts of the buckets are taken over hashes alone.
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(text_size()), F.lit(0))).first()
    buckets = max(1, math.ceil(size / bucket_bytes))
    bucket = F.pmod("__order", F.lit(buckets)).cast("int")
    counts = keyed.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = stored(running_offsets(counts, "__bucket", "__rows", "__offset").select("__bucket", "__offset"), folder, "offsets")
    filled = (
        keyed.select(bucket.alias("__bucket"), "__order", "__row")
        .repartitionById(buckets, F.col("__bucket"))
        .groupBy("__bucket")
        .agg(F.sort_array(F.collect_list(F.struct("__order", "__row"))).alias("__rows"))
        .join(offsets, "__bucket")
        .sortWithinPartitions("__bucket")
        .select("__offset", F.posexplode(F.shuffle("__rows", seed)).alias("__at", "__item"))
    )
    place = F.col("__offset") + F.col("__at")
    shard = F.expr(f"((__place + 1) * {shards} - 1) div {max(rows, 1)}")
    placed = filled.select(place.alias("__place"), "__item.__row.*").withColumn("shard", shard.cast("int"))
    slot = F.col("__place") - F.expr(f"cast(shard as bigint) * {rows} div {shards}")
    out = placed.withColumn("slot", slot).drop("__place").sortWithinPartitions("shard", "slot")
    return stored(out, folder, "shards", partition_by=("shard",))
