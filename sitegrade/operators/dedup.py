"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Words of 64 bits that mark repeated keys, and the bits of a hash that number a word.
MARK_WORDS, MARK_BITS = 2**21, 21


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    tie_break: Sequence[str] = (),
    rank_column: str | None = None,
) -> DataFrame:
    """The newest row of each key; NULL keys form one key.

    ``tie_break`` columns, also descending, make the survivor the same on every
    run.  Filtering the row number to 1 lets Spark drop all but one row per key
    in each map task before the shuffle (``WindowGroupLimit``), so a key that
    holds a third of the rows sends one row per task.
    """
    order: list[Column] = [F.col(c).desc_nulls_last() for c in (*newest_first, *tie_break)]
    rank = rank_column or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1)
    return kept.withColumn(rank, F.col(rank).cast("bigint")) if rank_column else kept.drop(rank)


def latest_of_mostly_single(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    tie_break: Sequence[str] = (),
    rank_column: str | None = None,
) -> DataFrame:
    """:func:`latest_per_key` where most keys have one row: only rows whose key may have more are sorted and shuffled.

    A first pass reads the keys alone and marks those of several rows, see
    :func:`repeated_words`.  An unmarked row is the only one of its key and stays
    where it is; the marked ones, among them some that only share a bit, are
    ranked.  With many repeated keys all are ranked, at the cost of that pass.
    ``df`` is evaluated three times, twice of it with all columns, and must give
    the same rows each time.
    """
    rank = rank_column or "_rank"
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    marked = with_repeated(hashed, "_hash", repeated_words(hashed, "_hash"), "_repeated")
    ranked = latest_per_key(marked.where("_repeated").select(*df.columns), keys, newest_first, tie_break, rank)
    single = marked.where("not _repeated").select(*df.columns, F.lit(1).cast("bigint").alias(rank))
    both = ranked.unionByName(single)
    return both if rank_column else both.drop(rank)


def _word_and_bit(hash_column: str) -> tuple[Column, Column]:
    word = F.col(hash_column).bitwiseAND(F.lit(MARK_WORDS - 1))
    return word, F.shiftright(hash_column, MARK_BITS).bitwiseAND(F.lit(63)).cast("int")


def repeated_words(rows: DataFrame, hash_column: str) -> DataFrame:
    """A bitmap of the hashes that several rows have, as words of 64 bits: two million rows at most, however many hashes there are."""
    word, bit = _word_and_bit(hash_column)
    several = rows.groupBy(hash_column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    bits = several.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("_bit"))
    return bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def with_repeated(rows: DataFrame, hash_column: str, words: DataFrame, flag: str) -> DataFrame:
    """``rows`` with ``flag``: false only where ``words``, which are broadcast, say that no other row has the hash."""
    word, bit = _word_and_bit(hash_column)
    marked = rows.join(F.broadcast(words), word == F.col("_word"), "left")
    return marked.select(*rows.columns, (F.coalesce(F.getbit("_bits", bit), F.lit(0)) == 1).alias(flag))
