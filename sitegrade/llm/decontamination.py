"""Benchmark decontamination: size-partitioned MinHash containment search, verified on the shingles themselves.

An item of q shingles is contained in a document if the document has t q of
them, so it may miss at most q - ceil(t q).  Of the item's q - ceil(t q) + 1
smallest hash values, its bottom-k MinHash sketch, the document then holds one
at least, however long it is: no contained item is ever missed.  How many
values that takes, and so how far up the hash range they reach, depends on the
item's size.  Items are therefore partitioned by size, and each partition's cut
is the largest value in its sketches.  To each partition, a document with enough
shingles to contain an item of it gives its hashes up to that partition's cut;
values that are equal within a partition make candidates, which are verified.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, functions as F

from sitegrade.llm.common import SHINGLE_WORDS, scratch, stored

CONTAINMENT = 0.8
LAST_ID = (1 << 63) - 1


def word_array(text: str = "text") -> Column:
    """Runs of letters and digits, lower-cased; a text without any gives an empty array."""
    spaced = F.btrim(F.regexp_replace(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _starts(words: Column, size: int) -> Column:
    """Where runs of ``size`` words start; nowhere in a text of fewer words."""
    count = F.size(words) - size + 1
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column, size: int = SHINGLE_WORDS) -> Column:
    return F.transform(_starts(words, size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


def shingle_texts(words: Column, size: int = SHINGLE_WORDS) -> Column:
    return F.transform(_starts(words, size), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(size)]))


def _own_size(of, words: Column) -> Column:
    """Shingles of five words; of a text of one to four words, the one of all its words."""
    out = of(words, SHINGLE_WORDS)
    for size in range(1, SHINGLE_WORDS):
        out = F.when(F.size(words) == size, of(words, size)).otherwise(out)
    return out


def item_sketches(items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``item_id, n_words, size_class, shingles, sketch`` of each item that has a word; items of one text and id count once."""
    words = items.select("item_id", word_array().alias("words")).where(F.size("words") > 0).distinct()
    hashed = words.select(
        "item_id",
        F.least(F.size("words"), F.lit(SHINGLE_WORDS)).alias("n_words"),
        F.array_distinct(_own_size(shingle_texts, F.col("words"))).alias("shingles"),
        F.array_sort(F.array_distinct(_own_size(shingle_hashes, F.col("words")))).alias("hashes"),
    )
    size = F.size("hashes")
    least = size - F.ceil(size * F.lit(containment) - 1e-9) + 1
    return hashed.select("item_id", "n_words", F.floor(F.log2(size)).cast("int").alias("size_class"), "shingles", F.slice("hashes", 1, least.cast("int")).alias("sketch"))


def _ids() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row")]


def _given(parts: list[Row], containment: float) -> Column:
    """``part, hash`` for each partition and each hash of the document up to its cut; a document of too few shingles for the partition's smallest item gives none."""
    none = F.array().cast("array<struct<part:struct<n_words:int,size_class:int>,hash:bigint>>")

    def of_part(n_words: int, size_class: int, cut: int) -> Column:
        own = F.struct(F.lit(n_words).alias("n_words"), F.lit(size_class).alias("size_class")).alias("part")
        hashes, least = F.col(f"of_{n_words}"), math.ceil(containment * 2**size_class - 1e-9)
        pairs = F.transform(F.filter(hashes, lambda h: h <= F.lit(cut)), lambda h: F.struct(own, h.alias("hash")))
        return F.when(F.size(hashes) >= least, pairs).otherwise(none)

    return F.concat(none, *[of_part(*part) for part in sorted(parts)])


def contained_items(docs: DataFrame, items: DataFrame, folder: str | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """``doc_id, row, item_id, n_item, n_shared, containment`` for each document and each item it contains.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``.  Containment
    is the share of the item's distinct five-word shingles (words lower-cased,
    without punctuation) that the document has; an item of one to four words is
    one shingle of its words, and contained where they follow each other.  Items
    without a word are in no document, documents without a word hold no item.

    Null texts count as empty, a null document id as one of its own.  Rows with
    equal id and text give one row for each item; ``row`` is a hash of the text,
    which tells rows of one id apart.  Two items of one id and different texts are
    two items.  Empty tables give no rows; other columns are not read.
    """
    folder = folder or scratch(docs.sparkSession)
    items = stored(item_sketches(items, containment).withColumn("item", F.xxhash64("item_id", "shingles")), folder, "items")
    part = F.struct("n_words", "size_class")
    parts = items.groupBy("n_words", "size_class").agg(F.max(F.element_at("sketch", -1)).alias("cut")).collect()  # at most 31 classes of five words, one each of fewer
    sizes = sorted({p.n_words for p in parts})
    sketch = items.select("item", part.alias("part"), F.explode("sketch").alias("hash"))
    words = docs.select(*_ids(), word_array().alias("words"))
    hashed = words.select("doc", "row", *[shingle_hashes(F.col("words"), n).alias(f"of_{n}") for n in sizes])
    values = hashed.select("doc", "row", F.explode(_given(parts, containment)).alias("value")).select("doc", "row", "value.part", "value.hash")
    candidates = values.join(sketch, ["part", "hash"]).groupBy("doc", "row", "item").agg(F.count(F.lit(1)).alias("agree"))
    candidates = stored(candidates.drop("agree"), folder, "candidates")

    # Each candidate costs the shingles of its item and each document its own once, however many items it may hold.
    items_at = items.select("item", "item_id", F.size("shingles").alias("n_item"), F.explode("shingles").alias("shingle"))
    wanted = candidates.join(items_at.drop("item_id", "n_item"), "item")
    of_documents = docs.select(*_ids(), "text").join(candidates.select("doc", "row").distinct(), ["doc", "row"], "left_semi").dropDuplicates(["doc", "row"])
    all_shingles = F.concat(F.array().cast("array<string>"), *[shingle_texts(F.col("words"), n) for n in sizes])
    held = of_documents.select("doc", "row", word_array().alias("words")).select("doc", "row", F.explode(F.array_distinct(all_shingles)).alias("shingle"))
    held = held.join(items_at.select("shingle").distinct(), "shingle", "left_semi")
    shared = wanted.join(held, ["doc", "row", "shingle"]).groupBy("doc", "row", "item").agg(F.count(F.lit(1)).cast("int").alias("n_shared"))
    named = items_at.select("item", "item_id", "n_item").distinct()
    verified = shared.join(named, "item").select(F.when(F.col("doc") < LAST_ID, F.col("doc")).alias("doc_id"), "row", "item_id", "n_item", "n_shared")
    return verified.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("containment") >= containment - 1e-9)


def without_contaminated(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    doc, row = _ids()
    found = hits.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("__doc"), F.col("row").alias("__row")).distinct()
    return docs.withColumns({"__doc": doc, "__row": row}).join(found, ["__doc", "__row"], "left_anti").drop("__doc", "__row")
