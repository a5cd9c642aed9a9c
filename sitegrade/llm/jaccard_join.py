"""Self-join of documents by the Jaccard similarity of their word shingles, pruned by Bayesian inference on MinHash values.

1.  Every text gets a class key (equal words in equal order), its number of
    shingles and a MinHash signature.  One row of each class goes on.
2.  Signatures are cut into bands.  Classes that agree in a band are candidates;
    the candidates' graph falls apart into components, each held by stars, so
    no pairs are written.
3.  The shingles of a component meet in one task.  A large component is cut into
    blocks, near classes in the same one if they fit, and a class is sent only
    to the blocks that hold a candidate of it.  In a task the pairs that agree
    in a band are compared a few MinHash values at a time.  A pair is dropped as
    soon as the posterior probability that its similarity reaches the threshold
    is below the tolerance.  The pairs that are left are verified on their
    shingles.
4.  A task returns, for each class, its number of links and one edge of a
    spanning forest; the groups are the components of these edges.

Candidates miss a pair of similarity s with probability (1 - s^4)^24, at 0.8
three in a million.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sitegrade.llm.common import WordHashes, _mix, scratch, shingles, stored, words
from sitegrade.llm.components import components

THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, BAND_ROWS = 24, 4
HASHES = BANDS * BAND_ROWS
STEP = 16
BLOCK_SHINGLES = 1_000_000
CLASS_SHINGLES = 2 * HASHES  # what a class takes besides its shingles: signature and buckets
LAST_ID = (1 << 63) - 1

_rng = np.random.default_rng(20090501)
_FACTORS = _rng.integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _rng.integers(0, 1 << 62, HASHES, dtype=np.uint64)


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set of 64-bit shingle hashes."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 2048):
        part = found[at : at + 2048]
        np.minimum(out, (part[None, :] * _FACTORS[:, None] + _TERMS[:, None]).min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def band_buckets(signatures: np.ndarray) -> np.ndarray:
    """For each signature and band, a 64-bit hash of the band's number and values."""
    bands = signatures.reshape(len(signatures), BANDS, BAND_ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for k in range(BAND_ROWS):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return out.astype(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, step: int = STEP, hashes: int = HASHES) -> dict[int, int]:
    """After n values, how many must agree: with fewer, the posterior (uniform prior) of reaching the threshold is below the tolerance."""
    least = {}
    for n in range(step, hashes + 1, step):
        # P(similarity >= t | m of n agree) = P(Binomial(n + 1, t) <= m)
        below = 0.0
        for m in range(n + 2):
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                least[n] = m
                break
    return least


def class_key(text: str, found: list[str]) -> bytes:
    """Equal for texts of the same words in the same order; texts without a word share it only if they are equal."""
    return xxhash.xxh3_128_digest((" ".join(found) if found else "\n" + text).encode())


def candidate_pairs(signatures: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js) for each signature i with signatures js of a higher number that agree with it in a band; the work grows with these pairs."""
    buckets = band_buckets(signatures).ravel()
    order = np.argsort(buckets, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(buckets[order])) + 1, len(order))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    until = ends[np.searchsorted(ends, place, side="right")].reshape(-1, BANDS)
    after, members = (place + 1).reshape(-1, BANDS), order // BANDS
    several = after < until
    seen = np.zeros(len(signatures), dtype=bool)
    for i in np.flatnonzero(several.any(axis=1)).tolist():
        found = np.concatenate([members[x:y] for x, y in zip(after[i, several[i]].tolist(), until[i, several[i]].tolist())])
        if len(found) * 8 < len(seen):
            js = np.unique(found)
        else:
            seen[found] = True
            js = np.flatnonzero(seen)
            seen[js] = False
        yield i, js


def linked_pairs(sets: list[np.ndarray], pairs_of: np.ndarray, same: bool, threshold: float = THRESHOLD) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js) for each set i with linked sets js of a higher number, from another block unless ``same``."""
    sizes = np.array([len(s) for s in sets])
    signatures = np.stack([signature(s) for s in sets])
    least = least_matches(threshold)
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1].ravel()
    starts = np.concatenate([[0], np.cumsum(sizes)])
    held = np.zeros(int(numbers.max()) + 1, dtype=np.int32)
    for i, js in candidate_pairs(signatures):
        if not same:
            js = js[pairs_of[js] != pairs_of[i]]
        js = js[np.minimum(sizes[js], sizes[i]) >= threshold * np.maximum(sizes[js], sizes[i]) - 1e-9]
        agree = np.zeros(len(js), dtype=np.int32)
        for n, needed in least.items():
            agree += (signatures[js, n - STEP : n] == signatures[i, n - STEP : n]).sum(axis=1, dtype=np.int32)
            js, agree = js[agree >= needed], agree[agree >= needed]
            if not len(js):
                break
        if not len(js):
            continue
        own = numbers[starts[i] : starts[i + 1]]
        held[own] = 1
        common = np.array([held[numbers[starts[j] : starts[j + 1]]].sum() for j in js])
        held[own] = 0
        linked = js[common >= threshold * (sizes[js] + sizes[i] - common) - 1e-9]
        if len(linked):
            yield i, linked


def _ids() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row")]


def sketches(docs: DataFrame) -> DataFrame:
    """``doc, row, key, n, signature`` of every row; no signature for texts without a word."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, sizes, signatures = [], [], []
                for text in part.column(2).to_pylist():
                    found = words(text)
                    own = shingles(hashes(found))
                    keys.append(class_key(text or "", found))
                    sizes.append(len(own))
                    signatures.append(signature(own).tobytes() if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())],
                    names=["doc", "row", "key", "n", "signature"],
                )

    return docs.select(*_ids(), F.col("text").cast("string")).mapInArrow(sketch, "doc long, row long, key binary, n long, signature binary")


def _candidates(classes: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """``key, hubs, first`` of the classes that agree with another in a band, and ``node, label``: the components of their hubs."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                signatures = np.stack([np.frombuffer(s, dtype=np.uint32) for s in batch.column(1).to_pylist()])
                out = band_buckets(signatures)
                keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(out)), BANDS)))
                yield pa.RecordBatch.from_arrays([keys, pa.array(out.ravel())], names=["key", "bucket"])

    bands = classes.where("n > 0").select("key", "signature").mapInArrow(buckets, "key binary, bucket long")
    hubs = bands.groupBy("bucket").agg(F.min("key").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket", "hub")
    hubs = stored(hubs, folder, "hubs")
    # A class lies in at most one bucket a band.  Joining its hubs to the smallest of them leaves a graph of hubs alone.
    near = bands.join(hubs, "bucket").groupBy("key").agg(F.collect_set("hub").alias("hubs")).select("key", "hubs", F.array_min("hubs").alias("first"))
    near = stored(near, folder, "near")
    edges = near.select(F.explode("hubs").alias("a"), F.col("first").alias("b")).distinct()
    return near, components(edges, f"{folder}/candidates")


def _one_of_equal_rows(texts: DataFrame, folder: str) -> DataFrame:
    """``doc, row, text`` without repeats, which could fill a task: counted by their names first, so that only repeated rows are grouped."""
    repeated = texts.groupBy("doc", "row").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("doc", "row")
    repeated = stored(repeated, folder, "repeated")
    if repeated.isEmpty():
        return texts
    once = texts.join(repeated, ["doc", "row"], "left_semi").groupBy("doc", "row").agg(F.first("text").alias("text"))
    return texts.join(repeated, ["doc", "row"], "left_anti").unionByName(once)


def _members(classes: DataFrame, near: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """``doc, row, key, n, component, block, others``: where each class goes, and the blocks that hold a candidate of it (its own, too).

    Classes of one first hub share a block, or as many as they fill.  Candidates
    share a hub, so the blocks of a class's hubs are all that it must meet.
    """
    load = F.col("n") + F.lit(CLASS_SHINGLES)
    filled = lambda total: F.ceil(total / BLOCK_SHINGLES).cast("int")
    members = classes.select("key", "doc", "row", "n").join(near.select("key", "first"), "key")
    firsts = members.groupBy("first").agg(F.sum(load).alias("load")).join(labels.withColumnRenamed("node", "first"), "first", "left")
    firsts = stored(firsts.select("first", "load", F.coalesce("label", "first").alias("component")), folder, "firsts")
    sizes = stored(firsts.groupBy("component").agg(filled(F.sum("load")).alias("blocks")), folder, "sizes")
    firsts = stored(firsts.join(sizes, "component").select("first", "component", "blocks", filled(F.col("load")).alias("span")), folder, "spans")
    block = F.pmod(F.xxhash64("first") + F.pmod(F.xxhash64("key"), "span"), "blocks").cast("int")
    members = stored(members.join(firsts, "first").select("doc", "row", "key", "n", "component", "blocks", block.alias("block")), folder, "members")
    own = members.withColumn("others", F.array("block"))
    if sizes.where("blocks > 1").isEmpty():
        return own
    held = members.where("blocks > 1").select("key", "block").join(near.select("key", F.explode("hubs").alias("hub")), "key")
    held = stored(held, folder, "held")
    met = stored(held.select("hub", F.col("block").alias("other")).distinct(), folder, "met")
    others = stored(held.join(met, "hub").groupBy("key").agg(F.collect_set("other").alias("others")), folder, "others")
    return own.where("blocks = 1").unionByName(members.where("blocks > 1").join(others, "key"))


def _verify(docs: DataFrame, members: DataFrame, folder: str, threshold: float) -> DataFrame:
    """``key, links, parent`` of each linked class and task."""
    load = members.agg(F.coalesce(F.sum((F.col("n") + F.lit(CLASS_SHINGLES)) * F.size("others")), F.lit(0))).first()[0]
    packs = max(1, math.ceil(load / BLOCK_SHINGLES))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = [shingles(hashes(words(text))).tobytes() for text in part.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(own, pa.binary())], names=["component", "key", "block", "others", "shingles"])

    texts = _one_of_equal_rows(docs.select(*_ids(), F.col("text").cast("string")), folder)
    texts = texts.join(members.select("doc", "row", "component", "key", "block", "others"), ["doc", "row"])
    sets = texts.select("component", "key", "block", "others", "text").mapInArrow(shingled, "component binary, key binary, block int, others array<int>, shingles binary")
    met = sets.withColumn("other", F.explode("others"))
    met = met.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    met = met.withColumn("pack", F.pmod(F.xxhash64("component", "low", "high"), F.lit(packs)))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for (_, low, high), part in pdf.groupby(["component", "low", "high"], sort=False):
            if len(part) < 2:
                continue
            sets = [np.frombuffer(s, dtype=np.uint64) for s in part.shingles]
            keys, links, parent = part.key.tolist(), np.zeros(len(part), dtype=np.int64), list(range(len(part)))

            def root(i: int) -> int:
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            for i, js in linked_pairs(sets, part.block.to_numpy(), low == high, threshold):
                links[i] += len(js)
                links[js] += 1
                for j in js.tolist():
                    parent[root(j)] = root(i)
            rows += [(keys[i], int(links[i]), keys[root(i)]) for i in np.flatnonzero(links).tolist()]
        return pd.DataFrame(rows, columns=["key", "links", "parent"])

    return met.select("pack", "component", "low", "high", "block", "key", "shingles").groupBy("pack").applyInPandas(link, "key binary, links long, parent binary")


def jaccard_groups(docs: DataFrame, folder: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, row, class_id, n_copies, n_links, group_id, group_key``.

    Rows whose texts have the same words in the same order form a class, named
    by its smallest id, of ``n_copies`` rows.  ``n_links`` counts the other
    classes of similarity ``threshold`` or more, by the sets of five-word
    shingles (a text of one to four words is one shingle).  ``group_id`` is the
    smallest id of all classes that links connect; groups without an id, or with
    an id that other texts bear, too, share it, so ``group_key`` names the group:
    the smallest class key in it.  ``row`` is a hash of the text and names the
    row together with its id.

    Null texts count as empty.  Texts without a word have no shingles and no
    links; equal ones are copies.  A null id counts as the largest.  Repeated
    rows are copies; an empty table gives no rows; other columns are not read.
    """
    folder = folder or scratch(docs.sparkSession)
    sketched = stored(sketches(docs), folder, "sketches")
    first = F.min(F.struct("doc", "row", "n", "signature")).alias("first")
    classes = sketched.groupBy("key").agg(first, F.count(F.lit(1)).alias("n_copies")).select("key", "first.*", "n_copies")
    classes = stored(classes, folder, "classes")
    members = _members(classes, *_candidates(classes, folder), folder)
    found = stored(_verify(docs, members, folder, threshold), folder, "links")
    groups = components(found.select(F.col("key").alias("a"), F.col("parent").alias("b")), f"{folder}/groups")
    links = found.groupBy("key").agg(F.sum("links").alias("n_links"))
    named = classes.join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    named = stored(named.select("key", "label", "doc", "n_copies").join(links, "key", "left"), folder, "named")
    owners = stored(named.groupBy("label").agg(F.min("doc").alias("group_id")), folder, "owners")
    per_class = stored(
        named.join(owners, "label").select("key", F.col("doc").alias("class_id"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), "group_id", F.col("label").alias("group_key")),
        folder, "per-class",
    )
    own = lambda c: F.when(F.col(c) < LAST_ID, F.col(c)).alias(c)
    return sketched.join(per_class, "key").select(own("doc").alias("doc_id"), "row", own("class_id"), "n_copies", "n_links", own("group_id"), "group_key")


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one of the smallest id, of equal ids the one of the smaller hash."""
    doc, row = _ids()
    # Not by group_id: groups without an id, or of unlike texts under one id, share it.
    first = groups.groupBy("group_key").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), "row")).alias("first"))
    named = docs.withColumns({"__doc": doc, "__row": row})
    kept = named.join(first.select(F.col("first.doc").alias("__doc"), F.col("first.row").alias("__row")), ["__doc", "__row"], "left_semi")
    return kept.dropDuplicates(["__doc", "__row"]).drop("__doc", "__row")
