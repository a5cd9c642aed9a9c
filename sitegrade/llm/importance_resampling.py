"""Quality selection by importance resampling over hashed n-gram models.

Two generative models of hashed word n-grams are counted: one of the raw
corpus, one of the target, the labelled documents of good quality that are not
toxic.  The log ratio of an n-gram's probabilities, smoothed by the same
pseudo-count in both, says how much it speaks for the target.  A document's log
importance weight is the mean of its n-grams' log ratios, those above zero
counted as zero (a common word must not outweigh a bad one), for a text of a
fixed length, under models that leave out the document itself.  Documents are
drawn without replacement by Gumbel top-k: add Gumbel noise to the log weights
and keep the k highest.  k is the number of documents whose weight is above the
cut that parts good from bad best among the labelled documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sitegrade.llm.common import WordHashes, _mix, scratch, stored

BUCKETS = 1 << 20  # of each order; also what bounds the models' size on every executor
ORDERS = (1, 2)
PSEUDO_COUNTS = {1: 2.0, 2: 20.0}
ORDER_WEIGHTS = {1: 1.0, 2: 0.3}
PRIOR_NGRAMS = 8  # neutral n-grams added to each document, so a few words decide little
TEXT_NGRAMS = 2048  # length for which weights are stated; the longer, the less the noise decides
LABELLED = 400_000  # most labelled documents used, by smallest hash of the id
SEED = 20230206
LAST_ID = (1 << 63) - 1

_CHUNK = 1 << 16
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_RAW, _GOOD, _BAD = 0, 1, 2  # role: not labelled; in the target; labelled, but not in it


class Selection(NamedTuple):
    scored: DataFrame
    cut: float
    k: int
    threshold: float


def ngrams(hashes: np.ndarray, order: int) -> np.ndarray:
    """Buckets of the n-grams of a text."""
    n = max(0, len(hashes) - order + 1)
    out = np.full(n, order, dtype=np.uint64)
    for k in range(order):
        out = _mix(out + hashes[k : k + n])
    return (out & np.uint64(BUCKETS - 1)).astype(np.int64)


def _hashed(text: str | None, hashes: WordHashes) -> np.ndarray:
    return hashes(_TOKEN.findall(text.lower()) if text else [])


class Model(NamedTuple):
    """Bucket counts of one order in the raw corpus and in the target."""

    raw: np.ndarray
    target: np.ndarray
    pseudo: float
    scale: float  # target n-grams for each raw one

    @classmethod
    def of(cls, raw: np.ndarray, target: np.ndarray, pseudo: float) -> Model:
        scale = float(target.sum() / raw.sum()) if raw.any() else 0.0
        return cls(raw.astype(np.float32), target.astype(np.float32), pseudo, scale)

    def log_ratio(self, buckets: np.ndarray, own: np.ndarray, in_target: bool) -> np.ndarray:
        """log of target over raw probability, at most 0, as if the document with ``own`` counts had not been counted."""
        if not self.scale:
            return np.zeros(len(buckets))
        expected = (self.raw[buckets] - own) * self.scale
        seen = self.target[buckets] - own * in_target
        spread = np.sqrt(np.maximum(expected, 0))  # of a count of that expectation; within it, nothing speaks against a word
        return np.minimum(np.log((seen + spread + self.pseudo) / (expected + self.pseudo)), 0)


def log_weight(hashes: np.ndarray, models: dict[int, Model], in_target: bool) -> float:
    total = 0.0
    for order, model in models.items():
        found, own = np.unique(ngrams(hashes, order), return_counts=True)
        total += ORDER_WEIGHTS[order] * float((model.log_ratio(found, own, in_target) * own).sum()) / (own.sum() + PRIOR_NGRAMS)
    return total * TEXT_NGRAMS


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that parts good from bad with the best balanced accuracy; minus infinity if either is missing."""
    if not good.any() or good.all():
        return float("-inf")
    order = np.argsort(weights, kind="stable")
    sorted_good = good[order]
    kept = 1 - np.cumsum(sorted_good) / good.sum()
    caught = np.cumsum(~sorted_good) / (~good).sum()
    ends = np.append(weights[order][1:] != weights[order][:-1], True)  # ties stay together
    at = int(np.argmax(np.where(ends, kept + caught, -1)))
    if at + 1 == len(order) or kept[at] + caught[at] <= 1:
        return float("-inf")
    return float((weights[order][at] + weights[order][at + 1]) / 2)


def _ids() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row")]


def _roles(labels: DataFrame, most: int) -> DataFrame:
    """``doc, role`` of at most ``most`` labelled documents: a bounded, documented sample, and so the one thing that is broadcast."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc"))
    known = known.agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    order = F.xxhash64(F.lit(SEED), "doc")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return known.orderBy(order, "doc").limit(most).select("doc", F.when(good, _GOOD).otherwise(_BAD).alias("role"))


def _counts(texts: DataFrame) -> dict[tuple[int, str], np.ndarray]:
    """Bucket counts of each order over all texts (raw) and over the target.

    Each task adds up arrays of a fixed size; arrays are sent compressed, chunk
    by chunk, and added, first in salted groups; what reaches the driver has a
    fixed size, too.
    """
    schema = "chunk int, salt int, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, salt = WordHashes(), 0
        totals = np.zeros((len(ORDERS), 2, BUCKETS), dtype=np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                fits = np.array([role == _GOOD for role in part.column(1).to_pylist()])
                each = [_hashed(text, hashes) for text in part.column(0).to_pylist()]
                salt = (salt + sum(len(h) for h in each)) % 64
                for k, order in enumerate(ORDERS):
                    found = [ngrams(h, order) for h in each]
                    np.add.at(totals[k, 0], np.concatenate(found), 1)
                    if fits.any():
                        np.add.at(totals[k, 1], np.concatenate([f for f, fit in zip(found, fits) if fit]), 1)
        flat = totals.reshape(-1, _CHUNK)
        for i in np.flatnonzero(flat.any(axis=1)).tolist():
            yield row(i, salt, flat[i])

    def row(chunk: int, salt: int, counts: np.ndarray) -> pa.RecordBatch:
        packed = pa.array([zlib.compress(counts.astype(np.int64).tobytes(), 1)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([salt], pa.int32()), packed], names=["chunk", "salt", "counts"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CHUNK, dtype=np.int64)
        for batch in batches:
            for counts in batch.column("counts"):
                total += np.frombuffer(zlib.decompress(counts.as_buffer()), dtype=np.int64)
        yield row(key[0].as_py(), 0, total)

    parts = texts.select("text", "role").mapInArrow(count, schema)
    salted = parts.groupBy("chunk", "salt").applyInArrow(add, schema)
    flat = np.zeros((len(ORDERS) * 2 * BUCKETS // _CHUNK, _CHUNK), dtype=np.int64)
    for chunk, _, counts in salted.groupBy("chunk").applyInArrow(add, schema).toLocalIterator():
        flat[chunk] = np.frombuffer(zlib.decompress(counts), dtype=np.int64)
    totals = flat.reshape(len(ORDERS), 2, BUCKETS)
    return {(order, kind): totals[k, j] for k, order in enumerate(ORDERS) for j, kind in enumerate(("raw", "target"))}


def _kth(scored: DataFrame, column: str, k: int, bins: int = 4096, rounds: int = 5) -> float:
    """A value that ``k`` rows reach, found with counts of a bounded number of bins; more rows reach it only if they tie to the last digits."""
    low, high, n = scored.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    above = 0
    for _ in range(rounds):
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            break
        inside = scored.where(F.col(column).between(low, high))
        at = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        counts = dict(inside.groupBy(at.alias("at")).count().collect())  # at most ``bins`` rows
        for b in range(bins - 1, -1, -1):
            if above + counts.get(b, 0) >= k:
                break
            above += counts.get(b, 0)
        exact = above + counts.get(b, 0) == k
        high = high if b == bins - 1 else low + (b + 1) * width
        low = low + b * width
        if exact:
            break
    return float(low)


def select(docs: DataFrame, labels: DataFrame, folder: str | None = None, seed: int = SEED, labelled: int = LABELLED) -> Selection:
    """Weights every document and draws the k best after noise; ``scored`` has ``doc, row, log_weight, perturbed, role``.

    ``docs`` has ``doc_id, text``, ``labels`` has ``doc_id, quality, toxic``; a
    document's labels are its lowest quality and highest toxicity, a null
    toxicity is none, labels without id or quality are left out.  Without good
    and bad documents among the labels nothing can be told apart and all
    documents stay.  A document without a word has weight 0 and stays unless the
    cut is above 0.  Rows with equal id and text are one document and share
    their fate; a null id counts as one id of its own.  An empty table selects
    nothing; other columns are not read.
    """
    folder = folder or scratch(docs.sparkSession)
    roles = stored(_roles(labels, labelled), folder, "roles")
    texts = docs.select(*_ids(), F.col("text").cast("string")).join(F.broadcast(roles), "doc", "left").withColumn("role", F.coalesce("role", F.lit(_RAW)))
    counts = _counts(texts)
    models = {order: Model.of(counts[order, "raw"], counts[order, "target"], PSEUDO_COUNTS[order]) for order in ORDERS}
    model = docs.sparkSession.sparkContext.broadcast(models)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                weights = [log_weight(_hashed(text, hashes), model.value, role == _GOOD) for text, role in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array(weights, pa.float64())], names=["doc", "row", "role", "log_weight"])

    weighed = texts.select("doc", "row", "text", "role").mapInArrow(weigh, "doc long, row long, role int, log_weight double").distinct()
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc", "row"), 11) + 0.5) / float(1 << 53)
    scored = stored(weighed.withColumn("perturbed", F.col("log_weight") - F.log(-F.log(uniform))), folder, "scored")
    seen = scored.where(F.col("role").isin(_GOOD, _BAD)).select("log_weight", "role").toPandas()  # a part of the bounded sample
    cut = best_cut(seen.log_weight.to_numpy(dtype=float), (seen.role == _GOOD).to_numpy(dtype=bool))
    k = scored.where(F.col("log_weight") >= cut).count()
    return Selection(scored, cut, k, _kth(scored, "perturbed", k))


def selected(docs: DataFrame, selection: Selection) -> DataFrame:
    """The rows of ``docs`` that were drawn."""
    doc, row = _ids()
    drawn = selection.scored.where(F.col("perturbed") >= selection.threshold).select(F.col("doc").alias("__doc"), F.col("row").alias("__row"))
    return docs.withColumns({"__doc": doc, "__row": row}).join(drawn, ["__doc", "__row"], "left_semi").drop("__doc", "__row")
