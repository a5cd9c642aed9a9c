"""Exact top-k by inner product, pruned by segment statistics from coarse to fine.

Cut two vectors into segments.  Within a segment of width w, with means m and
norms r of what is left after taking the mean away,

    q . x = w mq mx + (q - mq) . (x - mx)  <=  w mq mx + rq rx .

The sum over the segments bounds the score from above, or in other words the
distance |q|^2 + |x|^2 - 2 q.x from below.  More segments give tighter bounds
at a higher cost, so each level only looks at what the one before it left, and
exact scores are computed for the survivors of the last.

The same statistics keep whole blocks of rows apart.  Rows whose segments lie on
the same side of their mean are dealt to the same block; a block's box, the least
and the largest of each statistic, bounds the score of a query with any of its
rows.  Each query is first scored against the block whose middle suits it best,
and goes on to those blocks alone whose box reaches its k-th score so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sitegrade.llm.common import scratch, stored

LEVELS = (1, 4, 16)
QUERY_BLOCK = 2048
ROW_BLOCK = 4096
QUERIES_AT_ONCE = 256  # whose bounds with all rows of a block are held at once, 8 MB
PAGE = 4096  # boxes that meet a block of queries in one task, about 1 KB each
LAST_ID = (1 << 63) - 1


def quantised(df: DataFrame, vector: str = "embedding", scale: int = 64) -> DataFrame:
    """``vec_id`` and ``vector`` of whole numbers, floor(scale * x); rows without an id, or with a null or non-finite component, are left out, and rows equal in both are one."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & values.isNotNull() & ~bad
    return df.where(usable).select(F.col("vec_id").cast("long"), F.transform(values, lambda x: F.floor(x * scale)).alias("vector")).distinct()


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per vector and segment, the mean times the root of the width, and the norm of the rest."""
    parts = np.array_split(vectors, min(segments, max(1, vectors.shape[1])), axis=1)
    means = [p.mean(axis=1) if p.shape[1] else np.zeros(len(p)) for p in parts]
    rests = [np.sqrt(((p - m[:, None]) ** 2).sum(axis=1)) for p, m in zip(parts, means)]
    return np.stack([m * math.sqrt(p.shape[1]) for p, m in zip(parts, means)] + rests, axis=1)


def block_top_k(query_ids, queries, row_ids, rows, k: int, levels=LEVELS, floors=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of the query, row id and score of each query's k best rows of this block, without those below its floor where it has one.

    Queries are taken ``QUERIES_AT_ONCE`` at a time: a level bounds the rows that
    are left to any of them in one product, and strikes out pairs one by one.
    """
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1]) < 2**52
    wide_q, wide_r = queries.astype(np.float64), rows.astype(np.float64)
    stats = [(_statistics(wide_q, s), _statistics(wide_r, s)) for s in levels]
    longest = [np.sqrt((of_rows**2).sum(axis=1)).max(initial=0) for _, of_rows in stats]
    queries, rows = (wide_q, wide_r) if exact else (queries, rows)
    floors = np.full(len(query_ids), np.nan) if floors is None else floors
    found = []
    for start in range(0, len(query_ids), QUERIES_AT_ONCE):
        part = slice(start, start + QUERIES_AT_ONCE)
        asking, floor, left = queries[part], floors[part].astype(np.float64), np.arange(len(rows))
        alive = query_ids[part, None] != row_ids[None, :]
        for level, (of_queries, of_rows) in enumerate(stats):
            bounds = of_queries[part] @ of_rows[left].T
            if level == 0:
                unknown = np.flatnonzero(np.isnan(floor) & (alive.sum(axis=1) > k))
                if len(unknown):
                    seeds = np.argpartition(np.where(alive[unknown], -bounds[unknown], np.inf), k - 1, axis=1)[:, :k]
                    floor[unknown] = [(rows[s] @ q).min() for s, q in zip(seeds, asking[unknown])]
            slack = 1e-9 * (1 + np.sqrt((of_queries[part] ** 2).sum(axis=1)) * longest[level])
            least = np.where(np.isnan(floor), -np.inf, floor - slack)[:, None]
            alive &= bounds >= least
            some = alive.any(axis=0)
            if 2 * some.sum() < len(left):
                left, alive = left[some], alive[:, some]
        scores = asking @ rows[left].T
        alive &= scores >= least
        crowded = np.flatnonzero(alive.sum(axis=1) > 4 * k)
        if len(crowded):
            lowest = np.where(alive[crowded], scores[crowded], -np.inf if exact else np.iinfo(scores.dtype).min)
            alive[crowded] &= lowest >= np.partition(lowest, -k, axis=1)[:, -k, None]
        at, of = np.nonzero(alive)
        scores, ids = scores[at, of], row_ids[left[of]]
        scores = np.rint(scores).astype(np.int64) if exact else scores
        best = np.lexsort((ids, -scores, at))
        at, ids, scores = at[best], ids[best], scores[best]
        kept = np.arange(len(at)) - np.searchsorted(at, at) < k
        found.append((start + at[kept], ids[kept], scores[kept]))
    return tuple(np.concatenate([np.empty(0, dtype=np.int64), *column]) for column in zip(*found)) if found else (np.empty(0, dtype=np.int64),) * 3


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in vectors])


def _all_statistics(vectors: np.ndarray) -> np.ndarray:
    return np.concatenate([_statistics(vectors.astype(np.float64), s) for s in LEVELS], axis=1)


def _levels(width: int) -> Iterator[tuple[slice, slice]]:
    """Where means and rests of each level stand among all statistics of vectors of this width."""
    at = 0
    for segments in (min(s, max(1, width)) for s in LEVELS):
        yield slice(at, at + segments), slice(at + segments, at + 2 * segments)
        at += 2 * segments


@F.pandas_udf(T.LongType())
def _side(vectors: pd.Series) -> pd.Series:
    """A bit for each segment of the finest level: whether its mean lies above the vector's own."""
    out, widths = np.zeros(len(vectors), dtype=np.int64), vectors.map(len).to_numpy()
    for width in np.unique(widths[widths > 0]):
        at = np.flatnonzero(widths == width)
        matrix = _matrix(vectors.iloc[at]).astype(np.float64)
        mean = matrix.mean(axis=1)
        for n, part in enumerate(np.array_split(matrix, min(LEVELS[-1], width), axis=1)):
            out[at] |= (part.mean(axis=1) > mean).astype(np.int64) << n
    return pd.Series(out)


def placed(vectors: DataFrame, block: str, size: int, folder: str) -> DataFrame:
    """``vectors`` with ``width, key`` and ``block``: runs of about ``size`` rows in the order of width, sides and id; one vector under many ids spans many blocks."""
    sided = vectors.select("vec_id", "vector", F.size("vector").alias("width"), F.xxhash64("vec_id", "vector").alias("key"), _side("vector").alias("side"))
    sided = stored(sided, folder, f"{block}-sides")
    blocks = max(1, math.ceil(sided.count() / size))
    dealt = sided.repartitionByRange(blocks, "width", "side", "vec_id", "key").withColumn(block, F.spark_partition_id()).drop("side")
    return stored(dealt, folder, block)


def boxes(rows: DataFrame) -> DataFrame:
    """``row_block, width, n, least_id, low, high, middle`` of each block's rows of one width."""
    schema = "row_block int, width int, n long, least_id long, low array<double>, high array<double>, middle array<double>"

    def summed(row_block, width, n, least_id, low, high, total):
        return row_block, width, n, least_id, low.tolist(), high.tolist(), total.tolist()

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for (block, width), part in pdf.groupby(["row_block", "width"]):
                stats = _all_statistics(_matrix(part.vector))
                out.append(summed(block, width, len(part), part.vec_id.min(), stats.min(axis=0), stats.max(axis=0), stats.sum(axis=0)))
            yield pd.DataFrame(out, columns=["row_block", "width", "n", "least_id", "low", "high", "middle"])

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        low, high, total = (np.stack(pdf[c].to_list()) for c in ("low", "high", "middle"))
        n = pdf.n.sum()
        row = summed(pdf.row_block.iloc[0], pdf.width.iloc[0], n, pdf.least_id.min(), low.min(axis=0), high.max(axis=0), total.sum(axis=0) / n)
        return pd.DataFrame([row], columns=pdf.columns)

    parts = rows.select("row_block", "width", "vec_id", "vector").mapInPandas(of_batches, schema)
    return parts.groupBy("row_block", "width").applyInPandas(merged, schema)


def _bounds_reach(stats: np.ndarray, floors: np.ndarray, floor_ids: np.ndarray, low: np.ndarray, high: np.ndarray, least_ids: np.ndarray, width: int) -> np.ndarray:
    """Whether a row of a box can come before a query's k-th so far, for each query and box; without a floor, every one can."""
    first, rest = next(_levels(width))
    norms = np.sqrt(np.maximum(low[:, first] ** 2, high[:, first] ** 2) + high[:, rest] ** 2).sum(axis=1)
    slack = 1e-9 * (1 + np.sqrt((stats[:, first] ** 2 + stats[:, rest] ** 2).sum(axis=1))[:, None] * norms)
    alive = np.ones((len(stats), len(low)), dtype=bool)
    for means, rests in _levels(width):
        at = np.flatnonzero(alive.any(axis=0))
        above, below = np.maximum(stats[:, means], 0), np.minimum(stats[:, means], 0)
        bound = above @ high[at, means].T + below @ low[at, means].T + stats[:, rests] @ high[at, rests].T
        most = np.floor(bound + slack[:, at])  # scores are whole numbers
        tied = (most == floors[:, None]) & (least_ids[at] <= floor_ids[:, None])
        alive[:, at] &= np.isnan(floors)[:, None] | (most > floors[:, None]) | tied
    return alive


def _anew(*names: str) -> list[Column]:
    """The columns as new ones, so that both sides of a cogroup may stem from one table."""
    return [F.col(n).alias(n) for n in names]


def _with_boxes(queries: DataFrame, of_rows: DataFrame, judge, schema: str) -> DataFrame:
    """``judge(queries, boxes)`` for each block of queries and each page of boxes of its width."""
    page = F.floor(F.col("row_block") / PAGE).cast("long").alias("page")
    widths = queries.select(*_anew("width", "query_block")).distinct()
    pages = of_rows.select(*_anew("width"), page).distinct()
    asked = queries.join(pages, "width").groupBy("width", "query_block", "page")
    offered = of_rows.withColumn("page", page).join(widths, "width").groupBy("width", "query_block", "page")
    return asked.cogroup(offered).applyInPandas(judge, schema)


def nearest_block(queries: DataFrame, of_rows: DataFrame) -> DataFrame:
    """``vec_id, key, row_block``: the block whose middle has the highest bound with the query; of equal ones the first."""

    def judge(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(offered):
            return pd.DataFrame({"vec_id": [], "key": [], "row_block": [], "suits": []}).astype({"vec_id": "int64", "key": "int64", "row_block": "int32"})
        offered = offered.sort_values("row_block")
        matrix = _matrix(asking.vector)
        means, _ = list(_levels(matrix.shape[1]))[-1]
        suits = _all_statistics(matrix)[:, means] @ np.stack(offered.middle.to_list())[:, means].T
        best = suits.argmax(axis=1)
        return pd.DataFrame({"vec_id": asking.vec_id.to_numpy(), "key": asking.key.to_numpy(), "row_block": offered.row_block.to_numpy()[best], "suits": suits[np.arange(len(best)), best]})

    each = _with_boxes(queries, of_rows, judge, "vec_id long, key long, row_block int, suits double")
    best: Column = F.max(F.struct("suits", (-F.col("row_block")).alias("last")))
    return each.groupBy("vec_id", "key").agg(best.alias("best")).select("vec_id", "key", (-F.col("best.last")).alias("row_block"))


def reachable_blocks(queries: DataFrame, of_rows: DataFrame) -> DataFrame:
    """``vec_id, key, row_block``: the blocks that may hold one of a query's k best rows, but for its ``nearest``; ``queries`` have ``floor, floor_id`` of the k-th row so far."""

    def judge(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        at, of = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        if len(asking) and len(offered):
            matrix = _matrix(asking.vector)
            low, high = np.stack(offered.low.to_list()), np.stack(offered.high.to_list())
            blocks, ids = offered.row_block.to_numpy(), asking.floor_id.to_numpy()
            alive = _bounds_reach(_all_statistics(matrix), asking.floor.to_numpy(dtype=np.float64), ids, low, high, offered.least_id.to_numpy(), matrix.shape[1])
            at, of = np.nonzero(alive & (blocks[None, :] != asking.nearest.to_numpy()[:, None]))
        return pd.DataFrame({"vec_id": asking.vec_id.to_numpy()[at], "key": asking.key.to_numpy()[at], "row_block": offered.row_block.to_numpy()[of]})

    return _with_boxes(queries, of_rows, judge, "vec_id long, key long, row_block int")


def _scored(asked: DataFrame, rows: DataFrame, k: int, query_block: int) -> DataFrame:
    """``query_id, key, vec_id, score``: each asking query's k best rows of a block it asks; a group holds a block of rows and at most about ``query_block`` of the queries that ask it."""

    def best(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(offered):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "key", "vec_id", "score")})
        ids, keys = asking.vec_id.to_numpy(), asking.key.to_numpy()
        floors = asking.floor.to_numpy(dtype=np.float64)
        at, found, scores = block_top_k(ids, _matrix(asking.vector), offered.vec_id.to_numpy(), _matrix(offered.vector), k, floors=floors)
        return pd.DataFrame({"query_id": ids[at], "key": keys[at], "vec_id": found, "score": scores}).astype("int64")

    block = ["row_block", "width"]
    shares = asked.groupBy(*_anew(*block)).agg(F.ceil(F.count(F.lit(1)) / query_block).alias("shares"))
    dealt = asked.join(shares, block).withColumn("share", F.pmod(F.xxhash64("key"), F.col("shares")))
    offered = rows.select("vec_id", "vector", *block).join(shares.select(*_anew(*block, "shares")), block)
    offered = offered.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    group = [*block, "share"]
    return dealt.groupBy(group).cogroup(offered.groupBy(group)).applyInPandas(best, "query_id long, key long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int, query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK, folder: str | None = None) -> DataFrame:
    """Each query's ``k`` rows of the highest inner product: ``query_id, rank, vec_id, score``.

    ``vectors`` and ``queries`` have ``vec_id`` (long) and ``vector`` (whole
    numbers), as :func:`quantised` gives them.  Rows with the query's own id are
    not its candidates, nor are vectors of another length; ties go to the
    smaller id; a query with fewer than ``k`` candidates returns all of them,
    and one with none, nothing.  An id with two different vectors asks and
    answers with both.  No rows, no result.

    A query meets its nearest block, then those whose box can hold one of its
    best rows.  The queries that ask a block are cut into shares of about
    ``query_block``, and the block is sent once to each share.  Every group is of
    bounded size, whatever the number of rows, and returns at most ``k`` rows a
    query.  Many ids of one vector tie: their blocks are passed over
    as soon as ``k`` smaller ids are known.
    """
    folder = folder or scratch(vectors.sparkSession)
    rows, asking = placed(vectors, "row_block", row_block, folder), placed(queries, "query_block", query_block, folder)
    of_rows = stored(boxes(rows), folder, "boxes")
    nearest = stored(nearest_block(asking, of_rows), folder, "nearest")
    first = stored(_scored(asking.join(nearest, ["vec_id", "key"]).withColumn("floor", F.lit(None).cast("double")), rows, k, query_block), folder, "first")

    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    at_k = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
    floors = at_k.select(F.col("query_id").alias("vec_id"), "key", F.col("score").cast("double").alias("floor"), F.col("vec_id").alias("floor_id"))
    known = asking.join(nearest.withColumnRenamed("row_block", "nearest"), ["vec_id", "key"]).join(floors, ["vec_id", "key"], "left").fillna(LAST_ID, "floor_id")
    known = stored(known, folder, "floors")
    asked = stored(known.join(reachable_blocks(known, of_rows), ["vec_id", "key"]), folder, "asked")
    each = first.unionByName(_scored(asked, rows, k, query_block))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
