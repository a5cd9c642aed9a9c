"""K-means over integer vectors by scalar lookup tables.

The vectors are stored once in blocks, each dimension as codes into the sorted
integer values that occur there.  In a round a task tabulates, per dimension,
the squared difference of each occurring value and each centroid; a vector's
distances are then sums of table rows gathered by its codes, with no arithmetic
on the vectors themselves.  All of it is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitegrade.llm.common import scratch, stored

SCALE = 1024
CENTROIDS, ROUNDS, DIMENSIONS, SEED = 8, 10, 64, "3"
BLOCK_CELLS = 1 << 16  # distances a block: its vectors times the centroids
BLOCK_ROWS = 4096
LARGE = 1 << 27  # from here on squared distances of 64 dimensions may not fit 64 bits
MOST = (1 << 63) - 1

BLOCKS = "n long, ids array<long>, codes array<binary>, values array<binary>"


def quantised(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: vectors of exactly ``dimensions`` finite components, each as the integer floor(scale * x)."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return vectors.where((F.size(x) == dimensions) & finite).select(F.col("vec_id").cast("long"), v.alias("v"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> list[list[int]]:
    """The ``k`` vectors of smallest digest of ``seed`` and id, in that order; rows of one id follow their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [row.v for row in vectors.select(digest.alias("digest"), "v").orderBy("digest", "v").limit(k).collect()]


def blocks(vectors: DataFrame, k: int = CENTROIDS) -> DataFrame:
    """``vec_id, v`` as blocks of vectors of one task, with the values that occur in each dimension and the vectors' codes."""
    rows = max(1, min(BLOCK_ROWS, BLOCK_CELLS // k))

    def encoded(ids: pa.Array, flat: np.ndarray) -> pa.RecordBatch:
        v = flat.reshape(len(ids), -1)
        found = [np.unique(v[:, d], return_inverse=True) for d in range(v.shape[1])]
        codes, values = [c.astype(np.uint16).tobytes() for _, c in found], [u.tobytes() for u, _ in found]
        columns = [pa.array([len(ids)]), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([codes]), pa.array([values])]
        return pa.RecordBatch.from_arrays(columns, names=["n", "ids", "codes", "values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= rows:
                table = pa.Table.from_batches(held).combine_chunks()
                yield _taken(table.slice(0, rows), encoded)
                held = table.slice(rows).to_batches()
        if held:
            yield _taken(pa.Table.from_batches(held).combine_chunks(), encoded)

    return vectors.select("vec_id", "v").mapInArrow(run, BLOCKS)


def _taken(table: pa.Table, encoded) -> pa.RecordBatch:
    ids, v = (table.column(k).combine_chunks() for k in (0, 1))
    return encoded(ids, v.flatten().to_numpy())


def _distances(codes: list[np.ndarray], values: list[np.ndarray], centroids: list[list[int]]) -> np.ndarray:
    """Squared distances, a row for each vector and a column for each centroid."""
    large = max([0, *(abs(int(x)) for u in values for x in (u[0], u[-1])), *(abs(x) for c in centroids for x in c)]) >= LARGE
    kind = object if large else np.int64  # Python's integers do not overflow
    total = np.zeros((len(codes[0]), len(centroids)), dtype=kind)
    for d, (code, occurring) in enumerate(zip(codes, values)):
        lookup = (occurring.astype(kind)[:, None] - np.array([c[d] for c in centroids], dtype=kind)[None, :]) ** 2
        total += lookup[code]
    return total


def _read(batch: pa.RecordBatch, row: int) -> tuple[list, list[np.ndarray], list[np.ndarray]]:
    ids, codes, values = (batch.column(k)[row].as_py() for k in (1, 2, 3))
    return ids, [np.frombuffer(c, dtype=np.uint16) for c in codes], [np.frombuffer(u, dtype=np.int64) for u in values]


def _nearest(codes: list[np.ndarray], values: list[np.ndarray], centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    distances = _distances(codes, values, centroids)
    label = np.argmin(distances, axis=1)  # the first of equals
    return label, np.minimum(distances[np.arange(len(label)), label], MOST)


def totals(stored_blocks: DataFrame, centroids: list[list[int]]) -> dict[tuple[int, int], int]:
    """Exact sums over the vectors nearest to each centroid, by cluster and dimension; -1 is their number, -2 their distance.

    A task sends one row for each sum, whatever the number of its vectors, and
    the driver gets as many: centroids times dimensions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                _, codes, values = _read(batch, row)
                label, distance = _nearest(codes, values, centroids)
                for c in range(len(centroids)):
                    own = label == c
                    found = [(-1, int(own.sum())), (-2, sum(distance[own].tolist()))]
                    for d, total in found:
                        sums[c, d] = sums.get((c, d), 0) + total
                for d, (code, occurring) in enumerate(zip(codes, values)):
                    many = np.bincount(label * len(occurring) + code, minlength=len(centroids) * len(occurring)).reshape(len(centroids), -1)
                    small = max(abs(int(occurring[0])), abs(int(occurring[-1]))) < LARGE
                    own = (many * occurring).sum(axis=1) if small else (many.astype(object) * occurring.astype(object)).sum(axis=1)
                    for c, total in enumerate(own.tolist()):
                        sums[c, d] = sums.get((c, d), 0) + total
        keys = list(sums)
        columns = [pa.array([k[j] for k in keys], pa.int32()) for j in (0, 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([sums[k] for k in keys], pa.decimal128(38, 0))], names=["cluster", "dimension", "total"])

    parts = stored_blocks.mapInArrow(run, "cluster int, dimension int, total decimal(38,0)")
    return {(r.cluster, r.dimension): int(r.total) for r in parts.groupBy("cluster", "dimension").agg(F.sum("total").alias("total")).collect()}


class Model(NamedTuple):
    """Final ``centroids`` and, for each, the summed distance of its vectors."""

    centroids: list[list[int]]
    inertia: list[int]


def fit(stored_blocks: DataFrame, centroids: list[list[int]], rounds: int = ROUNDS) -> Model:
    """``rounds`` times: assigns every vector to its nearest centroid, of equals the smaller number, and moves each centroid to the floor of its vectors' mean.

    A centroid without vectors stays.  Once no centroid moves, further rounds
    change nothing and are left out.
    """
    for _ in range(rounds if centroids else 0):
        sums, before = totals(stored_blocks, centroids), centroids
        centroids = [
            [sums[c, d] // sums[c, -1] for d in range(len(own))] if sums.get((c, -1)) else own for c, own in enumerate(centroids)
        ]
        if centroids == before:
            break
    sums = totals(stored_blocks, centroids) if centroids else {}
    return Model(centroids, [min(sums.get((c, -2), 0), MOST) for c in range(len(centroids))])


def assign(stored_blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vec_id, cluster, distance`` (squared) of every vector in the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, codes, values = _read(batch, row)
                label, distance = _nearest(codes, values, centroids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(label, pa.int32()), pa.array(distance.tolist(), pa.int64())], names=["vec_id", "cluster", "distance"]
                )

    return stored_blocks.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, folder: str | None = None) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every row of ``vectors`` (``vec_id, v``, see :func:`quantised`).

    The blocks are written to the shared folder, so a lost executor only reads
    them again.  Repeated rows and ids count as vectors of their own and stay, a
    null id is digested as an empty one; of fewer than ``k`` vectors each is a
    centroid; no vectors give no rows.  Integers and distances beyond 64 bits
    are taken as the largest that fit.
    """
    folder = folder or scratch(vectors.sparkSession)
    start = first_centroids(vectors, k, seed)
    kept = stored(blocks(vectors, k), folder, "blocks")
    model = fit(kept, start, rounds)
    described = [
        (c, own, min(sum(model.inertia), MOST), hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for c, (centroid, own) in enumerate(zip(model.centroids, model.inertia))
    ]
    known = vectors.sparkSession.createDataFrame(described, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assign(kept, model.centroids).join(F.broadcast(known), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
