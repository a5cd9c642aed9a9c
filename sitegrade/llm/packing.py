"""Sequence packing as a cutting-stock problem, solved by column generation over the histogram of piece lengths.

Full pieces of a document fill sequences of their own; its last piece, shorter
than a sequence, is an item to pack.  Only the number of items of each length
matters for the plan, so the driver solves one linear program over at most
``capacity`` lengths, whatever the size of the corpus: columns are patterns of
lengths that share a sequence, priced by a knapsack dynamic program under the
program's dual prices until no column lowers the cost by more than the
tolerance.  The solution is rounded down, what it leaves is packed best fit
first, and the patterns are handed out to the items by their rank within their
length.
"""

from __future__ import annotations

import json
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sitegrade.llm.byte_bpe import Codec
from sitegrade.llm.common import scratch, stored
from sitegrade.llm.sharding import running_offsets

CAPACITY = 1024
END_ID = 0
GAP = 2e-3
MOST_COLUMNS = 20_000
STALL = 4  # pricing rounds without progress after which the program ends
ITEMS_PER_BUCKET = 100_000
LAST_ID = (1 << 63) - 1

# Fixed value: how a byte-level BPE of this family cuts text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def padded(fill: int, capacity: int = CAPACITY) -> int:
    """Tokens that a sequence of ``fill`` tokens takes: none are added at a power of two."""
    return fill if fill & (fill - 1) == 0 else capacity


class Plan(NamedTuple):
    """``uses`` of each pattern, a list of (length, copies); ``bound`` is the least cost any packing has."""

    patterns: list[list[tuple[int, int]]]
    uses: list[int]
    cost: int
    bound: float


def _knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each exact fill by items of any number, and the last item of the best way; ``prices[l]`` is the price of length l."""
    best = np.full(capacity + 1, -np.inf)
    last = np.zeros(capacity + 1, dtype=np.int64)
    best[0] = 0.0
    for fill in range(1, capacity + 1):
        values = prices[1 : fill + 1] + best[fill - 1 :: -1][:fill]
        last[fill] = int(np.argmax(values)) + 1
        best[fill] = values[last[fill] - 1]
    return best, last


def _pattern(last: np.ndarray, fill: int) -> Counter:
    out: Counter = Counter()
    while fill:
        out[int(last[fill])] += 1
        fill -= int(last[fill])
    return out


def _best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Patterns of a packing, longest item first, each into the fullest sequence with room."""
    rooms = [[] for _ in range(capacity + 1)]  # open sequences by room
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            room = next((r for r in range(length, capacity + 1) if rooms[r]), None)
            held = rooms[room].pop() if room is not None else ()
            rooms[(capacity if room is None else room) - length].append((*held, length))
    return Counter(tuple(sorted(Counter(held).items(), reverse=True)) for room in rooms for held in room)


def _greedy_start(histogram: dict[int, int], capacity: int) -> list[dict[int, int]]:
    """One pattern for each length: longest first, as much as is left of it fits; each is used, in fractions, until one of its lengths is used up.

    The patterns in this order, and the lengths in the order in which they run
    out, make a triangular matrix, so the patterns are a basis, and a feasible one.
    """
    left, patterns = {l: float(n) for l, n in histogram.items()}, []
    while left:
        room, pattern = capacity, {}
        for length in sorted(left, reverse=True):
            copies = min(room // length, max(1, int(left[length])))
            if copies:
                pattern[length] = copies
                room -= copies * length
        times = min(left[l] / n for l, n in pattern.items())
        for l, n in pattern.items():
            left[l] -= n * times
        gone = [l for l in pattern if left[l] <= 1e-9 * histogram[l]]
        patterns += [pattern, *({l: capacity // l} for l in gone[1:])]
        for l in gone:
            del left[l]
    return patterns


def plan(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = GAP, most_columns: int = MOST_COLUMNS) -> Plan:
    """A packing of ``histogram`` items of each length (1 to ``capacity`` - 1) into sequences, close to the least padded cost."""
    histogram = {int(l): int(n) for l, n in histogram.items() if n > 0}
    if not histogram:
        return Plan([], [], 0, 0.0)
    lengths = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[l] for l in lengths.tolist()], dtype=float)
    row = {int(l): i for i, l in enumerate(lengths)}
    costs_by_fill = np.array([padded(f, capacity) for f in range(capacity + 1)], dtype=float)

    # Written out in sums over the few lengths of a pattern: dense products would start as many threads as the driver has cores.
    def direction_of(inverse: np.ndarray, pattern: dict[int, int]) -> np.ndarray:
        at = [row[l] for l in pattern]
        return (inverse[:, at] * np.array(list(pattern.values()), dtype=float)).sum(axis=1)

    def exchange(inverse: np.ndarray, direction: np.ndarray, out: int) -> np.ndarray:
        """Brings a column into the basis in the place of ``out``; returns that row of the new inverse."""
        pivot = inverse[out] / direction[out]
        touched = np.flatnonzero(np.abs(direction) > 1e-12)
        inverse[touched] -= direction[touched, None] * pivot
        inverse[out] = pivot
        return pivot

    def factored() -> np.ndarray:
        inverse, free, at = np.eye(len(lengths)), np.ones(len(lengths), dtype=bool), []
        for pattern in basis:
            direction = direction_of(inverse, pattern)
            at.append(int(np.argmax(np.where(free, np.abs(direction), -1))))
            exchange(inverse, direction, at[-1])
            free[at[-1]] = False
        return inverse[at]

    basis = _greedy_start(histogram, capacity)
    cost = np.array([costs_by_fill[sum(l * n for l, n in p.items())] for p in basis])
    inverse = factored()
    amount = np.maximum(np.einsum("ij,j->i", inverse, demand), 0)
    bound, columns, trail = float(lengths @ demand), 0, []
    while columns < most_columns:
        duals = np.einsum("i,ij->j", cost, inverse)
        prices = np.full(capacity + 1, -np.inf)
        prices[lengths] = duals
        best, last = _knapsack(prices, capacity)
        now = float((cost * amount).sum())
        # Scaling the prices down until no column is worth more than it costs gives a bound on every packing.
        worth = float(np.max(best[1:] / costs_by_fill[1:]))
        bound = max(bound, float((duals * demand).sum()) / max(worth, 1.0))
        trail.append(now)
        stalled = len(trail) > STALL and trail[-1 - STALL] - now < gap / 20 * now
        if now - bound <= gap * now or stalled:
            break
        # The best pattern of each fill, and the best full one with each length in it.
        offers = {frozenset(_pattern(last, int(f)).items()) for f in np.flatnonzero(best > costs_by_fill + 1e-7) if f}
        for i in np.flatnonzero(duals + best[capacity - lengths] > capacity + 1e-7):
            offers.add(frozenset((_pattern(last, capacity - int(lengths[i])) + Counter([int(lengths[i])])).items()))
        entered = 0
        for offer in sorted((sorted(o) for o in offers), key=lambda o: -sum(duals[row[l]] * n for l, n in o)):
            price = costs_by_fill[sum(l * n for l, n in offer)]
            gain = float(sum(duals[row[l]] * n for l, n in offer)) - price
            if gain <= 1e-7:
                continue
            direction = direction_of(inverse, dict(offer))
            able = direction > 1e-7
            if not able.any():
                continue
            steps = np.where(able, amount / np.where(able, direction, 1), np.inf)
            out = int(np.argmin(steps))
            amount = np.maximum(amount - steps[out] * direction, 0)
            amount[out] = steps[out]
            duals = duals - gain * exchange(inverse, direction, out)
            basis[out], cost[out] = dict(offer), price
            entered += 1
        columns += entered
        if not entered:
            break
        inverse = factored()
        amount = np.maximum(np.einsum("ij,j->i", inverse, demand), 0)
    left = {int(l): int(n) for l, n in zip(lengths, demand)}
    uses: Counter = Counter()

    def use(pattern: dict[int, int], times: int) -> None:
        times = min([times, *(left[l] // n for l, n in pattern.items())])
        if times > 0:
            uses[tuple(sorted(pattern.items(), reverse=True))] += times
            for l, n in pattern.items():
                left[l] -= n * times

    order = sorted(range(len(basis)), key=lambda i: (-(amount[i] % 1), sorted(basis[i].items())))
    for i in order:
        use(basis[i], math.floor(amount[i] + 1e-9))
    for i in order:
        if amount[i] % 1 >= 0.5:
            use(basis[i], 1)
    uses.update(_best_fit(left, capacity))
    patterns = sorted(uses, reverse=True)
    total = sum(int(costs_by_fill[sum(l * n for l, n in p)]) * uses[p] for p in patterns)
    return Plan([list(p) for p in patterns], [uses[p] for p in patterns], total, bound)


class ByteEncoder:
    """Ids as the ``tokenizers`` library gives them for a byte-level BPE file, without added special tokens.

    The same vocabulary, merges and pre-tokenisation in ``tiktoken`` give the
    same ids several times faster; the file's own special strings inside texts
    stay single ids, as is that library's default.  Only the file's vocabulary is
    read: a second tokenizer in each worker would cost memory for nothing.  Long
    texts, and white space of any length, are encoded chunk by chunk.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {token["content"]: token["id"] for token in described["added_tokens"]}
        byte_of = {c: b for b, c in _byte_characters().items()}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in described["model"]["vocab"].items() if piece not in special}
        self.codec = Codec(ranks, PATTERN, special)

    def __call__(self, text: str) -> np.ndarray:
        return self.codec.encode(text).astype("<u4")


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next free one above 255."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


_encoders: dict[str, ByteEncoder] = {}


def _encoder(path: str) -> ByteEncoder:
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """``doc_id, row, start, length, ids, ids_crc32, doc_tokens``: every document's ids and an end id, cut every ``capacity`` ids.

    ``ids`` are little-endian unsigned 32-bit numbers, or null unless kept.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for k, text in enumerate(part.column(2).to_pylist()):
                    ids = np.append(encode(text) if text else np.empty(0, dtype="<u4"), np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        own = ids[start : start + capacity].tobytes()
                        rows.append((k, start, len(own) // 4, own if keep_ids else None, zlib.crc32(own), len(ids)))
                of = pa.array([r[0] for r in rows], pa.int64())
                numbers = lambda j: pa.array([r[j] for r in rows], pa.int64())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(of), part.column(1).take(of), numbers(1), numbers(2), pa.array([r[3] for r in rows], pa.binary()), numbers(4), numbers(5)],
                    names=["doc_id", "row", "start", "length", "ids", "ids_crc32", "doc_tokens"],
                )

    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), F.col("text").cast("string"))
    return texts.mapInArrow(cut, "doc_id long, row long, start long, length long, ids binary, ids_crc32 long, doc_tokens long")


def _ranked(items: DataFrame, total: int, folder: str) -> DataFrame:
    """``items`` with ``rank``, gapless from 0 within each length, in order of a hash; no task holds more than a bucket of items."""
    buckets = max(1, math.ceil(total / ITEMS_PER_BUCKET))
    bucketed = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row", "start"), F.lit(buckets)).cast("int"))
    counts = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    keyed = counts.withColumn("at", F.col("length") * buckets + F.col("bucket"))
    offsets = running_offsets(keyed, "at", "n", "before")
    offsets = stored(offsets.select("length", "bucket", "before"), folder, "offsets")
    firsts = offsets.groupBy("length").agg(F.min("before").alias("first"))
    inside = Window.partitionBy("bucket", "length").orderBy("doc_id", "row", "start")
    ranked = bucketed.withColumn("inside", F.row_number().over(inside) - 1)
    return (
        ranked.join(offsets, ["length", "bucket"]).join(stored(firsts, folder, "firsts"), "length")
        .withColumn("rank", F.col("before") - F.col("first") + F.col("inside")).drop("bucket", "inside", "before", "first")
    )


def _slots(spark: SparkSession, plan: Plan, first_sequence: int) -> DataFrame:
    """Which ranks of a length go to which pattern: at most one row for each pattern and length in it."""
    rows, taken, sequence = [], Counter(), first_sequence
    for pattern, uses in zip(plan.patterns, plan.uses):
        offset = 0
        for length, copies in pattern:
            rows.append((length, taken[length], taken[length] + uses * copies, copies, sequence, offset))
            taken[length] += uses * copies
            offset += length * copies
        sequence += uses
    return spark.createDataFrame(rows, "length long, from_rank long, to_rank long, copies long, first_sequence long, first_offset long")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, folder: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Every piece of every document in its sequence: the columns of :func:`pieces`, ``sequence_id`` and ``offset``.

    Pieces of one sequence lie side by side from offset 0, and sequence ids are
    gapless from 0.  Each id of each document is in exactly one piece.  Null
    texts count as empty and are one piece of the end id alone.  Rows map one to
    one: repeated and null ids stay, and equal rows get pieces of their own; a
    text of any length is cut into as many pieces as it needs.  An empty table
    gives no rows; other columns are not read.
    """
    spark, folder = docs.sparkSession, folder or scratch(docs.sparkSession)
    cut = stored(pieces(docs, tokenizer_path, capacity, keep_ids=keep_ids), folder, "pieces")
    histogram = {row.length: row.n for row in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    full = histogram.pop(capacity, 0)
    ranked = _ranked(cut, full + sum(histogram.values()), folder)
    solved = plan(histogram, capacity)
    alone = Plan([[(capacity, 1)], *solved.patterns], [full, *solved.uses], solved.cost, solved.bound)
    slots = _slots(spark, alone, 0)
    placed = ranked.join(F.broadcast(slots), "length").where("rank >= from_rank and rank < to_rank")  # bounded by the capacity, not by the corpus
    within: Column = F.col("rank") - F.col("from_rank")
    return placed.select(
        "doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.floor(within / F.col("copies"))).alias("sequence_id"),
        (F.col("first_offset") + within % F.col("copies") * F.col("length")).alias("offset"),
    )
