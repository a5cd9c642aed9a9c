"""Reversible line deduplication: sharded cuckoo filters backed by exact reference counts.

The exact state is a table of references, one row for each key and document
that came (+1) or went (-1).  Beside it lies one cuckoo filter for each shard
of the key space, of the keys that at least two live documents hold.  Lines are
screened by their shard's filter; only what it lets through is looked up in the
exact counts.  A cuckoo filter forgets a key again, so deleting documents takes
keys out when their count falls below two, and the lines of the documents that
are left come back.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sitegrade.llm.common import scratch, stored

SPACE = " \t\n\x0b\f\r"
LEAST_CHARS = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEYS_PER_SHARD = 250_000
LINES_PER_TASK = 250_000
LAST_ID = (1 << 63) - 1

_SLOTS, _KICKS, _LOAD = 4, 200, 0.85


class CuckooFilter:
    """Set of 128-bit keys as 16-bit fingerprints in buckets of four; keys that find no place are kept whole."""

    def __init__(self, buckets: int, cells: np.ndarray | None = None, stash: set[tuple[int, int]] | None = None):
        self.buckets = buckets  # a power of two
        self.cells = np.zeros((buckets, _SLOTS), dtype=np.uint16) if cells is None else cells
        self.stash = stash or set()

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """With room for twice as many keys."""
        return cls(1 << max(4, math.ceil(math.log2(max(1, 2 * keys) / _SLOTS / _LOAD))))

    @property
    def capacity(self) -> int:
        return int(self.buckets * _SLOTS * _LOAD)

    def _places(self, h1: np.ndarray, h2: np.ndarray):
        mark = (h2.astype(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (h1.astype(np.uint64) >> np.uint64(20)) & np.uint64(self.buckets - 1)
        return mark, first.astype(np.int64), self._other(first.astype(np.int64), mark)

    def _other(self, bucket, mark):
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995 >> 8) & (self.buckets - 1))

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(h1, h2)
        found = ((self.cells[first] == mark[:, None]) | (self.cells[second] == mark[:, None])).any(axis=1)
        if self.stash:
            found |= np.fromiter(((a, b) in self.stash for a, b in zip(h1.tolist(), h2.tolist())), dtype=bool, count=len(h1))
        return found

    def add(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Adds distinct keys that are not in the set."""
        mark, first, second = self._places(h1, h2)
        left = np.arange(len(h1))
        for bucket in (first, second):
            left = left[np.argsort(bucket[left], kind="stable")]
            at = bucket[left]
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            taken = (self.cells[at] != 0).sum(axis=1)  # cells of a bucket fill from the left
            fits = rank + taken < _SLOTS
            self.cells[at[fits], (rank + taken)[fits]] = mark[left[fits]]
            left = left[~fits]
        for i in left.tolist():
            self._kick(int(h1[i]), int(h2[i]), mark[i : i + 1].copy(), int(second[i]))

    def _kick(self, h1: int, h2: int, mark: np.ndarray, bucket: int) -> None:
        moved = []
        for turn in range(_KICKS):
            free = np.flatnonzero(self.cells[bucket] == 0)
            if len(free):
                self.cells[bucket, free[0]] = mark[0]
                return
            slot = (bucket + turn) % _SLOTS
            moved.append((bucket, slot, self.cells[bucket, slot]))
            mark[0], self.cells[bucket, slot] = self.cells[bucket, slot], mark[0]
            bucket = int(self._other(np.array([bucket]), mark)[0])
        for bucket, slot, before in reversed(moved):
            self.cells[bucket, slot] = before
        self.stash.add((h1, h2))

    def remove(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Takes out keys that are in the set."""
        mark, first, second = self._places(h1, h2)
        for i, key in enumerate(zip(h1.tolist(), h2.tolist())):
            if key in self.stash:
                self.stash.discard(key)
                continue
            for bucket in (first[i], second[i]):
                held = np.flatnonzero(self.cells[bucket] == mark[i])
                if len(held):
                    rest = np.delete(self.cells[bucket], held[0])
                    self.cells[bucket] = np.append(rest, np.uint16(0))
                    break

    def row(self, shard: int) -> dict:
        stash = np.array(sorted(self.stash), dtype=np.int64).tobytes()
        return {"shard": shard, "buckets": self.buckets, "cells": self.cells.tobytes(), "stash": stash}

    @classmethod
    def of(cls, row) -> CuckooFilter:
        cells = np.frombuffer(row.cells, dtype=np.uint16).reshape(-1, _SLOTS).copy()
        stash = np.frombuffer(row.stash, dtype=np.int64).reshape(-1, 2)
        return cls(int(row.buckets), cells, set(map(tuple, stash.tolist())))


_FILTER = "shard int, buckets long, cells binary, stash binary, keys long"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _ids() -> list[Column]:
    """What names a row: its id, a null one as the largest, and its text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(_text()).alias("row")]


def line_keys(docs: DataFrame) -> DataFrame:
    """``doc, row, at, h1, h2``: place and 128-bit key of each line whose key is long enough to count."""
    lines = docs.select(*_ids(), F.posexplode(F.split(_text(), "\n")).alias("at", "line"))
    keyed = lines.select("doc", "row", "at", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= LEAST_CHARS)
    return keyed.select("doc", "row", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))


class LineIndex:
    """The lines of a growing and shrinking set of documents.

    Kept in ``folder``: the references, an append-only log, and the filters with
    their numbers of keys, written anew for the shards that a change touches.
    Only keys that a change holds are counted anew.  What grows is mended each
    time it has doubled, so its cost is shared by the changes that caused it: a
    filter without room is built again from the exact counts, shards of too many
    keys are cut anew, and the log is summed up.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, shards: int | None = None):
        self.spark, self.folder, self.shards = spark, folder or scratch(spark), shards
        self.epoch, self.references, self.filters, self.shared = 0, None, None, None
        self.rows, self.summed = 0, 0  # of the log, now and when it was last summed up

    def _shard(self) -> Column:
        return F.pmod("h1", F.lit(self.shards)).cast("int").alias("shard")

    def _live(self, references: DataFrame) -> DataFrame:
        """``h1, h2, n_docs, owner`` of the keys that live documents hold; summed before each shuffle, so a key of many documents is no hot spot."""
        held = references.groupBy("h1", "h2", "doc").agg(F.sum("sign").alias("held")).where("held > 0")
        return held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc").alias("owner"))

    def _held_twice(self, references: DataFrame) -> DataFrame:
        return self._live(references).where("n_docs > 1")

    def _change(self, change: DataFrame) -> None:
        """Appends ``h1, h2, doc, sign`` and brings the filters up to date."""
        self.epoch += 1
        change = stored(change, self.folder, f"references-{self.epoch}")
        came = change.count()
        if self.references is None:
            self.references, self.rows, self.summed = change, came, came
            self.shards = self.shards or max(1, math.ceil(came / KEYS_PER_SHARD))
            self.shared = stored(self._held_twice(change).select("h1", "h2", "owner"), self.folder, f"shared-{self.epoch}")
            moves = self.shared.select("h1", "h2", F.lit(True).alias("comes"))
        else:
            before, self.references, self.shared = self.references, self.references.unionByName(change), None
            # Stored, so that the join can split a line with many references.
            touched = stored(change.select("h1", "h2").distinct(), self.folder, f"touched-{self.epoch}")
            was, now = (self._held_twice(log.join(touched, ["h1", "h2"], "left_semi")).select("h1", "h2", F.lit(1).alias(name)) for log, name in ((before, "was"), (self.references, "now")))
            moves = now.join(was, ["h1", "h2"], "full_outer").where("now is null or was is null").select("h1", "h2", F.col("was").isNull().alias("comes"))
            self.rows += came
        self._update(stored(moves, self.folder, f"moves-{self.epoch}"))
        if self.rows > 2 * self.summed:
            log = self.references.groupBy("h1", "h2", "doc").agg(F.sum("sign").alias("sign")).where("sign <> 0")
            self.references = stored(log, self.folder, f"log-{self.epoch}")
            self.rows = self.summed = self.references.count()

    def _update(self, moves: DataFrame) -> None:
        """New filters of the shards in ``moves`` (``h1, h2, comes``)."""
        old = self.filters if self.filters is not None else self.spark.createDataFrame([], _FILTER)
        sign = F.when(F.col("comes"), 1).otherwise(-1)
        if self.filters is not None:
            more = moves.agg(F.coalesce(F.sum(sign), F.lit(0))).first()[0] + old.agg(F.coalesce(F.sum("keys"), F.lit(0))).first()[0]
            needed = math.ceil(more / KEYS_PER_SHARD)
            if needed > 2 * self.shards:
                self.shards = needed
                old = self.spark.createDataFrame([], _FILTER)
                moves = stored(self._held_twice(self.references).select("h1", "h2", F.lit(True).alias("comes")), self.folder, f"anew-{self.epoch}")
        moves = moves.withColumn("shard", self._shard())
        if self.filters is not None:
            room = F.col("buckets") * int(_SLOTS * _LOAD * 10) / 10
            full = moves.groupBy("shard").agg(F.sum(sign).alias("more")).join(old.select("shard", "keys", room.alias("room")), "shard").where("keys + more > room")
            full = stored(full.select("shard"), self.folder, f"full-{self.epoch}")
            if not full.isEmpty():
                own = self.references.withColumn("shard", self._shard()).join(full, "shard", "left_semi")
                rebuilt = self._held_twice(own).select("h1", "h2", F.lit(True).alias("comes"), self._shard())
                moves = moves.join(full, "shard", "left_anti").unionByName(rebuilt)
                old = old.join(full, "shard", "left_anti")

        def update(key, changes: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            columns = ["shard", "buckets", "cells", "stash", "keys"]
            if not len(changes):
                return filters[columns]
            comes = changes.comes.to_numpy(dtype=bool)
            own = CuckooFilter.of(next(filters.itertuples())) if len(filters) else CuckooFilter.sized(int(comes.sum()))
            keys = int(filters["keys"].sum()) + int(comes.sum()) - int((~comes).sum())
            h1, h2 = changes.h1.to_numpy(), changes.h2.to_numpy()
            own.remove(h1[~comes], h2[~comes])
            own.add(h1[comes], h2[comes])
            return pd.DataFrame([own.row(int(key[0])) | {"keys": keys}], columns=columns)

        new = moves.groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(update, _FILTER)
        self.filters = stored(new, self.folder, f"filters-{self.epoch}")

    def insert(self, lines: DataFrame) -> None:
        """Adds the documents of ``lines`` (see :func:`line_keys`)."""
        self._change(lines.groupBy("h1", "h2", "doc").agg(F.lit(1).cast("long").alias("sign")))

    def delete(self, doc_ids: DataFrame) -> None:
        """Takes out the documents of ``doc_ids`` (one column ``doc_id``); unknown ids do nothing."""
        ids = doc_ids.select(_ids()[0]).distinct()
        held = self.references.join(ids, "doc", "left_semi").groupBy("h1", "h2", "doc").agg((-F.sum("sign")).alias("sign"))
        self._change(held.where("sign <> 0"))

    def drops(self, lines: DataFrame) -> DataFrame:
        """``doc, row, drops``: the places of the lines to drop in each row that has any.

        A shard of many lines is cut into parts, each screened with a copy of
        the shard's filter, so a line that a third of all documents hold is
        screened in many tasks.  What passes joins the exact counts.
        """
        sharded = lines.withColumn("shard", self._shard())
        parts = sharded.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / LINES_PER_TASK).cast("int").alias("parts"))
        parts = stored(parts, self.folder, f"parts-{self.epoch}")
        cut = sharded.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("doc", "row", "at"), "parts").cast("int")).drop("parts")
        copies = self.filters.join(parts, "shard").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")

        def screen(pdf: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            columns = ["doc", "row", "at", "h1", "h2"]
            if not len(pdf) or not len(filters):
                return pdf[columns].head(0)
            own = CuckooFilter.of(next(filters.itertuples()))
            return pdf.loc[own.has(pdf.h1.to_numpy(), pdf.h2.to_numpy()), columns]

        passed = cut.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInPandas(screen, "doc long, row long, at int, h1 long, h2 long")
        passed = stored(passed, self.folder, f"passed-{self.epoch}")
        shared = self.shared
        if shared is None:
            asked = stored(passed.select("h1", "h2").distinct(), self.folder, f"asked-{self.epoch}")
            shared = stored(self._held_twice(self.references.join(asked, ["h1", "h2"], "left_semi")).select("h1", "h2", "owner"), self.folder, f"shared-{self.epoch}")
        dropped = passed.join(shared, ["h1", "h2"]).where("doc <> owner")
        return dropped.groupBy("doc", "row").agg(F.collect_set("at").alias("drops"))


def without(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """``docs`` without the lines of ``drops``, with ``n_lines`` (before) and ``n_dropped`` added."""
    doc, row = _ids()
    named = docs.withColumns({"__doc": doc, "__row": row})
    found = drops.select(F.col("doc").alias("__doc"), F.col("row").alias("__row"), F.col("drops").alias("__drops"))
    lines = F.split(_text(), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__drops"))
    text = F.array_join(F.transform(kept, lambda at: F.get(lines, at)), "\n")
    return named.join(found, ["__doc", "__row"], "left").withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.size(F.coalesce("__drops", F.array().cast("array<int>"))).cast("long"),
        "text": F.when(F.col("__drops").isNull(), F.col("text")).otherwise(text),
    }).drop("__doc", "__row", "__drops")


def deduplicate(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``docs`` without the lines that a document of smaller id holds, with ``n_lines`` and ``n_dropped``.

    A key (see :func:`line_key`) of at least ten characters that two or more
    documents hold stays in the one of the smallest id only, there on all its
    lines; other lines stay as they are.  Rows that share an id are one document;
    null ids are one document, of the largest id.  A null text stays null and
    counts as one empty line, as an empty text does; a document that loses all
    its lines keeps an empty text.  Columns called ``n_lines`` or ``n_dropped``
    are replaced; an empty table gives no rows.
    """
    index = LineIndex(docs.sparkSession, folder)
    lines = stored(line_keys(docs), index.folder, "lines")
    index.insert(lines)
    return without(docs, index.drops(lines))
