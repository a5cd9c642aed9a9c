"""What several operators share: tables, the shared scratch folder, word shingles."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from sitegrade.session import scratch_root

SHINGLE_WORDS = 5
PART_BYTES = 4 << 20
_WORD = re.compile(r"[^\W_]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one, removed when the driver's JVM ends."""
    return scratch_root(spark, "llm")


def stored(df: DataFrame, folder: str, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table in ``folder``: cuts the lineage, and a lost executor only reads it again."""
    path = f"{folder}/{name}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(batch: pa.RecordBatch, column: int, most_bytes: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive slices whose values in ``column`` (text, binary or a list) take about ``most_bytes``; a longer value stands alone."""
    values = batch.column(column)
    ends = np.frombuffer(values.buffers()[1], dtype=np.int32, count=values.offset + len(values) + 1)[values.offset :] if len(values) else np.zeros(1)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + most_bytes, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased; case and punctuation do not count."""
    return _WORD.findall(text.lower()) if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words; recent words are remembered, so a frequent word is hashed once."""

    def __init__(self, most: int = 100_000):
        self.most, self.new, self.old = most, {}, {}

    def __call__(self, found: list[str]) -> np.ndarray:
        new, old = self.new, self.old
        out = np.empty(len(found), dtype=np.uint64)
        for i, word in enumerate(found):
            value = new.get(word)
            if value is None:
                value = old.get(word)
                if value is None:
                    value = xxhash.xxh3_64_intdigest(word)
                if len(new) >= self.most:
                    self.new, self.old = new, old = {}, new
                new[word] = value
            out[i] = value
        return out


def shingles(hashes: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``size`` words; of the whole text if it has fewer, none if it has no word."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    size = min(size, n)
    out = np.full(n - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = _mix(out ^ hashes[k : n - size + 1 + k])
    return np.unique(out)
