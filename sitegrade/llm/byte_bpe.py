"""Byte-level BPE: ids of whole texts by tiktoken with a local rank file, and the bytes of ids.

The pattern that cuts a text before merging looks ahead only behind white
space, and none of its matches goes on from another character into white
space.  So a text may be cut wherever white space begins: what stands before
and after such a place is matched as in the whole text.  Long texts are encoded
chunk by chunk, cut at these places.  A very long run of white space, at which
the library's matcher gives up, is one match up to its last character, and is
merged as a whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from sitegrade.llm.common import parts

CHUNK = 1 << 16
LONG_RUN = 1 << 16

# Fixed value: Unicode's White_Space, which \s of the pattern stands for, as a character class.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks of a rank file: a line each, the token in base64."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Codec:
    """Encodes and decodes by ``ranks``; ``special`` strings, which hold no white space, are single ids.

    ``chunk`` and ``long_run`` bound what the library gets at once, in characters.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int] | None = None, chunk: int = CHUNK, long_run: int = LONG_RUN):
        self.ranks, self.special = ranks, special or {}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        self.chunk, self.long_run, self.whole = chunk, long_run, None
        self._edge = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")
        self._run = re.compile(f"[{WHITE}]{{{long_run},}}")
        self._allowed, self._special = set(self.special), tuple(self.special)

    def _ids(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special=self._allowed) if self._allowed else self.encoding.encode_ordinary(text)

    def _one_match(self, text: str) -> list[int]:
        if self.whole is None:  # seldom needed, so built on first use
            self.whole = tiktoken.Encoding("one-match", pat_str="(?s:.+)", mergeable_ranks=self.ranks, special_tokens={})
        return self.whole.encode_ordinary(text)

    def _chunks(self, text: str, start: int, end: int) -> Iterator[str]:
        while end - start > self.chunk:
            edge = self._edge.search(text, start + self.chunk, end)
            if edge is None:
                break
            yield text[start : edge.start()]
            start = edge.start()
        if start < end:
            yield text[start:end]

    def _pieces(self, text: str) -> Iterator[list[int]]:
        start = 0
        for run in self._run.finditer(text):
            for chunk in self._chunks(text, start, run.start()):
                yield self._ids(chunk)
            # The match leaves the last character to what follows, if anything does; a special string ends the text before it.
            last = run.end() == len(text) or text.startswith(self._special, run.end())
            start = run.end() if last else run.end() - 1
            yield self._one_match(text[run.start() : start])
        for chunk in self._chunks(text, start, len(text)):
            yield self._ids(chunk)

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text."""
        if len(text) <= min(self.chunk, self.long_run):
            return np.array(self._ids(text), dtype=np.int32)
        found = [np.array(ids, dtype=np.int32) for ids in self._pieces(text)]
        return np.concatenate(found) if found else np.empty(0, dtype=np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes that ``ids`` stand for, which need not be whole characters."""
        return b"".join(self.encoding.decode_bytes(ids[at : at + self.chunk].tolist()) for at in range(0, len(ids), self.chunk))


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(rank_path: str, pattern: str) -> Codec:
    if (rank_path, pattern) not in _codecs:
        _codecs[rank_path, pattern] = Codec(read_ranks(rank_path), pattern)
    return _codecs[rank_path, pattern]


def encode(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` (an array of ints) of each row's whole text, without special tokens.

    ``rank_path`` is present on every executor.  Rows map one to one: repeated
    and null ids stay, a null or empty text has no ids, special strings inside
    texts are ordinary text, an empty table gives no rows, and other columns of
    ``docs`` are not read.  No step needs rows of other tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(rank_path, pattern)
        for batch in batches:
            for part in parts(batch, 1):
                found = [codec.encode(text) for text in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, np.concatenate(found))], names=["doc_id", "ids"])

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return texts.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: the raw bytes that each row's ids stand for.

    Bytes, not text, since ids may begin or end inside a character.  Null ids
    give null, no ids no bytes; a null or an unknown number among the ids gives
    null, as there are no bytes to give.
    """

    def bytes_of(codec: Codec, ids: pa.Array) -> bytes | None:
        if not ids.is_valid or ids.values.null_count:
            return None
        try:
            return codec.decode(ids.values.to_numpy())
        except (KeyError, OverflowError):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(rank_path, pattern)
        for batch in batches:
            for part in parts(batch, 1, CHUNK * 16):
                decoded = pa.array([bytes_of(codec, ids) for ids in part.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), decoded], names=["doc_id", "ids", "decoded"])

    rows = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
