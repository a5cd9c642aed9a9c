"""Exact token counts of every prefix of every text, by dynamic programming over prefixes.

A byte-pair encoding is valid if and only if each two adjacent tokens are the
encoding of their concatenation.  So the encoding of a prefix is the encoding
of a shorter prefix plus one last token, and exactly one last token fits the
last token before it.  Going through the prefixes from short to long gives the
token count of each, without encoding any prefix on its own.

No piece of the vocabulary holds a word mark behind another character, so no
token crosses the start of a word and the prefixes are counted word by word.
Stored is, per character, by how much the count changes: a running sum of one
byte per character is the exact count at every prefix.
"""

from __future__ import annotations

import re
from os.path import commonprefix
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from sitegrade.llm.common import parts

MARK = "▁"  # stands for a space
_UNIT = re.compile(r" +[^ \n]*|\n[^ \n]*")
_UNKNOWN = -1
_PAIR = 1 << 24  # more than any vocabulary holds
LONG_UNIT = 1000  # longer units are not remembered: they hardly come again
UNIT_BYTES = 200  # what a remembered unit takes besides its characters, of up to five bytes with their steps

SCHEMA = "doc_id long, n_bytes long, n_chars long, n_tokens long, fit_chars long, prefix_steps binary"


class PrefixCounter:
    """Counts the tokens of every prefix as the given sentencepiece BPE model makes them."""

    def __init__(self, model_path: str, remembered_bytes: int = 64 << 20):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        usual = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        self.vocabulary = {model.id_to_piece(i).replace(MARK, " "): i for i in usual}
        self.score = {piece: model.get_score(i) for piece, i in self.vocabulary.items()}
        self.piece = {i: piece for piece, i in self.vocabulary.items()}
        if any(" " in piece.lstrip(" ") or "\n" in piece for piece in self.vocabulary):
            raise ValueError("a piece crosses the start of a word or line")
        #: every ending of every piece; the piece's id, or -1 where the ending is none
        self.suffixes = {piece[k:]: -1 for piece in self.vocabulary for k in range(len(piece))} | self.vocabulary
        self.fits: dict[int, bool] = {}
        #: units and their steps, the newer and the older ones, each of at most so many bytes and a batch's
        self.remembered_bytes, self.new_bytes, self.new, self.old = remembered_bytes, 0, {}, {}

    def _encode(self, text: str) -> list[str]:
        """Byte-pair encoding of a short text by its definition: merge the best pair, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                found = score.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _follows(self, before: int, token: int) -> bool:
        pieces = ([self.piece[before]] if before != _UNKNOWN else []) + [self.piece[token]]
        if len(self.fits) >= 1_000_000:
            self.fits.clear()
        fit = self.fits[before * _PAIR + token] = self._encode("".join(pieces)) == pieces
        return fit

    def _fill(self, units: set[str]) -> None:
        """Adds the steps of ``units``; in sorted order, so each goes on where it parts from the one before."""
        suffixes, fits, new = self.suffixes, self.fits, self.new
        previous, last, count = "", [_UNKNOWN], [0]
        for key in sorted(units):
            unit = key if key[:1] == "\n" else " " + key
            same = len(commonprefix((previous, unit)))
            del last[same + 1 :], count[same + 1 :]
            for end in range(same + 1, len(unit) + 1):
                start = end
                while start:
                    start -= 1
                    token = suffixes.get(unit[start:end])
                    if token is None:
                        start = 0
                    elif token >= 0:
                        fit = fits.get(last[start] * _PAIR + token)
                        if fit is None:
                            fit = self._follows(last[start], token)
                        if fit:
                            last.append(token)
                            count.append(count[start] + 1)
                            break
                else:
                    # Not in the vocabulary: one token per byte, and nothing merges with it.
                    last.append(_UNKNOWN)
                    count.append(count[-1] + len(unit[end - 1].encode()))
            previous = unit
            new[key] = bytes([(b - a) & 255 for a, b in zip(count, count[1:])])

    def steps(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, by how much each of its characters changes the token count."""
        split = [_units(text) if text else [] for text in texts]
        wanted = set().union(*split)
        missing = set()
        for unit in wanted.difference(self.new):
            known = self.old.get(unit)
            if known is None:
                missing.add(unit)
            else:
                self.new[unit] = known
                self.new_bytes += UNIT_BYTES + 5 * len(unit)
        self._fill(missing)
        out = []
        for units in split:
            steps = np.frombuffer(b"".join(map(self.new.__getitem__, units)), dtype=np.int8)
            # The model puts a space before the text; what it costs belongs to the first character.
            own = steps[1:].copy()
            if len(own):
                own[0] += steps[0]
            out.append(own)
        for unit in missing:
            if len(unit) > LONG_UNIT:
                del self.new[unit]
            else:
                self.new_bytes += UNIT_BYTES + 5 * len(unit)
        if self.new_bytes > self.remembered_bytes:
            self.new, self.old, self.new_bytes = {}, self.new, 0
        return out


def _units(text: str) -> list[str]:
    """The text, with a space before it, cut before each run of spaces and each line end; a unit's one space is left out."""
    if MARK in text:
        text = text.replace(MARK, " ")
    spaced = text.replace("\n", " \n")
    if "  " in spaced or spaced[0] == " " or spaced[-1] == " ":
        return [unit[unit[0] == " " :] for unit in _UNIT.findall(" " + text)]
    return spaced.split(" ")


def longest_prefix(steps: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    if len(steps) == 0:
        return 0
    fits = np.flatnonzero(np.cumsum(steps, dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


_counters: dict[str, PrefixCounter] = {}


def _counter(model_path: str) -> PrefixCounter:
    if model_path not in _counters:
        _counters[model_path] = PrefixCounter(model_path)
    return _counters[model_path]


def prefix_counts(docs: DataFrame, model_path: str, budget: int, keep_steps: bool = True) -> DataFrame:
    """Per row of ``docs`` the token count of the text and of each of its prefixes.

    ``model_path`` is a sentencepiece BPE model present on every executor.
    ``fit_chars`` is the length of the longest prefix of at most ``budget``
    tokens; ``prefix_steps`` (null unless kept) holds one signed byte per
    character, whose running sum is the count at every prefix.

    Rows map one to one: repeated and null ids stay, a null text counts as
    empty, an empty text has no tokens, an empty table gives no rows, and other
    columns of ``docs`` are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path)
        for part in (few.slice(at, 256) for batch in batches for few in parts(batch, 1) for at in range(0, few.num_rows, 256)):
            rows = []
            texts = [text or "" for text in part.column(1).to_pylist()]
            for text, steps in zip(texts, counter.steps(texts)):
                total = int(steps.sum(dtype=np.int64))
                fit = len(text) if total <= budget else longest_prefix(steps, budget)
                rows.append((len(text.encode()), len(text), total, fit, steps.tobytes() if keep_steps else None))
            numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            kept = pa.array([r[4] for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), *numbers, kept], names=["doc_id", "n_bytes", "n_chars", "n_tokens", "fit_chars", "prefix_steps"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, T.StructType.fromDDL(SCHEMA))


def truncated(docs: DataFrame, counts: DataFrame, budget: int) -> DataFrame:
    """``docs`` cut to the longest prefix of at most ``budget`` tokens, read off the stored steps.

    ``counts`` is a stored result of :func:`prefix_counts` over the same rows;
    ``doc_id`` must be unique and not null here, since it joins the two.
    """

    @F.pandas_udf("int")
    def fitting(steps):
        return steps.map(lambda s: longest_prefix(np.frombuffer(s, dtype=np.int8), budget))

    fit = counts.select("doc_id", fitting("prefix_steps").alias("__fit"))
    return docs.join(fit, "doc_id").withColumn("text", F.expr("substring(coalesce(text, ''), 1, __fit)")).drop("__fit")
