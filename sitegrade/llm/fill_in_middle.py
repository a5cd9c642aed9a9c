"""Fill-in-the-middle documents, cut by a learned rank index of token boundaries.

A cut is asked for by rank (the k-th boundary between tokens) and needed as an
offset in characters.  Per text, all boundary offsets are fitted by
piecewise-linear segments of bounded error, so an offset is predicted from its
rank by the one segment that holds it; the prediction's residual, stored in a
byte a boundary, makes it exact.  The index does not depend on the cuts: stored
once, it answers those of any seed without the texts being tokenised again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_type

from sitegrade.llm.common import parts

ERROR = 120
SLOPE_BITS = 16  # slopes are multiples of 2^-16, so predictions are exact integers on any machine
LONGEST = 1 << 16  # ranks a segment; rounding its slope then moves no prediction by more than one
WINDOW = 512
MARKERS = ("<P>", "<S>", "<M>")
RATE, SPM_RATE = 90, 20
INDEX = pa.struct([
    ("n", pa.int64()), ("starts", pa.list_(pa.int32())), ("bases", pa.list_(pa.int32())), ("slopes", pa.list_(pa.int64())), ("residuals", pa.list_(pa.int8())),
])


def boundaries(text: str) -> np.ndarray:
    """Offsets, in characters, of all boundaries between tokens, both ends of the text included; a token is a run of A-Z and a-z or any other character."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    letters = (points | 32) - np.uint32(97) < 26
    inner = np.flatnonzero(~(letters[1:] & letters[:-1])) + 1
    return np.concatenate([[0], inner, [len(points)]] if len(points) else [[0]]).astype(np.int64)


def fit(offsets: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``starts, bases, slopes, residuals``: segments from rank ``starts`` on, each within ``error`` of the offsets, and what the predictions lack.

    A segment starts on an offset and grows as long as one line through it comes
    within ``error`` of all offsets; the range of such lines narrows with each.
    """
    last, start = len(offsets) - 1, 0
    starts, bases, slopes, predicted = [], [], [], []
    while start <= last:
        width = WINDOW
        while True:
            rise = offsets[start + 1 : start + 1 + width] - offsets[start]
            steps = np.arange(1, len(rise) + 1)
            high = np.minimum.accumulate((rise + error) / steps)
            low = np.maximum.accumulate((rise - error) / steps)
            held = int(np.searchsorted(low > high, True))
            if held < len(rise) or len(rise) < width or width >= LONGEST:
                break
            width *= 4
        slope = round((high[held - 1] + low[held - 1]) / 2 * (1 << SLOPE_BITS)) if held else 0
        starts.append(start)
        bases.append(int(offsets[start]))
        slopes.append(slope)
        predicted.append(offsets[start] + (np.arange(held + 1, dtype=np.int64) * slope >> SLOPE_BITS))
        start += held + 1
    residuals = offsets - np.concatenate(predicted)
    return np.array(starts, dtype=np.int32), np.array(bases, dtype=np.int32), np.array(slopes, dtype=np.int64), residuals.astype(np.int8)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)], dtype=np.int32)), pa.array(np.concatenate(arrays)), type=kind)


def rank_index(docs: DataFrame, error: int = ERROR) -> DataFrame:
    """``doc_id, text, index``: each row's text (null becomes empty) and the index of its ``index.n`` tokens' boundaries."""
    if not 1 <= error <= ERROR:
        raise ValueError(f"residuals take a byte: the error must be 1 to {ERROR}")

    @F.arrow_udf(from_arrow_type(INDEX))
    def indexed(texts: pa.Array) -> pa.Array:
        out = []
        for part in parts(pa.RecordBatch.from_arrays([texts], names=["text"]), 0):
            cuts = [boundaries(text) for text in part.column(0).to_pylist()]
            fitted = list(zip(*(fit(offsets, error) for offsets in cuts)))
            lists = [_lists(arrays, field.type) for arrays, field in zip(fitted, list(INDEX)[1:])]
            out.append(pa.StructArray.from_arrays([pa.array([len(c) - 1 for c in cuts], pa.int64()), *lists], fields=list(INDEX)))
        return pa.concat_arrays(out) if out else pa.array([], INDEX)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("index", indexed("text"))


def offset_of(index: Column, rank: Column) -> Column:
    """Characters before the boundary of ``rank`` (0 to ``n``): the prediction of its segment, corrected by its residual."""
    segment = F.size(F.filter(index["starts"], lambda start: start <= rank))
    at = lambda name: F.element_at(index[name], segment)
    predicted = at("bases") + F.shiftright((rank - at("starts")) * at("slopes"), SLOPE_BITS)
    return predicted + F.element_at(index["residuals"], (rank + 1).cast("int"))


def _draw(seed: str, group: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def transform(indexed: DataFrame, seed: str = "1", rate: int = RATE, spm_rate: int = SPM_RATE, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each row of :func:`rank_index`.

    Both cuts fall on token boundaries drawn from a digest of ``seed`` and
    ``doc_id``, so a run can be repeated in any partitioning.  Of 100 documents
    about ``rate`` are cut, and of these ``spm_rate`` in a hundred give the
    suffix first (``spm``), the others the prefix (``psm``); the middle always
    comes last.  The rest is ``plain``: the text itself, with null cuts, as are
    empty texts and those that hold one of the markers.

    Rows map one to one: repeated ids draw alike, a null id draws as an empty
    one, an empty table gives no rows.
    """
    if any(m[:1] != "<" or m.find(">") != len(m) - 1 or m.count("<") != 1 for m in markers) or len(set(markers)) < 3:
        raise ValueError("markers must be three different <names>, so that no marker can arise where a text meets one")
    text, index = F.col("text"), F.col("index")
    first, second = (_draw(seed, k) % (index["n"] + 1) for k in (1, 2))
    ranked = indexed.select("doc_id", "text", "index", F.least(first, second).alias("low"), F.greatest(first, second).alias("high"))
    plain = (F.length("text") == 0) | (_draw(seed, 3) % 100 >= rate)
    for marker in markers:
        plain = plain | F.contains("text", F.lit(marker))
    form = F.when(plain, "plain").when(_draw(seed, 4) % 100 < spm_rate, "spm").otherwise("psm")
    cut = ranked.select(
        "doc_id", "text", index["n"].alias("n"), form.alias("form"),
        offset_of(index, F.col("low")).cast("int").alias("from"), offset_of(index, F.col("high")).cast("int").alias("to"),
    )
    prefix = F.substring(text, F.lit(1), F.col("from"))
    middle = F.substring(text, F.col("from") + 1, F.col("to") - F.col("from"))
    suffix = F.substring(text, F.col("to") + 1, F.length(text))
    p, s, m = (F.lit(marker) for marker in markers)
    output = (
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(text)
    )
    chars = lambda c: F.when(F.col("form") != "plain", c.cast("long"))
    return cut.select(
        "doc_id", "n", "form", chars(F.col("from")).alias("prefix_chars"), chars(F.col("to") - F.col("from")).alias("middle_chars"), output.alias("output")
    )


def restored(form: Column, output: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The exact text that ``output`` was made of."""
    found = F.split(output, "|".join(f"\\Q{marker}\\E" for marker in markers))
    one, two, three = (F.element_at(found, k) for k in (2, 3, 4))
    return F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one)).otherwise(output)
