import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from sitegrade.llm import byte_bpe, centroids, fill_in_middle, queries
from sitegrade.llm.common import table
from tests.llm.conftest import table as documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
VOCABULARY = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
LIBRARY = tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=VOCABULARY, special_tokens={})
WHOLE = byte_bpe.Codec(byte_bpe.read_ranks(RANKS), PATTERN)
CHOPPED = byte_bpe.Codec(VOCABULARY, PATTERN, chunk=5, long_run=3)
PART = st.sampled_from([" ", "  ", "   \n", "\n", "\t", "　", " ", "\x85", "\x1c", "a", "the", "ing", "'s", "'", "é", "漢字", "\x00", "🙂", "12", "...", "<|endoftext|>"])
TEXT = st.lists(PART, max_size=30).map("".join) | st.text(max_size=40)


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@settings(max_examples=500, deadline=None)
@given(TEXT)
def test_ids_are_those_of_the_library_however_a_text_is_cut(text):
    ids = LIBRARY.encode_ordinary(text)
    assert WHOLE.encode(text).tolist() == ids and CHOPPED.encode(text).tolist() == ids
    assert CHOPPED.decode(np.array(ids, dtype=np.int32)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(PART, max_size=20).map("".join))
def test_each_match_is_encoded_separately(text):
    assert CHOPPED.encode(text).tolist() == [i for match in regex.findall(PATTERN, text) for i in LIBRARY.encode_ordinary(match)]


@pytest.mark.parametrize("white", [" ", "\n", "\t", "　"])
def test_millions_of_blanks(white):
    run = white * 2_000_000
    for before, after in (("", ""), ("a", ""), ("", "b c"), ("a" * 100_000, "b c")):
        text = before + run + after
        ids = WHOLE.encode(text)
        assert WHOLE.decode(ids) == text.encode()
        # The same with a run that the library's matcher can take: the middle of the run differs only in length.
        short = LIBRARY.encode_ordinary(before + white * 20_000 + after)
        assert ids[:50].tolist() == short[:50] and ids[-50:].tolist() == short[-50:]


def test_long_texts_without_blanks():
    for text in ("a" * 1_000_000, "漢字" * 300_000, "!?" * 300_000):
        assert WHOLE.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_round_trip_of_all_documents(spark, sf_dir):
    texts = Counter((r.doc_id, r.text or "") for r in table(spark, sf_dir, "documents").collect())
    wanted = Counter()
    for (doc_id, text), n in texts.items():
        ids = LIBRARY.encode_ordinary(text)
        wanted[doc_id, len(ids), sha(",".join(map(str, ids))), sha(text)] += n
    assert Counter(tuple(r) for r in queries.op11_byte_bpe(spark, sf_dir).collect()) == wanted


def test_round_trip_of_odd_rows(odd, nothing):
    rows = byte_bpe.decode(byte_bpe.encode(odd, RANKS, PATTERN), RANKS, PATTERN).collect()
    wanted = Counter((r.doc_id, tuple(LIBRARY.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in odd.collect())
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in rows) == wanted
    empty = byte_bpe.decode(byte_bpe.encode(nothing, RANKS, PATTERN), RANKS, PATTERN)
    assert empty.count() == 0 and empty.columns == ["doc_id", "ids", "decoded"]


def test_bytes_of_ids_that_end_inside_a_character(spark):
    half = LIBRARY.encode_ordinary("🙂")[:1]
    rows = spark.createDataFrame([(1, half), (2, []), (3, None), (4, [None, 1]), (5, [10**9]), (6, [-1])], "doc_id long, ids array<int>")
    found = {r.doc_id: r.decoded for r in byte_bpe.decode(rows, RANKS, PATTERN).collect()}
    assert bytes(found[1]) == LIBRARY.decode_bytes(half) and bytes(found[2]) == b""
    assert found[3] is found[4] is found[5] is found[6] is None


def tokens(text):
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text)


def predicted(offsets, error):
    starts, bases, slopes, residuals = fill_in_middle.fit(offsets, error)
    segment = np.searchsorted(starts, np.arange(len(offsets)), side="right") - 1
    guess = bases[segment] + ((np.arange(len(offsets)) - starts[segment]) * slopes[segment] >> fill_in_middle.SLOPE_BITS)
    return guess, residuals, starts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 400) | st.integers(1, 5), max_size=400), st.sampled_from([1, 7, 120]))
def test_segments_stay_within_their_error(steps, error):
    offsets = np.cumsum([0, *steps])
    guess, residuals, starts = predicted(offsets, error)
    assert (guess + residuals == offsets).all() and np.abs(offsets - guess).max() <= error + 2
    assert starts[0] == 0 and (np.diff(starts) > 0).all()


def test_one_segment_serves_many_ranks():
    offsets = np.cumsum([0] + [5, 1] * 200_000)
    guess, residuals, starts = predicted(offsets, 120)
    assert (guess + residuals == offsets).all() and len(starts) <= len(offsets) / fill_in_middle.LONGEST + 1


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_boundaries_are_those_of_the_tokens(text):
    assert fill_in_middle.boundaries(text).tolist() == np.cumsum([0, *map(len, tokens(text))]).tolist()


def cut_by_hand(doc_id, text, seed="1"):
    text, digest = text or "", sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    units = tokens(text)
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    spm = h4 % 100 < 20
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), "spm" if spm else "psm", len(prefix), len(middle), output


MORE_TEXTS = ["x <P> y", "<S", "a<<b<", "<<<<", "word" * 300_000, " " * 300_000, "a b " * 100_000, "🙂é" * 1000, "\x00\n"]


@pytest.mark.parametrize("seed", ["1", "7"])
def test_cuts_of_odd_rows(spark, odd, nothing, seed):
    # Every text under many ids, so that all forms and cuts at the ends come up.
    docs = odd.unionByName(documents(spark, [(100 + k, t) for k, t in enumerate(MORE_TEXTS * 12 + ["One two, 3 and four"] * 200)]))
    made = fill_in_middle.transform(fill_in_middle.rank_index(docs), seed)
    rows = made.withColumn("restored", fill_in_middle.restored(F.col("form"), F.col("output"))).collect()
    wanted = Counter((*cut_by_hand(r.doc_id, r.text, seed), r.text or "") for r in docs.collect())
    assert Counter(tuple(r) for r in rows) == wanted
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_in_middle.transform(fill_in_middle.rank_index(nothing)).count() == 0


def test_a_stored_index_serves_other_cuts(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    fill_in_middle.rank_index(docs).write.parquet(str(tmp_path / "index"))
    kept = spark.read.parquet(str(tmp_path / "index"))
    for seed in ("1", "2"):
        rows = fill_in_middle.transform(kept, seed).collect()
        assert Counter(tuple(r) for r in rows) == Counter(cut_by_hand(r.doc_id, r.text, seed) for r in docs.collect())


def test_markers_that_could_arise_where_texts_meet_are_refused(odd):
    for markers in (("PRE", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("<<P>", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle.transform(fill_in_middle.rank_index(odd), markers=markers)


def clusters_by_hand(vectors, k, rounds, seed="3"):
    """``vectors``: (id, integers)."""
    order = sorted(range(len(vectors)), key=lambda i: (sha(f"{seed}:{'' if vectors[i][0] is None else vectors[i][0]}"), vectors[i][1]))
    centers = [list(vectors[i][1]) for i in order[:k]]
    distance = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min((distance(v, c), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        own = [[v for _, v in vectors if nearest(v)[1] == n] for n in range(len(centers))]
        centers = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(own, centers)]
    found = [(i, *nearest(v)) for i, v in vectors]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    return Counter((i, n, d, inertia[n], sum(inertia.values()), sha(",".join(map(str, centers[n])))) for i, d, n in found)


def vectors(spark, rows):
    fields = [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
    fields += [T.StructField(c, T.StringType()) for c in ("v", "digest", "cluster", "distance", "label")]
    return spark.createDataFrame([(*row, *["x"] * 5) for row in rows], T.StructType(fields))


def test_clusters_of_all_vectors(spark, sf_dir):
    kept = [(r.vec_id, [int(np.floor(1024 * float(x))) for x in r.embedding]) for r in table(spark, sf_dir, "embeddings").collect()]
    assert Counter(tuple(r) for r in queries.op13_centroid_clustering(spark, sf_dir).collect()) == clusters_by_hand(kept, 8, 10)


def test_clusters_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 7)
    random = np.random.default_rng(3)
    good = [(i, [float(x) for x in random.normal(size=3).astype(np.float32)]) for i in range(60)]
    good += [(5, [0.5, 0.5, 0.5])] * 30 + [(None, [0.25, -0.25, 0.0]), (None, [-1.0, 2.0, 0.0])]  # repeated, tied, without an id
    bad = [(200, None), (201, [1.0, None, 1.0]), (202, [float("nan"), 0.0, 0.0]), (203, [float("inf"), 0.0, 0.0]), (204, [1.0]), (205, [])]
    frame = vectors(spark, good + bad).repartition(3)
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in good]
    for k, rounds in ((4, 3), (1, 1), (200, 2), (3, 0)):
        found = centroids.cluster(centroids.quantised(frame, 3), k, rounds).collect()
        assert Counter(tuple(r) for r in found) == clusters_by_hand(kept, k, rounds)
    none = centroids.cluster(centroids.quantised(vectors(spark, []), 3))
    assert none.count() == 0 and len(none.columns) == 6
    assert centroids.cluster(centroids.quantised(vectors(spark, bad), 3)).count() == 0


def test_clusters_of_large_numbers(spark):
    big = [(i, [float(np.float32((-1) ** i * 3e6 * (i + 1))), 1.0]) for i in range(20)]
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in big]
    found = centroids.cluster(centroids.quantised(vectors(spark, big), 2), 3, 4).collect()
    assert Counter(tuple(r) for r in found) == Counter(
        (i, c, min(d, centroids.MOST), min(own, centroids.MOST), min(every, centroids.MOST), s) for i, c, d, own, every, s in clusters_by_hand(kept, 3, 4)
    )
    huge = [(i, [3e38 * (i % 3 - 1), 0.0]) for i in range(9)]
    assert {r.distance for r in centroids.cluster(centroids.quantised(vectors(spark, huge), 2), 2, 2).collect()} <= {0, centroids.MOST}
