import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sitegrade.llm import byte_bpe, packing, queries, token_counts
from sitegrade.llm.common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECES)
COUNTER = token_counts.PrefixCounter(PIECES, remembered_bytes=10_000)
TOKENIZER = Tokenizer.from_file(BYTES)
PART = st.sampled_from([" ", "  ", "\n", "a", "the", "ing", "é", "▁", "<s>", "<0x0A>", "漢", "　", "\x00", "🙂", "12", "..."])


@settings(max_examples=300, deadline=None)
@given(st.lists(PART, max_size=14).map("".join) | st.text(max_size=20))
def test_every_prefix_has_the_count_of_its_own_encoding(text):
    counts = np.cumsum(COUNTER.steps([text])[0], dtype=int).tolist()
    assert counts == [len(MODEL.encode(text[: i + 1])) for i in range(len(text))]


def test_units_are_remembered_by_their_bytes():
    counter = token_counts.PrefixCounter(PIECES, remembered_bytes=100_000)
    texts = ["漢字仮名" * n for n in range(1, 240)] + ["a" * 3000 + str(n) for n in range(20)] + ["é" * 5000]
    for at in range(0, len(texts), 20):
        for text, steps in zip(texts[at : at + 20], counter.steps(texts[at : at + 20])):
            assert int(steps.sum(dtype=int)) == len(MODEL.encode(text))
        assert all(len(unit) <= token_counts.LONG_UNIT for kept in (counter.new, counter.old) for unit in kept)
        assert counter.new_bytes <= 100_000 and sum(map(len, counter.old)) < 100_000


def test_counts_of_all_documents(spark, sf_dir):
    rows = queries.op4_token_counts(spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = len(MODEL.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_counts_of_odd_rows(odd, nothing):
    rows = token_counts.prefix_counts(odd, PIECES, 10).collect()
    texts = [r.text or "" for r in odd.collect()]
    assert Counter((r.n_chars, r.n_tokens) for r in rows) == Counter((len(t), len(MODEL.encode(t))) for t in texts)
    assert token_counts.prefix_counts(nothing, PIECES, 10).count() == 0


def test_truncation_needs_no_encoding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cut = token_counts.truncated(docs, token_counts.prefix_counts(docs, PIECES, 50), 50).collect()
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in cut:
        assert whole[r.doc_id].startswith(r.text) and len(MODEL.encode(r.text)) <= 50
        assert r.text == whole[r.doc_id] or len(MODEL.encode(whole[r.doc_id][: len(r.text) + 1])) > 50


@settings(max_examples=200, deadline=None)
@given(st.lists(PART | st.just("<|endoftext|>"), max_size=14).map("".join) | st.text(max_size=20))
def test_ids_are_those_of_the_library(text):
    assert packing._encoder(BYTES)(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(PART | st.sampled_from(["<|endoftext|>", "    ", " \n\n "]), max_size=20).map("".join))
def test_ids_of_chopped_texts_are_those_of_the_library(text):
    whole = packing._encoder(BYTES).codec
    chopped = byte_bpe.Codec(whole.ranks, packing.PATTERN, whole.special, chunk=4, long_run=3)
    assert chopped.encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("white", [" ", "\n", "\t", "\r\n", "　"])
def test_ids_of_millions_of_blanks(white):
    for text in (white * 2_000_000, "a b" + white * 2_000_000 + "<|endoftext|>", "a" + white * 2_000_000 + "b c"):
        assert packing._encoder(BYTES)(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 1023), st.integers(1, 40), max_size=60))
def test_plan_packs_every_item_once(histogram):
    solved = packing.plan(histogram)
    packed = Counter()
    for pattern, uses in zip(solved.patterns, solved.uses):
        assert 0 < sum(l * n for l, n in pattern) <= 1024 and uses > 0
        for length, copies in pattern:
            packed[length] += copies * uses
    assert packed == Counter(histogram)
    assert solved.cost >= solved.bound - 1e-6


def test_plan_finds_full_patterns():
    solved = packing.plan({700: 100, 324: 100, 600: 50, 212: 100})
    assert solved.cost == 150 * 1024


def check(rows, texts):
    """``texts``: how often each text is there."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[(r.doc_id, r.doc_tokens)].append(r)
        sequences[r.sequence_id].append(r)
    padding = 0
    for own in sequences.values():
        end = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 1024
        padding += 0 if end & (end - 1) == 0 else 1024 - end
    assert sorted(sequences) == list(range(len(sequences)))
    wanted = Counter()
    for (doc_id, text), n in texts.items():
        ids = np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for start in range(0, len(ids), 1024):
            own = ids[start : start + 1024]
            wanted[(doc_id, start, len(own), zlib.crc32(own.tobytes()), len(ids))] += n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == wanted
    return padding


def test_packing_of_all_documents(spark, sf_dir):
    rows = queries.op5_packing(spark, sf_dir).collect()
    texts = Counter((r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect())
    assert check(rows, texts) < 0.03 * sum(r.length for r in rows)


def test_packing_of_odd_rows(odd, nothing):
    rows = packing.pack(odd, BYTES).collect()
    check(rows, Counter((r.doc_id, r.text) for r in odd.collect()))
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)
    assert packing.pack(nothing, BYTES).count() == 0


@pytest.mark.parametrize("fill,cost", [(1, 1), (3, 1024), (512, 512), (1000, 1024), (1024, 1024)])
def test_padding_stops_at_powers_of_two(fill, cost):
    assert packing.padded(fill) == cost
