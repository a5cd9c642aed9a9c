import importlib
import random

import numpy as np
import pytest
from conftest import ODD_ROWS, table as odd_table
from parity.compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from sitegrade.llm import importance_resampling as resampling, queries
from sitegrade.llm.common import table


def corpus(n=600, seed=3):
    """Plain text; a fifth has bad words, of which each document has some."""
    rnd = random.Random(seed)
    good = [f"word{k}" for k in range(300)]
    bad = [f"vile{k}" for k in range(8)]
    rows, labels = [], []
    for i in range(n):
        text, is_bad = rnd.choices(good, k=rnd.randint(20, 200)), i % 5 == 0
        if is_bad:
            for _ in range(max(2, len(text) // 20)):
                text[rnd.randrange(len(text))] = rnd.choice(bad)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(is_bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    seen = [l for l in labels if l[0] % 2 == 0]
    drawn = resampling.select(odd_table(spark, rows), spark.createDataFrame(seen, "doc_id long, quality int, toxic int"))
    keep = {r.doc for r in drawn.scored.where(F.col("perturbed") >= drawn.threshold).collect()}
    unseen = [l for l in labels if l[0] % 2]
    assert np.mean([l[0] in keep for l in unseen if not l[2]]) > 0.95
    assert np.mean([l[0] not in keep for l in unseen if l[2]]) > 0.95
    assert len(keep) == drawn.k


def test_held_out_accuracy_on_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels")
    drawn = resampling.select(table(spark, folder, "documents"), labels.where("doc_id % 2 = 0"))
    unseen = drawn.scored.join(labels.where("doc_id % 2 = 1").withColumnRenamed("doc_id", "doc"), "doc")
    keep = unseen.groupBy(((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")).agg(F.avg((F.col("perturbed") >= drawn.threshold).cast("int")).alias("share"))
    share = {r.good: r.share for r in keep.collect()}
    assert share[True] > 0.9 and share[False] < 0.15


def test_weights_equal_the_definition(spark):
    rows, labels = corpus(40)
    drawn = resampling.select(odd_table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    hashes = resampling.WordHashes()
    each = {i: {o: resampling.ngrams(resampling._hashed(t, hashes), o) for o in resampling.ORDERS} for i, t in rows}
    good = {i for i, q, t in labels if not t}
    count = lambda ids, o: np.bincount(np.concatenate([each[i][o] for i in ids]), minlength=resampling.BUCKETS)
    models = {o: resampling.Model.of(count(each, o), count(good, o), resampling.PSEUDO_COUNTS[o]) for o in resampling.ORDERS}
    for r in drawn.scored.collect():
        assert r.log_weight == pytest.approx(resampling.log_weight(resampling._hashed(dict(rows)[r.doc], hashes), models, r.doc in good))


def test_exactly_k_are_drawn(spark):
    values = spark.range(5000).select(F.sin("id").alias("v"))
    for k in (0, 1, 17, 2500, 4999, 5000):
        cut = resampling._kth(values, "v", k)
        assert values.where(F.col("v") >= cut).count() == k


def test_the_draw_is_a_gumbel_top_k(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    selection = resampling.select(docs, labels)
    bits = F.xxhash64(F.lit(resampling.SEED), "doc", "row").alias("bits")
    rows = selection.scored.select("doc", "row", "log_weight", bits).collect()
    uniform = np.array([((r.bits % 2**64 >> 11) + 0.5) / 2**53 for r in rows])
    noise = -np.log(-np.log(uniform))
    assert abs(noise.mean() - np.euler_gamma) < 5 * noise.std() / len(rows) ** 0.5 and abs(noise.std() - np.pi / 6**0.5) < 0.15
    best = np.argsort(-(np.array([r.log_weight for r in rows]) + noise), kind="stable")[: selection.k]
    drawn = selection.scored.where(F.col("perturbed") >= selection.threshold).select("doc", "row").collect()
    assert 0 < selection.k < len(rows) and {tuple(r) for r in drawn} == {(rows[i].doc, rows[i].row) for i in best.tolist()}


def test_quality_of_odd_rows(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd_labels = spark.createDataFrame([(None, 1, 0), (3, None, 1), (5, 1, None), (6, 1, 0), (6, 0, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd_labels):
        drawn = resampling.select(odd, labels)
        assert resampling.selected(odd, drawn).columns == odd.columns
    assert resampling.selected(odd, resampling.select(odd, none)).count() == odd.count()
    assert resampling.selected(nothing, resampling.select(nothing, odd_labels)).count() == 0


@pytest.mark.parametrize("name", queries.oracles())
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(queries.registry()[name](spark, sf_dir), connect(sf_dir), queries.oracles()[name]) == ""


def test_one_query_for_each_operator():
    names = sorted(queries.registry())
    assert len(names) == 14 and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n != "pipeline"} == set(range(1, 14))
    entry = importlib.import_module("__spark_entry__")
    assert set(names) <= set(entry.queries())


def test_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(rows[0].asDict())
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]


def test_stages_take_odd_rows(spark, sf_dir):
    docs = odd_table(spark, ODD_ROWS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.withColumn("n_chars", F.length("text").cast("long")), sf_dir)
        assert out.columns == [*docs.columns, "n_chars"]
        assert stage(spark, docs.withColumn("n_chars", F.length("text").cast("long")).limit(0), sf_dir).count() == 0
        out.count()
