"""Histories, trailing sums, ranks and subtotals against plain loops, in small blocks so that keys span several."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sitegrade.operators import frames, history, line, rollups
from sitegrade.sources.sinks import TableStore

START = dt.datetime(2024, 1, 30)
SCHEMA = "camis int, at timestamp_ntz, dba string, street string, score int"


def sample(seed, n=300, days=400):
    """One key has 40 % of the rows; moments repeat, and every column has nulls."""
    rng = random.Random(seed)
    rows = [
        (
            7 if rng.random() < 0.4 else rng.choice([1, 2, 3, 4, None]),
            None if rng.random() < 0.03 else START + dt.timedelta(days=rng.randrange(days)),
            rng.choice(["a", "a", "b", None]), rng.choice(["x", "x", "x", None]), rng.choice([None, *range(10)]),
        )
        for _ in range(n)
    ]
    return rows + rows[:9]


def largest(values):
    return max(values, key=lambda v: tuple((x is not None, x or "") for x in v))


def history_by_hand(rows):
    seen = defaultdict(list)
    for camis, at, dba, street, _ in rows:
        if camis is not None and at is not None:
            seen[camis, at].append((dba, street))
    out, keys = [], defaultdict(list)
    for (camis, at), found in sorted(seen.items()):
        keys[camis].append((at, largest(found)))
    for camis, points in keys.items():
        starts = [p for k, p in enumerate(points) if k == 0 or points[k - 1][1] != p[1]]
        out += [(camis, *p[1], p[0], starts[k + 1][0] if k + 1 < len(starts) else None) for k, p in enumerate(starts)]
    return Counter(out)


def stretches(df):
    return Counter(tuple(r) for r in df.select("camis", "dba", "street", "valid_from", "valid_to").collect())


@pytest.mark.parametrize("seed,block", [(1, 10_000), (2, 25), (3, 4)])
def test_history_equals_a_loop(spark, tmp_path, seed, block):
    rows, store = sample(seed), TableStore(str(tmp_path))
    seen = history.observations(spark.createDataFrame(rows, SCHEMA), ["camis"], "at", ["dba", "street"])
    found = history.history(seen, store, ["camis"], "at", ["dba", "street"], block)
    assert stretches(found) == history_by_hand(rows)
    blocks = store.read(spark, "history_seen", "blocks")
    assert blocks.where("camis = 7").select("_block").distinct().count() > (2 if block < 100 else 0)
    assert history.history(seen.limit(0), store, ["camis"], "at", ["dba", "street"], name="none").count() == 0


def test_late_and_repeated_batches_give_the_same_history(spark, tmp_path):
    rows, store = sample(4, 200), TableStore(str(tmp_path))
    random.Random(5).shuffle(rows)
    taken = []
    for batch in (rows[:120], rows[100:], rows[50:150], []):
        taken += batch
        frame = spark.createDataFrame(batch, SCHEMA)
        found = history.merge_history(frame, store, ["camis"], "at", ["dba", "street"], "sites", buckets=3, rows_per_block=30)
        assert stretches(found) == history_by_hand(taken)


def test_a_late_row_splits_a_stretch(spark, tmp_path):
    store, day = TableStore(str(tmp_path)), lambda n: START + dt.timedelta(days=n)
    merge = lambda *rows: stretches(
        history.merge_history(spark.createDataFrame([(1, at, dba, None, 0) for at, dba in rows], SCHEMA), store, ["camis"], "at", ["dba", "street"], "t", buckets=2)
    )
    assert merge((day(0), "a"), (day(10), "a")) == Counter([(1, "a", None, day(0), None)])
    # What was confirmed on day 10 holds again from then on.
    split = Counter([(1, "a", None, day(0), day(5)), (1, "b", None, day(5), day(10)), (1, "a", None, day(10), None)])
    assert merge((day(5), "b")) == split and merge((day(5), "b")) == split


def test_a_batch_leaves_other_buckets_alone(spark, tmp_path):
    store = TableStore(str(tmp_path))
    first = spark.range(200).select(F.col("id").cast("int").alias("camis"), F.lit(START).cast("timestamp_ntz").alias("at"), F.lit("a").alias("dba"), F.lit("x").alias("street"))
    history.merge_history(first, store, ["camis"], "at", ["dba", "street"], "t", buckets=8)
    files = lambda: {p.parent.name: p.name for p in (tmp_path / "history/t").glob("*/part-*")}
    before = files()
    history.merge_history(first.where("camis = 5"), store, ["camis"], "at", ["dba", "street"], "t", buckets=8)
    assert len(before) == 8 and sum(before[k] != files()[k] for k in before) == 1


def months_before(at, months):
    year, month = divmod(at.year * 12 + at.month - 1 - months, 12)
    for day in range(at.day, 0, -1):
        try:
            return at.replace(year=year, month=month + 1, day=day)
        except ValueError:
            continue


@pytest.mark.parametrize("seed,block", [(1, 10_000), (2, 20), (3, 3)])
def test_trailing_sums_equal_a_loop(spark, tmp_path, seed, block):
    rows, store = sample(seed), TableStore(str(tmp_path))
    measures = {"n": F.count(F.lit(1)), "score": F.sum("score")}
    found = frames.trailing_sums(spark.createDataFrame(rows, SCHEMA), store, ["camis"], "at", 6, measures, block)
    known = [r for r in rows if r[0] is not None and r[1] is not None]
    wanted = []
    for camis, at in {(r[0], r[1]) for r in known}:
        own = [r for r in known if r[0] == camis and months_before(at, 6) < r[1] <= at]
        earlier = [r[1] for r in known if r[0] == camis and r[1] < at]
        wanted.append((camis, at, len(own), sum(r[4] or 0 for r in own), (at - max(earlier)).days if earlier else None))
    assert Counter(tuple(r) for r in found.select("camis", "at", "n", "score", "days_since_previous").collect()) == Counter(wanted)
    assert found.columns == ["camis", "at", "n", "score", "days_since_previous"]


@pytest.mark.parametrize("seed,block", [(1, 10_000), (2, 20), (3, 1)])
def test_percent_ranks_equal_a_loop(spark, tmp_path, seed, block):
    rows = sample(seed, 200)
    found = frames.percent_ranks(spark.createDataFrame(rows, SCHEMA), TableStore(str(tmp_path)), ["street", "dba"], "score", rows_per_block=block)
    low = lambda v: -1 if v is None else v
    wanted = []
    for row in rows:
        area = [r for r in rows if (r[3], r[2]) == (row[3], row[2])]
        share = sum(low(r[4]) < low(row[4]) for r in area) / (len(area) - 1) if len(area) > 1 else 0.0
        wanted.append((*row, share))
    assert Counter(tuple(r) for r in found.collect()) == Counter(wanted)


def test_functions_of_neighbours_have_no_window_over_a_whole_key(spark, tmp_path):
    rows, store = spark.createDataFrame(sample(6), SCHEMA), TableStore(str(tmp_path))
    trailing = frames.trailing_sums(rows, store, ["camis"], "at", 6, {"n": F.count(F.lit(1))}, 20)
    ranks = frames.percent_ranks(rows, store, ["dba"], "score", rows_per_block=2)
    for df in (trailing, ranks):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in text and "CartesianProduct" not in text
    for name in ("trailing_sums", "trailing_starts"):
        sizes = [r["count"] for r in store.read(spark, name, "blocks").groupBy(line.BLOCK).count().collect()]
        assert len(sizes) > 4 and max(sizes) < 80


PLACES = ["dba", "street"]


@pytest.mark.parametrize("sets", [rollups.cube_sets(PLACES), rollups.rollup_sets(PLACES), [["street"], ["dba", "street"]]])
def test_subtotals_equal_a_loop(spark, sets):
    rows = sample(7)
    found = rollups.grouping_sets(spark.createDataFrame(rows, SCHEMA), PLACES, sets, "camis")
    wanted = []
    for chosen in sets:
        groups = defaultdict(list)
        for camis, _, dba, street, _ in rows:
            groups[tuple(v if c in chosen else None for c, v in zip(PLACES, (dba, street)))].append(camis)
        gid = sum(2 ** (1 - k) for k, c in enumerate(PLACES) if c not in chosen)
        wanted += [(*key, gid, len(held), len({c for c in held if c is not None})) for key, held in groups.items()]
    assert Counter(tuple(r) for r in found.collect()) == Counter(wanted)
    assert found.where("dba is null and street is null").count() > 1 or len(sets) == 2


def test_the_total_gathers_no_values_in_one_task(spark):
    rows = spark.range(0, 100_000, 1, 8).select((F.col("id") % 5).alias("dba"), (F.col("id") % 7).alias("street"), (F.col("id") % 20_000).alias("camis"))
    found = rollups.grouping_sets(rows, PLACES, rollups.cube_sets(PLACES), "camis")
    assert found.where("grouping_id = 3").select("rows", "distinct").collect() == [(100_000, 20_000)]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Expand") == 1 and "SinglePartition" not in text
    # The values are dealt out by group and value before they are counted by group.
    exchanges = [part.split("\n")[0] for part in text.split("Exchange hashpartitioning(")[1:]]
    assert len(exchanges) == 3 and "_value" in exchanges[1]


def test_sketches_merge_in_any_order_and_stay_close(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("street"), (F.col("id") % 24).alias("n"), F.pmod(F.xxhash64("id"), F.lit(9_000)).alias("bin"))
    rows = rows.withColumn("month", F.add_months(F.lit("2024-01-01").cast("date"), F.col("n").cast("int")))
    sketches = rollups.distinct_sketches(rows, ["street", "month"], "bin")
    exact = {r.street: r.n for r in rows.groupBy("street").agg(F.count_distinct("bin").alias("n")).collect()}
    merged = [
        {r.street: r.estimate for r in rollups.merged_estimates(order, ["street"]).collect()}
        for order in (sketches.orderBy("month").coalesce(1), sketches.orderBy(F.desc("month")).coalesce(1), sketches.repartition(7))
    ]
    assert merged[0] == merged[1] == merged[2]
    for street, n in exact.items():
        assert abs(merged[0][street] - n) <= 4 * rollups.relative_error() * n
    window = {(r.street, r.month): r.estimate for r in rollups.trailing_estimates(sketches, ["street"], "month", 6).collect()}
    assert len(window) == 3 * 8
    for (street, month), estimate in window.items():
        inside = rows.where((F.col("street") == street) & (F.col("month") <= month) & (F.col("month") > F.add_months(F.lit(month), -6)))
        n = inside.select("bin").distinct().count() if street == 0 else None
        assert n is None or abs(estimate - n) <= 4 * rollups.relative_error() * n
