"""Streams of files: any order, late rows, stops and restarts."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parity import star_feeds
from rows import inspections
from sitegrade.operators import clean
from sitegrade.sources import feeds
from sitegrade.sources.feeds import RAT_FEED
from sitegrade.streaming import latest, windows

START = dt.datetime(2024, 1, 1)
KEY = "job_ticket_or_work_order_id"
EVENTS = "event_id long, ts timestamp, kind string"


def arguments(spark, tmp_path):
    measures = {"n": F.count(F.lit(1)), "ids": F.sum("event_id")}
    window = dict(at="ts", width="1 day", delay="3 days", ids=["event_id"], keys=["kind"], measures=measures)
    return dict(schema=spark.createDataFrame([], EVENTS).schema, target=str(tmp_path / "out"), checkpoint=str(tmp_path / "state"), **window)


def event(n, hours, kind="a"):
    return n, START + dt.timedelta(hours=hours, minutes=7), kind


def land(spark, folder, batches):
    """One file a batch, in this order."""
    for rows in batches:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(folder))


def closed_by_hand(rows, newest):
    """Windows that end by the watermark: three days before the newest row."""
    groups = {}
    for n, at, kind in rows:
        day = dt.datetime(at.year, at.month, at.day)
        if day + dt.timedelta(days=1) <= newest - dt.timedelta(days=3):
            count, total = groups.get((day, kind), (0, 0))
            groups[day, kind] = count + 1, total + n
    return Counter((day, kind, *v) for (day, kind), v in groups.items())


def found(df):
    return Counter((r.window_start.replace(tzinfo=None), r.kind, r.n, r.ids) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_within_the_delay_gives_the_batch_result(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [event(n, n * 2, rng.choice("ab")) for n in range(120)]  # ten days
    # Each row comes up to two days late, and some come twice.
    late = sorted(rows + rows[:20], key=lambda r: (r[1] + dt.timedelta(hours=rng.random() * 48), rng.random()))
    batches = [late[k : k + 28] for k in range(0, len(late), 28)]
    args = arguments(spark, tmp_path)
    read = dropped = 0
    for batch in batches:  # every batch a run of its own: state survives the stop
        land(spark, tmp_path / "in", [batch])
        result, progress = windows.run(spark, str(tmp_path / "in"), **args)
        read, dropped = read + progress.rows, dropped + progress.late
    assert (read, dropped) == (140, 0)
    assert found(result) == closed_by_hand(rows, max(r[1] for r in rows))


def test_late_rows_are_left_out_and_counted(spark, tmp_path):
    batches = [[event(1, 0), event(2, 30)], [event(3, 24 * 8), event(4, 24 * 8, "b")], [event(5, 24 * 4), event(6, 24 * 6), event(7, 3), event(8, 5, "b")], [event(9, 24 * 14)]]
    land(spark, tmp_path / "in", batches[:1])
    args = arguments(spark, tmp_path)
    windows.run(spark, str(tmp_path / "in"), **args)
    late = []
    for batch in batches[1:]:
        land(spark, tmp_path / "in", [batch])
        result, progress = windows.run(spark, str(tmp_path / "in"), **args)
        late.append(progress.late)
    # The watermark stood at day 5 when rows of days 4, 6 and 0 came.
    assert late == [0, 3, 0]
    kept = [row for batch in batches for row in batch if row[0] not in (5, 7, 8)]
    assert found(result) == closed_by_hand(kept, batches[-1][0][1])


def read_stream(spark, folder):
    return spark.readStream.schema(RAT_FEED.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def newest(spark, folder, tmp_path, keep=dt.timedelta(days=30)):
    rows = read_stream(spark, folder).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("inspection_date", "approved_date")})
    rows = rows.select(KEY, "inspection_date", "approved_date", *clean.RAT_TIE_BREAK)
    return latest.run(spark, rows, [KEY], ["inspection_date", "approved_date"], clean.RAT_TIE_BREAK, str(tmp_path / "news"), str(tmp_path / "state"), keep)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_the_stream_equals_the_batch_after_a_stop_and_a_restart(spark, sf_dir, tmp_path):
    raw = feeds.conform(star_feeds.raw_rat(spark, sf_dir), RAT_FEED).limit(150)
    raw.repartition(2).write.parquet(str(tmp_path / "in"))
    first = newest(spark, tmp_path / "in", tmp_path)
    assert same(first, clean.latest_work_orders(raw))
    odd = [
        {"job_ticket_or_work_order_id": None, "inspection_date": "2001-01-01T00:00:00.000"}, {"job_ticket_or_work_order_id": None, "inspection_date": None, "job_id": None},
        {"job_ticket_or_work_order_id": "1", "inspection_date": "2030-01-01T00:00:00.000"}, {"job_ticket_or_work_order_id": "2", "inspection_date": "1990-01-01T00:00:00.000"},
        {"job_ticket_or_work_order_id": "new", "inspection_date": None, "result": 'a "quoted" one'},
    ]
    more = feeds.conform(inspections(spark, *odd, *odd), RAT_FEED)
    more.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    again = newest(spark, tmp_path / "in", tmp_path)
    assert same(again, clean.latest_work_orders(raw.unionByName(more)))
    news = spark.read.parquet(str(tmp_path / "news")).count()
    assert again.count() <= news < raw.count() + more.count()


def test_a_key_that_expired_loses_nothing(spark, tmp_path):
    batches = [
        [{"job_ticket_or_work_order_id": "1", "inspection_date": "2024-05-01T00:00:00.000"}],
        [{"job_ticket_or_work_order_id": "2", "inspection_date": "2024-05-01T00:00:00.000"}],  # by now the state of 1 has expired
        [{"job_ticket_or_work_order_id": "1", "inspection_date": "2024-04-01T00:00:00.000"}],  # older, the first of a new state
    ]
    seen = []
    for batch in batches:
        seen += batch
        inspections(spark, *batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        result = newest(spark, tmp_path / "in", tmp_path, dt.timedelta(milliseconds=1))
        assert same(result, clean.latest_work_orders(feeds.conform(inspections(spark, *seen), RAT_FEED)))
    assert spark.read.parquet(str(tmp_path / "news")).count() == 3


def test_keys_share_states(spark, tmp_path):
    """Three buckets for 60 keys: no more states than buckets, and every key its own newest row and its own expiry."""
    folder, news = tmp_path / "in", str(tmp_path / "news")

    def batch(days):
        changes = [{KEY: str(k), "job_id": f"{day}-{k}", "inspection_date": f"2024-05-{day:02d}T00:00:00.000"} for day, keys in days.items() for k in keys]
        inspections(spark, *changes).coalesce(1).write.mode("append").parquet(str(folder))
        rows = read_stream(spark, folder).select(KEY, "inspection_date", "job_id")
        stream = latest.newest_rows(rows, [KEY], ["inspection_date", "job_id"], dt.timedelta(days=30), buckets=3)
        query = stream.writeStream.format("parquet").option("path", news).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        sent = spark.read.parquet(news).count()
        found = latest.newest_of(spark, news, rows.schema, [KEY], ["inspection_date", "job_id"], [])
        return max(states), sent, {r[KEY]: r.job_id for r in found.collect()}

    first = {str(k): f"10-{k}" for k in range(60)}
    assert batch({10: range(60), 9: range(30)}) == (3, 60, first)
    assert batch({8: range(0, 60, 2), 11: range(0, 60, 3)}) == (3, 80, first | {str(k): f"11-{k}" for k in range(0, 60, 3)})
