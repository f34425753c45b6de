"""Play segments against a sequential replay, whole, sliced and in micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from footfall.operators.segments import mark_segments, play_state
from footfall.operators.slices import slice_hot_keys
from tests.conftest import rows_of

DDL = "play_id STRING, event_id STRING, event_time BIGINT, seq BIGINT"


def replay(events):
    out, by_play = [], {}
    for e in events:
        by_play.setdefault(e[0], []).append(e)
    for play, rows in by_play.items():
        rows.sort(key=lambda e: e[2])
        for _, _, time, seq in rows:
            resumes = [e[2] for e in rows if e[1] == "video_resume" and e[2] <= time]
            start = max(resumes) if resumes else rows[0][2]
            out.append((play, str(seq), str(len(resumes)), str(start)))
    return sorted(tuple("" if v is None else v for v in row) for row in out)


def random_events(seed, n=800, ties=True):
    rng = random.Random(seed)
    time, events = 1_704_067_200_000, []
    for seq in range(n):
        time += rng.choice([0, 1000, 70_000] if ties else [1, 1000, 70_000])
        play = rng.choice(["hot", "hot", "p1", "p2", None])
        events.append((play, rng.choice(["video_play", "video_hb", "video_resume", "video_stop"]), time, seq))
    return events


@pytest.mark.parametrize("cut", [None, dict(min_rows=100), dict(min_rows=1)])
def test_equals_replay(spark, cut):
    events = random_events(1)
    slicer = slice_hot_keys("play_id", "event_time", **cut) if cut else None
    marked = mark_segments(spark.createDataFrame(events, DDL), slicer)
    assert rows_of(marked, "play_id", "seq", "part_no", "part_start_time") == replay(events)


@pytest.mark.parametrize("cut", [None, dict(min_rows=30)])
def test_batches_continue(spark, cut):
    events, out, carried = random_events(2, 400, ties=False), [], None
    slicer = slice_hot_keys("play_id", "event_time", **cut) if cut else None
    for start in range(0, len(events), 150):
        df = spark.createDataFrame(events[start:start + 150], DDL)
        out += rows_of(mark_segments(df, slicer, carried), "play_id", "seq", "part_no", "part_start_time")
        state = play_state(df, carried)
        carried = spark.createDataFrame(state.collect(), state.schema)
    assert sorted(out) == replay(events)


def test_ties_and_single_event(spark):
    events = [("p", "video_play", 10, 1), ("p", "video_hb", 20, 2), ("p", "video_resume", 20, 3), ("q", "video_hb", 5, 4)]
    marked = {r.seq: (r.part_no, r.part_start_time) for r in mark_segments(spark.createDataFrame(events, DDL)).collect()}
    assert marked == {1: (0, 10), 2: (1, 20), 3: (1, 20), 4: (0, 5)}


def test_ordinary_keys_are_not_sliced(spark):
    """Without a hot key the plan that runs has one data shuffle and no seed branch."""
    df = spark.createDataFrame(random_events(5), DDL)
    marked = mark_segments(df)
    marked.collect()
    final = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Union" not in final


def test_a_burst_is_cut_by_rows(spark):
    """Most rows of a key within seconds, some of them at one time: no slice is above twice the size."""
    times = [(i // 1000 * 1000 + i % 50 * 20) for i in range(19_000)] + [20_000 + i * 60_000 for i in range(1000)]
    rows = spark.createDataFrame([("k", t) for t in times] + [("other", 5)] * 3, "play_id string, event_time long")
    sliced = slice_hot_keys("play_id", "event_time", min_rows=1000)(rows)
    sizes = {r["__slice"]: r["n"] for r in sliced.where("play_id = 'k'").groupBy("__slice").agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == 20_000 and max(sizes.values()) <= 2000 and len(sizes) <= 20
    order = sliced.where("play_id = 'k'").groupBy("__slice").agg(F.min("event_time").alias("a"), F.max("event_time").alias("b"))
    spans = [(r.a, r.b) for r in order.orderBy("__slice").collect()]
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))
    assert {r["__slice"] for r in sliced.where("play_id = 'other'").collect()} == {-1}
    dense = spark.createDataFrame([("k", 7 + i % 40) for i in range(20_000)], "play_id string, event_time long")
    parts = slice_hot_keys("play_id", "event_time", min_rows=1000)(dense).groupBy("__slice").count().collect()
    assert max(r["count"] for r in parts) <= 2000
