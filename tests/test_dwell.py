"""Page visits against a sequential replay, whole, sliced and in micro-batches."""

import random

import pytest

from footfall.operators.dwell import order_events, open_pages, page_visits, visits_of
from footfall.operators.slices import slice_hot_keys
from tests.conftest import rows_of

TTL = 30 * 60_000
DDL = "session_id STRING, event_id STRING, event_time BIGINT, seq BIGINT, user_id BIGINT, url STRING"
PAGE = ["user_id", "url"]


def replay(events):
    """One event after the other, per session."""
    state, seen, out = {}, {}, []
    for session, event, time, _, user, url in sorted(events, key=lambda e: (e[2], e[3])):
        last = state.get(session)
        if session in seen and time - seen[session] >= TTL:
            last = None
        seen[session] = time
        if event == "page_load" and last:
            out.append((session, last[0], last[1], last[2], time))
        if event in ("page_load", "wake_up"):
            last = (user, url, time)
        state[session] = last
        out.append((session, user, url, last[2] if last else None, time))
    return sorted(tuple("" if v is None else str(v) for v in row) for row in out)


def random_events(seed, n=1500, hot=True):
    rng = random.Random(seed)
    events, time = [], 1_704_067_200_000
    for seq in range(n):
        time += rng.choice([0, 0, 500, 20_000, 61_000, 300_000, TTL - 61_000, TTL] if rng.random() < 0.5 else [1000])
        session = "hot" if hot and rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        event = rng.choice(["page_load", "wake_up", "item_share", "other"])
        events.append((session, event, time, seq, rng.randrange(3), rng.choice(["/a.html", "/b.html", None])))
    return events


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("cut", [None, dict(min_rows=100), dict(min_rows=1)])
def test_equals_replay(spark, seed, cut):
    events = random_events(seed)
    df = spark.createDataFrame(events, DDL)
    slicer = slice_hot_keys("session_id", "event_time", **cut) if cut else None
    visits = page_visits(df, PAGE, ["seq"], cut=slicer)
    assert rows_of(visits, "session_id", *PAGE, "page_load_time", "event_time") == replay(events)


@pytest.mark.parametrize("cut", [None, dict(min_rows=50)])
def test_batches_continue(spark, cut):
    """Cut at arbitrary points, each batch with the pages left open by the ones before."""
    events = random_events(3, 600)
    out, carried = [], None
    slicer = slice_hot_keys("session_id", "event_time", **cut) if cut else None
    for start in range(0, len(events), 200):
        df = spark.createDataFrame(events[start:start + 200], DDL)
        ordered = order_events(df, PAGE, ["seq"], cut=slicer, carried=carried)
        out += visits_of(ordered, PAGE).select("session_id", *PAGE, "page_load_time", "event_time").collect()
        state = open_pages(ordered)
        carried = spark.createDataFrame(state.collect(), state.schema)
    assert sorted(tuple("" if v is None else str(v) for v in r) for r in out) == replay(events)


def test_small_cases(spark):
    minute = 60_000
    cases = {
        "load-load": [("page_load", 0, "/a"), ("page_load", minute, "/b")],
        "load-wake": [("page_load", 0, "/a"), ("wake_up", minute, "/b")],
        "other first": [("item_share", 0, "/a")],
        "gap of exactly 30 minutes": [("page_load", 0, "/a"), ("page_load", TTL, "/b")],
        "kept alive": [("page_load", 0, "/a"), ("x", TTL - 1, "/a"), ("x", 2 * TTL - 2, "/a")],
        "closed page without url": [("page_load", 0, None), ("page_load", minute, "/b")],
    }
    events = [(name, event, time, i, 1, url) for name, steps in cases.items()
              for i, (event, time, url) in enumerate(steps)]
    visits = page_visits(spark.createDataFrame(events, DDL), ["url"], ["seq"])
    got = {}
    for r in visits.collect():
        got.setdefault(r.session_id, set()).add((r.url, r.page_load_time, r.event_time))
    assert got["load-load"] == {("/a", 0, 0), ("/a", 0, minute), ("/b", minute, minute)}
    assert got["load-wake"] == {("/a", 0, 0), ("/b", minute, minute)}
    assert got["other first"] == {("/a", None, 0)}
    assert got["gap of exactly 30 minutes"] == {("/a", 0, 0), ("/b", TTL, TTL)}
    assert got["kept alive"] == {("/a", 0, 0), ("/a", 0, TTL - 1), ("/a", 0, 2 * TTL - 2)}
    assert got["closed page without url"] == {(None, 0, 0), (None, 0, minute), ("/b", minute, minute)}


def test_empty(spark):
    assert page_visits(spark.createDataFrame([], DDL), PAGE, ["seq"]).count() == 0
