"""Streams against the batch jobs over the same rows, with restarts, replays, late rows and late dimensions."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from footfall import samples
from footfall.functions.clock import DAY_MS, UTC8_MS, wall_clock
from footfall.jobs import JOBS
from footfall.operators.slices import slice_hot_keys
from footfall.plans import dashboards, dimensions, exploration, olap
from footfall.plans.widen import WIDE_COLUMNS, detail
from footfall.sinks.partitions import read_batches
from footfall.sinks.snapshots import (
    buckets_of, current, newest_version, publish, read_buckets, read_version, write_buckets)
from footfall.sources.events import DWD_DDL, ODS_DDL, read_dwd_stream, read_ods_stream
from footfall.sources.tables import read_changes, read_lines
from footfall.streaming import carried, cumulative, windows
from footfall.streaming.dimensions import start_sync, sync_batch
from footfall.streaming.enrich import EnrichTables, enrich_batch, start_enrich
from tests.conftest import rows_of

FLUSH_SESSION = "flush"


@pytest.fixture(scope="module")
def dwd(spark, sf):
    """The widened sample events, materialised once."""
    frame = samples.dwd(spark, sf, users=True, geo=True, pages=True)
    return frame.persist()


@pytest.fixture(scope="module")
def dwd_files(dwd):
    """JSON lines in four chunks of event-time order, and one event a day later that closes all windows."""
    lines = [r.value for r in dwd.orderBy("event_time", "seq").select(F.to_json(F.struct(*WIDE_COLUMNS)).alias("value"))
             .collect()]
    last = json.loads(lines[-1])
    flush = {"session_id": FLUSH_SESSION, "event_id": "flush", "event_time": last["event_time"] + DAY_MS}
    size = len(lines) // 4 + 1
    return [lines[i:i + size] for i in range(0, len(lines), size)] + [[json.dumps(flush)]]


def drop_file(folder, number, lines):
    folder.mkdir(exist_ok=True)
    path = folder / f"part-{number:03d}.json"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number * 10,) * 2)


def feed(folder, chunks):
    for number, lines in enumerate(chunks):
        drop_file(folder, number, lines)
    return str(folder)


def finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def test_traffic_5m_with_restart(spark, dwd, dwd_files, tmp_path):
    source = tmp_path / "in"
    for number, lines in enumerate(dwd_files[:2]):
        drop_file(source, number, lines)

    def run():
        stream = read_dwd_stream(spark, ["user_id", "session_id", "event_id", "event_time"], path=str(source),
                                 files_per_trigger=1)
        finish(windows.start_table(windows.traffic_5m(stream), str(tmp_path / "out"), str(tmp_path / "ck")))

    run()
    for number, lines in enumerate(dwd_files[2:], 2):
        drop_file(source, number, lines)
    run()
    out = spark.read.parquet(str(tmp_path / "out")).drop("batch_id")
    assert rows_of(out) == rows_of(dashboards.traffic_5m(dwd))


def test_late_row_is_dropped(spark, tmp_path):
    """The clock is global: session t is late because other sessions moved on. It passes on from batch to batch."""
    minute = 60_000
    on_time = [{"user_id": 1, "session_id": "s", "event_id": "page_load", "event_time": t * minute} for t in (1, 21)]
    more = {"user_id": 1, "session_id": "s", "event_id": "x", "event_time": 22 * minute}
    late = {"user_id": 2, "session_id": "t", "event_id": "page_load", "event_time": 2 * minute}
    end = {"user_id": 1, "session_id": "s", "event_id": "x", "event_time": 99 * minute}
    source = feed(tmp_path / "in", [[json.dumps(e) for e in chunk] for chunk in (on_time, [more], [late], [end])])
    stream = read_dwd_stream(spark, path=source, files_per_trigger=1)
    finish(windows.start_table(windows.traffic_5m(stream), str(tmp_path / "out"), str(tmp_path / "ck")))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.pv_amt, r.uv_amt) for r in out.collect()) == [(1, 1), (1, 1)]


def test_traffic_olap(spark, dwd, dwd_files, tmp_path):
    stream = read_dwd_stream(spark, path=feed(tmp_path / "in", dwd_files), files_per_trigger=2)
    finish(windows.start_table(windows.traffic_olap(stream), str(tmp_path / "out"), str(tmp_path / "ck"), "dt"))
    out = spark.read.parquet(str(tmp_path / "out")).drop("batch_id")
    expected = olap.traffic_olap(dwd)
    assert rows_of(out, *expected.columns) == rows_of(expected)


def test_ranking_into_two_tables(spark, dwd, dwd_files, tmp_path):
    stream = read_dwd_stream(spark, ["user_id", "event_time", "properties", "page_type"],
                             path=feed(tmp_path / "in", dwd_files), files_per_trigger=2)
    tables = [str(tmp_path / "t3"), str(tmp_path / "t4")]
    finish(windows.start_ranking(windows.page_uv_5m(stream), tables, str(tmp_path / "ck"), 9))
    expected = rows_of(dashboards.top_pages_overall(dwd))
    for table in tables:
        assert rows_of(current(spark, table)) == expected


def test_running_sum_windows(spark, sf, tmp_path):
    lines = samples.lines(spark, sf).orderBy("action_time").collect()
    text = [",".join(str(v) for v in r) for r in lines]
    end = f"x,x,x,1,{lines[-1].action_time + 1000}"
    source = feed(tmp_path / "in", [text[:500], text[500:], [end]])
    stream = read_lines(spark, source, streaming=True)
    finish(windows.start_table(windows.running_sum_windows(stream), str(tmp_path / "out"), str(tmp_path / "ck")))
    out = spark.read.parquet(str(tmp_path / "out")).drop("batch_id")
    assert rows_of(out) == rows_of(exploration.running_sum_then_window(samples.lines(spark, sf)).drop("sum_age"))


@pytest.mark.parametrize("name", ["traffic_today", "promotion_today"])
def test_cumulative(spark, dwd, dwd_files, tmp_path, name):
    stream = read_dwd_stream(spark, path=feed(tmp_path / "in", dwd_files), files_per_trigger=2)
    job, steps = getattr(cumulative, name)(stream, str(tmp_path / "out"))
    finish(job.start(steps, str(tmp_path / "ck")))
    expected = getattr(dashboards, name)(dwd)
    assert rows_of(job.dashboard(spark, closed_step=288), *expected.columns) == rows_of(expected)
    # The job's own rows: each window once, all of them up to the newest closed step and none beyond.
    written = spark.read.parquet(str(tmp_path / "out/dashboard"))
    newest = current(spark, str(tmp_path / "out/closed")).first()
    end = wall_clock(F.lit(newest.day).cast("long") * DAY_MS - UTC8_MS + newest.step * 300_000)
    closed = expected.where(F.col("window_end") <= end)
    assert rows_of(written, *expected.columns) == rows_of(closed) and not closed.isEmpty()
    assert rows_of(job.dashboard(spark), *expected.columns) == rows_of(closed)


def test_cumulative_state_has_a_row_per_combination(spark, dwd, dwd_files, tmp_path):
    """The keys of a row share one state row per step; a row for each key of its own doubled the state."""
    stream = read_dwd_stream(spark, path=feed(tmp_path / "in", dwd_files))
    job, steps = cumulative.traffic_today(stream, str(tmp_path / "out"))
    query = job.start(steps, str(tmp_path / "ck"))
    finish(query)
    kept = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    wanted = dwd.where("event_time IS NOT NULL").selectExpr("event_time div 300000", "user_id", "session_id").distinct().count()
    assert wanted // 2 < kept <= wanted + 5, "besides those of messages that only move the clock"


def test_cumulative_batch_replayed(spark, tmp_path):
    ddl = "day INT, step INT, kind STRING, key STRING, n BIGINT"
    job = cumulative.CumulativeJob({}, "pv_amt", ["uv_amt"], str(tmp_path / "out"))
    first = spark.createDataFrame([(1, 3, "rows", None, 4), (1, 3, "uv_amt", "a", 0), (1, 3, "uv_amt", None, 0)], ddl)
    second = spark.createDataFrame([(1, 5, "rows", None, 1), (1, 5, "uv_amt", "a", 0), (1, 6, "rows", None, 1),
                                    (1, 6, "uv_amt", "b", 0), (1, 5, "uv_amt", "b", 0)], ddl)
    job.add_batch(first, 0)
    job.add_batch(second, 1)
    job.add_batch(second, 1)
    windows_ = {str(r.window_end)[11:16]: (r.pv_amt, r.uv_amt) for r in job.dashboard(spark, 1, closed_step=7).collect()}
    assert windows_ == {"00:15": (4, 1), "00:20": (4, 1), "00:25": (5, 2), "00:30": (6, 2), "00:35": (6, 2)}


@pytest.mark.parametrize("cut", [None, dict(min_rows=5)])
def test_page_dwell(spark, dwd, dwd_files, tmp_path, cut):
    slicer = slice_hot_keys("session_id", "event_time", **cut) if cut else None
    stream = read_dwd_stream(spark, path=feed(tmp_path / "in", dwd_files), files_per_trigger=1)
    out = str(tmp_path / "out")

    def step(batch, batch_id):
        carried.dwell_batch(batch, batch_id, out, cut=slicer)
        if batch_id == 1:  # a batch that is run again must change nothing
            carried.dwell_batch(batch, batch_id, out, cut=slicer)

    finish(carried.start_carried(stream, step, str(tmp_path / "ck")))
    loaded = spark.read.parquet(f"{out}/intervals").where(F.col("session_id") != FLUSH_SESSION)
    expected = olap.page_dwell(dwd)
    assert rows_of(olap.merge_max(loaded, olap.DWELL_KEYS, "page_end_time"), *expected.columns) == rows_of(expected)


def test_video_segments(spark, sf, dwd, dwd_files, tmp_path):
    videos = samples.dim_video(spark, sf)
    stream = read_dwd_stream(spark, path=feed(tmp_path / "in", dwd_files), files_per_trigger=1)
    out = str(tmp_path / "out")
    finish(carried.start_carried(
        stream, lambda batch, batch_id: carried.video_batch(batch, videos, batch_id, out), str(tmp_path / "ck")))
    loaded = spark.read.parquet(f"{out}/segments")
    expected = olap.video_segments(dwd, videos)
    assert rows_of(olap.merge_max(loaded, olap.VIDEO_KEYS, "partial_end_time"), *expected.columns) == rows_of(expected)


def test_running_sum_continues(spark, sf, tmp_path):
    lines = samples.lines(spark, sf)
    cut = 1_704_067_200 + 40_000
    for number, part in enumerate((lines.where(F.col("action_time") < cut), lines.where(F.col("action_time") >= cut))):
        carried.running_sum_batch(part, number, str(tmp_path))
    expected = exploration.running_sum(lines)
    assert rows_of(spark.read.parquet(f"{tmp_path}/sums"), *expected.columns) == rows_of(expected)


def test_enrich(spark, sf, dwd, tmp_path):
    """Bad text aside, the detail table and the wide stream hold what the batch job gives."""
    raw = samples.ods(spark, sf).drop("seq").select(F.to_json(F.struct("*")).alias("v"))
    lines = [r.v for r in raw.collect()]
    tables = EnrichTables(**{n: str(tmp_path / n) for n in (
        "users", "geo", "pages", "wide", "detail", "notes", "bad", "checkpoint")}, wait_s=0)
    publish(samples.dim_user(spark, sf), tables.users, 0)
    publish(samples.dim_geo(spark, sf), tables.geo, 0)
    publish(samples.dim_page(spark), tables.pages, 0)
    source = feed(tmp_path / "in", [lines[:400], ["no json", '{"username": 3'] + lines[400:]])
    batches = []
    finish(start_enrich(read_ods_stream(spark, path=source, files_per_trigger=1), tables, after=batches.append))
    expected = detail(dwd)
    got = spark.read.parquet(tables.detail)
    assert rows_of(got, *expected.columns) == rows_of(expected)
    assert {r.value for r in spark.read.parquet(tables.bad).collect()} == {"no json", '{"username": 3'}
    wide = spark.read.text(tables.wide).select(F.from_json("value", DWD_DDL).alias("m")).select("m.*")
    columns = [c for c in WIDE_COLUMNS if c != "properties"]
    assert rows_of(wide, *columns) == rows_of(dwd, *columns)


USERS = "username STRING, f STRUCT<id: BIGINT, phone: STRING, status: INT, create_time: TIMESTAMP_NTZ, " \
        "gender: INT, birthday: DATE, province: STRING, city: STRING, job: STRING, source_type: INT>"


@pytest.fixture()
def widening(spark, tmp_path):
    """Run a batch of (name, time) events; what detail and wide stream hold; make a version of the users."""
    tables = EnrichTables(**{n: str(tmp_path / n) for n in (
        "users", "geo", "pages", "wide", "detail", "notes", "bad", "checkpoint")}, wait_s=0)
    events = f"{ODS_DDL}, _bad_record STRING"

    class Widening:
        def batch(self, number, *names, time=1000):
            rows = [(n, "s", "page_load", time + number, None, None, None, None, {}, None) for n in names]
            enrich_batch(spark, spark.createDataFrame(rows, events), number, tables)

        def held(self):
            detail_rows = sorted(((r.username, r.user_id, r.batch_id) for r in spark.read.parquet(tables.detail).collect()),
                                 key=str)
            wide = spark.read.text(tables.wide).select(F.from_json("value", DWD_DDL).alias("m"), "batch_id")
            assert detail_rows == sorted(((r.m.username, r.m.user_id, r.batch_id) for r in wide.collect()), key=str)
            return detail_rows

        def know(self, version, **users):
            publish(spark.createDataFrame([(n, (i,) + (None,) * 9) for n, i in users.items()], USERS), tables.users, version, keep_ms=3_600_000)

    Widening.tables = tables
    return Widening()


def test_enrich_asks_again_within_the_batch(monkeypatch, widening):
    widening.know(0, early=1)
    arrivals = iter([dict(early=1, second=2), dict(early=9, second=9, third=3), dict(fourth=4)])
    first = True

    def sleep(_):
        nonlocal first
        widening.know(5 if first else 6, **next(arrivals))
        first = False

    monkeypatch.setattr("footfall.streaming.enrich.sleep", sleep)
    widening.batch(0, "early", "second", "third", "fourth", None)
    wanted = [("early", 1, 0), ("fourth", None, 0), ("second", 2, 0), ("third", 3, 0), (None, None, 0)]
    assert widening.held() == sorted(wanted, key=str)
    widening.know(7, early=5, fourth=4)
    widening.batch(0, "early", "second", "third", "fourth", None)
    assert widening.held() == sorted(wanted, key=str)


def test_enrich_waits_once_per_name_and_version(monkeypatch, widening):
    """A name that was given up is waited for again only when there is a newer version of the users."""
    waits = []
    monkeypatch.setattr("footfall.streaming.enrich.sleep", waits.append)
    widening.know(0, a=1)
    widening.batch(0, "a", "b", "c", None)
    assert len(waits) == 2
    widening.batch(1, "a", "b", "b", None)
    widening.batch(2, "c", "b")
    assert len(waits) == 2
    widening.batch(3, "b", "d")
    assert len(waits) == 4, "a name not asked for before"
    widening.know(5, a=1, c=3)
    widening.batch(4, "b", "c", "d")
    assert len(waits) == 6, "a newer version"
    widening.batch(5, "b", "c", "d")
    widening.batch(4, "b", "c", "d")
    widening.batch(0, "a", "b", "c", None)
    assert len(waits) == 6, "repeats do not wait"
    users = {(name, number): user for name, user, number in widening.held()}
    assert users["a", 1] == 1 and users["c", 2] is None and users["c", 4] == users["c", 5] == 3 and users["b", 5] is None
    assert len(widening.held()) == 4 + 4 + 2 + 2 + 3 + 3


def test_open_pages_of_other_sessions_are_left_alone(spark, tmp_path):
    """A batch of ten sessions writes at most ten of the buckets that hold two thousand; all results are as in one batch."""
    ddl = ("user_id long, session_id string, event_id string, event_time long, properties map<string,string>, gps_province "
           "string, gps_city string, gps_region string")
    minute = 60_000
    first = [(k, f"s{k}", "page_load", minute, {"url": f"/{k}"}, None, None, None) for k in range(2000)]
    then = [(k, f"s{k}", "page_load", 5 * minute, {"url": "/next"}, None, None, None) for k in range(10)]
    last = [(k, f"s{k}", "add_cart", 9 * minute, {"url": "/next"}, None, None, None) for k in range(5, 15)]
    last += [(1999, "s1999", "add_cart", 50 * minute, {"url": "/1999"}, None, None, None)]
    frames = [spark.createDataFrame(rows, ddl) for rows in (first, then, last)]
    for number, batch in enumerate(frames):
        carried.dwell_batch(batch, number, str(tmp_path / "out"), ties=())
        carried.dwell_batch(batch, number, str(tmp_path / "out"), ties=())
    buckets = len(list((tmp_path / "out" / "open" / "version=1").glob("bucket=*")))
    assert 0 < buckets <= 10 and len(list((tmp_path / "out" / "open" / "version=0").glob("bucket=*"))) <= 64
    found = olap.merge_max(spark.read.parquet(str(tmp_path / "out" / "intervals")), olap.DWELL_KEYS, "page_end_time")
    whole = frames[0].unionByName(frames[1]).unionByName(frames[2])
    assert rows_of(found, *olap.DWELL_KEYS, "page_end_time") == rows_of(olap.page_dwell(whole), *olap.DWELL_KEYS, "page_end_time")


def test_enrich_without_dimensions(widening):
    widening.batch(0, "a", None)
    assert widening.held() == [("a", None, 0), (None, None, 0)]


def test_enrich_repeat_with_newer_users(widening):
    """Both outputs hold what the versions of the first attempt gave."""
    widening.know(0, a=1)
    widening.batch(0, "a", "b")
    widening.know(1, a=1, b=2)
    widening.batch(0, "a", "b")
    widening.batch(1, "b")
    assert widening.held() == [("a", 1, 0), ("b", 2, 1), ("b", None, 0)]


def test_dimension_sync(spark, sf, tmp_path):
    ddl = "id BIGINT, username STRING, status INT"
    changes = samples.user_changes(spark, sf)
    early = changes.where("seq = 1").toJSON().collect()
    late = changes.where("seq > 1").toJSON().collect()
    source = feed(tmp_path / "in", [early, late[:50], late[50:]])
    stream = read_changes(spark, source, ddl, streaming=True)
    paths = str(tmp_path / "state"), str(tmp_path / "dim")
    finish(start_sync(stream, *paths, str(tmp_path / "ck"), dimensions.user_dim))
    expected = dimensions.user_dim(dimensions.fold_changes(changes))
    assert rows_of(current(spark, paths[1])) == rows_of(expected)


def test_dimension_small_cases(spark, tmp_path):
    ddl = "op STRING, seq BIGINT, id BIGINT, username STRING, status INT"
    paths = str(tmp_path / "state"), str(tmp_path / "dim")

    def sync(number, *rows):
        sync_batch(spark.createDataFrame(rows, ddl), number, *paths, dimensions.user_dim)
        return {r.username: r.f.id for r in current(spark, paths[1]).collect()}

    assert sync(0, ("c", 1, 1, "ann", 0), ("c", 2, 2, "bob", 0), ("c", 3, 3, None, 0)) == {"ann": 1, "bob": 2}
    assert sync(1, ("u", 4, 1, "anna", 0)) == {"anna": 1, "bob": 2}
    assert sync(2, ("d", 6, 2, "bob", 0)) == {"anna": 1}
    assert sync(3, ("u", 5, 2, "bob", 0)) == {"anna": 1}
    assert sync(3, ("u", 5, 2, "bob", 0)) == {"anna": 1}
    assert sync(4, ("c", 7, 4, "anna", 0)) == {"anna": 4}


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    from footfall.sinks.partitions import write_batch
    rows = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "dt STRING, n INT")
    for batch_id in (0, 1, 1):
        write_batch(rows, str(tmp_path / "t"), batch_id)
    table = read_batches(spark, str(tmp_path / "t"), "n INT, dt STRING")
    assert rows_of(table, "dt", "n") == [("2024-01-01", "1")] * 2 + [("2024-01-02", "2")] * 2


def test_repeat_with_fewer_days(spark, tmp_path):
    from footfall.sinks.partitions import write_batch
    rows = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), (None, 3)], "dt STRING, n INT")
    path = str(tmp_path / "t")
    for batch_id, part in ((0, rows), (1, rows), (1, rows.where("n = 1"))):
        write_batch(part, path, batch_id)
    table = read_batches(spark, path, "n INT, dt STRING")
    assert rows_of(table, "n") == [("1",), ("1",), ("2",), ("3",)]
    write_batch(rows.where("false"), path, 1)
    assert rows_of(read_batches(spark, path, "n INT, dt STRING"), "n") == [("1",), ("2",), ("3",)]


def test_replaced_versions_are_kept_for_a_time(spark, tmp_path):
    path = str(tmp_path / "d")
    for version in range(6):
        publish(spark.range(version), path, version, keep_ms=3_600_000)
    held = read_version(spark, path, 0)
    publish(spark.range(9), path, 9, keep_ms=3_600_000)
    assert held.count() == 0
    publish(spark.range(10), path, 10)
    assert read_version(spark, path, newest_version(spark, path, below=10)).count() == 9
    assert newest_version(spark, path, below=9) == 5 and newest_version(spark, path, below=5) is None


@pytest.mark.parametrize("files", [1, 2])
def test_equal_times_in_order_of_arrival(spark, tmp_path, files):
    """Two pages loaded at one time: the first is closed at once, the second by the next load."""
    def load(url, time):
        return json.dumps({"session_id": "s", "event_id": "page_load", "event_time": time, "properties": {"url": url}})

    chunks = [[load("/m", 2000)], [load("/aa", 2000)], [load("/z", 5000)]]
    if files == 1:
        chunks = [chunks[0] + chunks[1], chunks[2]]
    JOBS["page_dwell"](spark, source={"path": feed(tmp_path / "in", chunks), "files_per_trigger": 1},
                       out=str(tmp_path / "out"), checkpoint=str(tmp_path / "ck")).awaitTermination()
    loaded = olap.merge_max(spark.read.parquet(f"{tmp_path}/out/intervals"), olap.DWELL_KEYS, "page_end_time")
    assert {(r.url, r.page_start_time, r.page_end_time) for r in loaded.collect()} == {
        ("/m", 2000, 2000), ("/aa", 2000, 5000), ("/z", 5000, 5000)}


@pytest.mark.parametrize("job", ["page_dwell", "video_segments"])
def test_rows_out_of_order_within_the_delay(spark, sf, dwd, dwd_files, tmp_path, job):
    """Shuffled over many batches within the delay, the jobs give what the batch plans give in time order."""
    rng = random.Random(5)
    lines = [(json.loads(v), v) for chunk in dwd_files[:-1] for v in chunk]
    delay = 3_600_000
    mixed = [v for _, v in sorted(lines, key=lambda x: x[0]["event_time"] + rng.randrange(delay))]
    size = len(mixed) // 6 + 1
    chunks = [mixed[i:i + size] for i in range(0, len(mixed), size)] + [dwd_files[-1]]
    more = {} if job == "page_dwell" else {"videos": str(tmp_path / "videos")}
    publish(samples.dim_video(spark, sf), str(tmp_path / "videos"), 0)
    JOBS[job](spark, source={"path": feed(tmp_path / "in", chunks), "files_per_trigger": 1}, out=str(tmp_path / "out"),
              checkpoint=str(tmp_path / "ck"), delay_ms=delay, **more).awaitTermination()
    assert carried.late_counts(spark, str(tmp_path / "out")).isEmpty()
    if job == "page_dwell":
        expected, keys, end, table = olap.page_dwell(dwd), olap.DWELL_KEYS, "page_end_time", "intervals"
    else:
        expected, keys, end, table = (olap.video_segments(dwd, samples.dim_video(spark, sf)), olap.VIDEO_KEYS,
                                      "partial_end_time", "segments")
    loaded = spark.read.parquet(f"{tmp_path}/out/{table}")
    assert rows_of(olap.merge_max(loaded, keys, end), *expected.columns) == rows_of(expected)


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    def load(session, url, time):
        return json.dumps({"session_id": session, "event_id": "page_load", "event_time": time, "properties": {"url": url}})

    chunks = [[load("a", "/a", 60_500)], [load("b", "/b", 60_400)], [load("b", "/c", 50_000), load("b", "/d", None)],
              [load("a", "/z", 99_000)]]
    JOBS["page_dwell"](spark, source={"path": feed(tmp_path / "in", chunks), "files_per_trigger": 1}, delay_ms=1_000,
                       out=str(tmp_path / "out"), checkpoint=str(tmp_path / "ck")).awaitTermination()
    loaded = spark.read.parquet(f"{tmp_path}/out/intervals")
    assert {(r.session_id, r.url) for r in loaded.collect()} == {("a", "/a"), ("b", "/b")}
    assert {r["batch_id"]: r["rows"] for r in carried.late_counts(spark, f"{tmp_path}/out").collect()} == {2: 2}


def test_no_bad_text_is_lost(spark, tmp_path):
    good = json.dumps({"user_id": 1, "event_time": 5})
    bad = ["no json", "", "7", '{"user_id": "x"}', '{"user_id": 1']
    source = feed(tmp_path / "in", [[good, *bad]])
    assert read_dwd_stream(spark, path=source).isStreaming
    JOBS["bad_events"](spark, source={"path": source}, out=str(tmp_path / "bad"), checkpoint=str(tmp_path / "ck")) \
        .awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == sorted(bad)
    query = read_dwd_stream(spark, path=source).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start(str(tmp_path / "good"))
    finish(query)
    assert [r.user_id for r in spark.read.parquet(str(tmp_path / "good")).collect()] == [1]

    lines = feed(tmp_path / "lines", [["1,a,f,30,100", "1,a,f,x,100", "1,a", ""]])
    JOBS["bad_lines"](spark, source={"path": lines}, out=str(tmp_path / "badl"), checkpoint=str(tmp_path / "ck3")) \
        .awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "badl")).collect()) == ["", "1,a", "1,a,f,x,100"]
    assert [tuple(r)[0] for r in read_lines(spark, lines).collect()] == ["1"]

    changes = feed(tmp_path / "changes", [[json.dumps({"op": "c", "seq": 1, "id": 1, "username": "u"}), *bad]])
    finish(start_sync(read_changes(spark, changes, "id BIGINT, user_id INT, username STRING", streaming=True),
                      str(tmp_path / "state"), str(tmp_path / "dim"), str(tmp_path / "ck4"), dimensions.user_dim))
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "state_bad")).collect()) == sorted(bad)
    assert [r.username for r in current(spark, str(tmp_path / "dim")).collect()] == ["u"]


def test_running_sum_job(spark, sf, tmp_path):
    lines = samples.lines(spark, sf).orderBy("action_time").collect()
    text = [",".join(str(v) for v in r) for r in lines]
    end = [f"x,x,{g},1,{lines[-1].action_time + 1000}" for g in "mf"]
    source = feed(tmp_path / "in", [text[:300], text[300:700], text[700:], end, end])
    JOBS["running_sum_then_window"](spark, source={"path": source}, out=str(tmp_path / "out"),
                                    checkpoint=str(tmp_path / "ck")).awaitTermination()
    expected = exploration.running_sum_then_window(samples.lines(spark, sf))
    got = spark.read.parquet(f"{tmp_path}/out/windows")
    assert rows_of(got, *expected.columns) == rows_of(expected)
    assert "Window" in expected._jdf.queryExecution().executedPlan().toString()


def test_state_is_written_in_proportion_to_the_changes(spark, tmp_path):
    """Ten changes on a large state rewrite at most ten buckets of it; the dimension is as if folded at once."""
    ddl = "op STRING, seq BIGINT, id BIGINT, username STRING, status INT"
    paths = str(tmp_path / "state"), str(tmp_path / "dim")
    first = spark.range(5000).selectExpr("'c' op", "1L seq", "id", "concat('u', id) username", "0 status")
    second = spark.range(10).selectExpr("if(id = 3, 'd', 'u') op", "2L seq", "id * 7 AS id", "concat('v', id) username", "1 status")
    second = spark.createDataFrame(second.collect(), ddl)
    for number, batch in enumerate((spark.createDataFrame(first.collect(), ddl), second)):
        sync_batch(batch, number, *paths, dimensions.user_dim)
    sync_batch(second, 1, *paths, dimensions.user_dim)
    expected = dimensions.user_dim(dimensions.fold_changes(first.unionByName(second)))
    assert rows_of(current(spark, paths[1])) == rows_of(expected)
    written = spark.read.parquet(f"{paths[0]}/version=1").where("not __mark").count()
    assert len(os.listdir(tmp_path / "state/version=1")) < 15 and written < 1000


def test_a_bucket_may_become_empty(spark, tmp_path):
    schema = spark.createDataFrame([], "k STRING, n INT").schema
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([("a", 1)], schema)
    touched = buckets_of(rows, "k")
    write_buckets(rows, path, "k", 0, touched)
    write_buckets(rows.where("false"), path, "k", 1, touched)
    assert read_buckets(spark, path, schema, 1).count() == 1 and read_buckets(spark, path, schema, 2).count() == 0
    for version in range(2, 7):
        write_buckets(rows, path, "k", version, touched)
    assert read_buckets(spark, path, schema, 3).count() == 0 and read_buckets(spark, path, schema, 9, touched).count() == 1
