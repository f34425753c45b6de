"""The jobs by name: ``spark-submit footfall/jobs.py <job> <settings.json>``.

Settings common to streams: ``source`` (``{"path": ...}`` or ``{"kafka": {...}}``), ``checkpoint``, ``out`` and, as
wanted, ``trigger`` (``{"processingTime": "5 seconds"}``; default: all that is there, then stop) and ``delay``: how far
rows may lag behind the newest event time, as ``"10 seconds"`` for jobs over windows and as ``delay_ms`` for those that
carry state. Further settings are the arguments of the functions below.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from footfall.plans import dashboards, dimensions, olap  # noqa: E402
from footfall.plans.traffic_states import compact_states, store_load, sweep_states  # noqa: E402
from footfall.session import build_session  # noqa: E402
from footfall.sinks.partitions import RETENTION_DAYS, compact_day, drop_days_before  # noqa: E402
from footfall.sinks.snapshots import current, publish  # noqa: E402
from footfall.sources.events import bad_records, parse_dwd_stream, read_dwd_stream, read_ods_stream  # noqa: E402
from footfall.sources.tables import (  # noqa: E402
    USER_DDL, VIDEO_DDL, parse_lines, read_changes, read_lines, read_table)
from footfall.streaming import carried, cumulative, windows  # noqa: E402
from footfall.streaming.dimensions import start_sync  # noqa: E402
from footfall.streaming.enrich import EnrichTables, start_enrich  # noqa: E402


def widen_events(spark: SparkSession, source: dict, trigger: dict | None = None, **tables) -> StreamingQuery:
    """Raw events -> wide stream and detail table; ``tables`` are the fields of ``EnrichTables``."""
    return start_enrich(read_ods_stream(spark, **source), EnrichTables(**tables), trigger)


def _sync(spark, source, state, out, checkpoint, trigger, ddl: str, build: Callable[[DataFrame], DataFrame]):
    return start_sync(read_changes(spark, source["path"], ddl, streaming=True), state, out, checkpoint, build, trigger)


def sync_user_dim(spark, source: dict, state: str, out: str, checkpoint: str, trigger: dict | None = None):
    return _sync(spark, source, state, out, checkpoint, trigger, USER_DDL, dimensions.user_dim)


def sync_video_dim(spark, source: dict, state: str, out: str, checkpoint: str, trigger: dict | None = None):
    return _sync(spark, source, state, out, checkpoint, trigger, VIDEO_DDL, dimensions.video_dim)


def build_geo_dim(spark, source: dict, out: str, version: int = 0) -> None:
    """Area table (``{"path": ...}`` or ``{"jdbc": {...}}``) -> geohash dimension."""
    publish(dimensions.keyed_geo_dim(read_table(spark, **source)), out, version)


def bad_events(spark, source: dict, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Texts of a widened stream that cannot be parsed, by batch, so that they can be counted and repaired."""
    return windows.start_table(bad_records(parse_dwd_stream(spark, **source)), out, checkpoint, trigger=trigger)


def bad_lines(spark, source: dict, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    lines = parse_lines(spark.readStream.text(source["path"]))
    return windows.start_table(bad_records(lines), out, checkpoint, trigger=trigger)


def traffic_5m(spark, source: dict, out: str, checkpoint: str, trigger: dict | None = None,
               delay: str = "0 seconds") -> StreamingQuery:
    dwd = read_dwd_stream(spark, ["user_id", "session_id", "event_id", "event_time"], **source)
    return windows.start_table(windows.traffic_5m(dwd, delay), out, checkpoint, trigger=trigger)


def traffic_today(spark, source: dict, out: str, checkpoint: str, trigger: dict | None = None,
                  delay: str = "0 seconds") -> StreamingQuery:
    """Dashboard rows of each closed step under ``out/dashboard``."""
    dwd = read_dwd_stream(spark, ["user_id", "session_id", "event_id", "event_time"], **source)
    job, steps = cumulative.traffic_today(dwd, out, delay)
    return job.start(steps, checkpoint, trigger)


def promotion_today(spark, source: dict, out: str, checkpoint: str, trigger: dict | None = None,
                    delay: str = "0 seconds") -> StreamingQuery:
    """Dashboard rows of each closed step, promotion page and province under ``out/dashboard``."""
    dwd = read_dwd_stream(spark, ["user_id", "event_id", "event_time", "properties", "register_time",
                                  "register_province"], **source)
    job, steps = cumulative.promotion_today(dwd, out, delay)
    return job.start(steps, checkpoint, trigger)


def top_pages(spark, source: dict, out: list[str], checkpoint: str, n: int = dashboards.TOP_PAGES,
              trigger: dict | None = None, delay: str = "0 seconds") -> StreamingQuery:
    """The same ranking in every table of ``out``."""
    dwd = read_dwd_stream(spark, ["user_id", "event_time", "properties", "page_type"], **source)
    return windows.start_ranking(windows.page_uv_5m(dwd, delay), out, checkpoint, n, trigger)


AREA_COLUMNS = ["gps_province", "gps_city", "gps_region"]
TRAFFIC_COLUMNS = ["event_time", *AREA_COLUMNS, "device_type", "release_channel", "properties", "page_type",
                   "page_service", "register_time", "user_id", "session_id"]
PAGE_COLUMNS = ["user_id", "session_id", "event_id", "event_time", "properties", *AREA_COLUMNS]


def traffic_olap(spark, source: dict, out: str, checkpoint: str, trigger: dict | None = None,
                 delay: str = "0 seconds") -> StreamingQuery:
    rows = windows.traffic_olap(read_dwd_stream(spark, TRAFFIC_COLUMNS, **source), delay)
    return windows.start_table(rows, out, checkpoint, "dt", trigger)


def traffic_states(spark, source: dict, out: str, checkpoint: str, trigger: dict | None = None,
                   delay: str = "0 seconds") -> StreamingQuery:
    """Closed minutes under ``out/minute`` and states at every stored grain beside it, one load per batch."""
    rows = windows.traffic_olap(read_dwd_stream(spark, TRAFFIC_COLUMNS, **source), delay)
    return windows.start_batches(rows, lambda batch, number: store_load(batch, number, out), checkpoint, trigger)


def page_dwell(spark, source: dict, out: str, checkpoint: str, trigger: dict | None = None,
               delay_ms: int = 0) -> StreamingQuery:
    """Intervals under ``out/intervals``, rows that came too late under ``out/late``."""
    return carried.start_carried(
        read_dwd_stream(spark, PAGE_COLUMNS, **source),
        lambda batch, number: carried.dwell_batch(batch, number, out, delay_ms=delay_ms), checkpoint, trigger)


def video_segments(spark, source: dict, videos: str, out: str, checkpoint: str, idle_ms: int | None = None,
                   trigger: dict | None = None, delay_ms: int = 0) -> StreamingQuery:
    """``videos``: path of the video snapshots, read anew by every batch; until there is one, no video is known."""

    def step(batch: DataFrame, number: int) -> None:
        known = current(spark, videos)
        if known is None:
            known = spark.createDataFrame([], olap.VIDEO_DIM_DDL)
        carried.video_batch(batch, known, number, out, idle_ms, delay_ms=delay_ms)

    return carried.start_carried(read_dwd_stream(spark, PAGE_COLUMNS, **source), step, checkpoint, trigger)


def running_sum_then_window(spark, source: dict, out: str, checkpoint: str, trigger: dict | None = None,
                            delay_s: int = 10) -> StreamingQuery:
    """Lines with running sums under ``out/sums``, closed windows over them under ``out/windows``."""
    lines = read_lines(spark, source["path"], streaming=True)
    return carried.start_carried(
        lines, lambda batch, number: carried.running_sum_windows_batch(batch, number, out, delay_s), checkpoint, trigger)


def top_pages_per_window(spark, source: dict, out: str, checkpoint: str, n: int = dashboards.TOP_PAGES,
                         trigger: dict | None = None, delay: str = "0 seconds") -> StreamingQuery:
    dwd = read_dwd_stream(spark, ["user_id", "event_time", "properties", "page_type"], **source)
    return windows.start_ranking_per_window(windows.page_uv_5m(dwd, delay), out, checkpoint, n, trigger)


# How rows of one key merge when a day is compacted.
MERGES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "traffic": olap.traffic_merge,
    "dwell": lambda rows: olap.merge_max(rows, olap.DWELL_KEYS, "page_end_time"),
    "video": lambda rows: olap.merge_max(rows, olap.VIDEO_KEYS, "partial_end_time"),
}


def compact(spark, table: str, path: str, day: str, out: str) -> None:
    """Merge the loads of one closed day of a traffic, dwell or video table; ``none`` names the rows without a day."""
    compact_day(spark, path, None if day == "none" else day, MERGES[table], out)


def compact_traffic_states(spark, path: str, day: str, upto: int | None = None, keep_ms: int | None = None) -> None:
    """Merge the loads of a day at every grain in place; ``keep_ms`` deletes what was merged longer ago than that."""
    compact_states(spark, path, None if day == "none" else day, upto)
    if keep_ms is not None:
        sweep_states(spark, path, keep_ms)


def retire(spark, table: str, path: str, today: str) -> None:
    """Drop the days of a table that are past its retention, and rows without a day that were loaded before it."""
    first = date.fromisoformat(today) - timedelta(days=RETENTION_DAYS[table])
    drop_days_before(spark, path, first.isoformat())


JOBS = {f.__name__: f for f in (
    widen_events, bad_events, bad_lines, sync_user_dim, sync_video_dim, build_geo_dim, traffic_5m, traffic_today, promotion_today, top_pages,
    top_pages_per_window, traffic_olap, traffic_states, page_dwell, video_segments, running_sum_then_window, compact,
    compact_traffic_states, retire)}


def main(argv: list[str]) -> None:
    job, path = argv
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    query = JOBS[job](build_session(f"footfall {job}"), **settings)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
