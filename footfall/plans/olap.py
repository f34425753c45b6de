"""Pre-aggregated tables for analysts: traffic, page dwell, video play."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import as_long, day_of, page_url, time_slice
from footfall.functions.clock import MINUTE_MS, floor_to
from footfall.operators.distinct_state import build_state, read_state
from footfall.operators.dwell import page_visits
from footfall.operators.lookup import lookup
from footfall.operators.segments import mark_segments
from footfall.operators.slices import Slicer
from footfall.plans.widen import widen

TIME_GRAINS = {"time_trunk_1m": 1, "time_trunk_5m": 5, "time_trunk_10m": 10, "time_trunk_30m": 30,
               "time_trunk_1h": 60}
TRAFFIC_DIMENSIONS = ["province", "city", "region", "device_type", "release_channel", "page_url", "page_type",
                      "page_service", "is_new"]
TRAFFIC_KEYS = ["dt", *TIME_GRAINS, *TRAFFIC_DIMENSIONS]

# The events that make up a play.
PLAY_EVENTS = ["video_play", "video_hb", "video_pause", "video_resume", "video_stop"]
AREA = {"province": "gps_province", "city": "gps_city", "region": "gps_region"}


def area_columns() -> list[Column]:
    return [F.col(source).alias(name) for name, source in AREA.items()]


def time_keys(ms: Column) -> list[Column]:
    """Local day and the five slice texts."""
    return [day_of(ms).alias("dt"), *[time_slice(ms, minutes).alias(name) for name, minutes in TIME_GRAINS.items()]]


def traffic_rows(dwd: DataFrame) -> DataFrame:
    """Events with the analysts' dimensions; a user is new on the day of registration only."""
    registered_today = F.col("register_time").cast("date") == day_of(F.col("event_time"))
    return dwd.where(F.col("event_time").isNotNull()).select(
        "event_time", *area_columns(), "device_type", "release_channel",
        page_url(F.col("properties")["url"]).alias("page_url"), "page_type", "page_service",
        F.when(registered_today, 1).otherwise(0).alias("is_new"), "user_id", "session_id")


def traffic_olap(dwd: DataFrame) -> DataFrame:
    """Events per minute, dimensions, user and session: the loaded rows of the aggregate table.

    Keeping user and session as key columns is the exact, compact form at this grain; roll-ups turn them into
    bitmaps and sketches.
    """
    minute = traffic_rows(dwd).groupBy(
        floor_to(F.col("event_time"), MINUTE_MS).alias("minute_ms"), *TRAFFIC_DIMENSIONS, "user_id", "session_id",
    ).agg(F.sum(F.lit(1).cast("long")).alias("pv"))
    return minute.select(*time_keys(F.col("minute_ms")), *TRAFFIC_DIMENSIONS, "pv", "user_id", "session_id")


def traffic_merge(loaded: DataFrame) -> DataFrame:
    """Rows that share all keys merged into one, as the aggregate table does on load."""
    return loaded.groupBy(*TRAFFIC_KEYS, "user_id", "session_id").agg(F.sum("pv").alias("pv"))


def traffic_rollup(loaded: DataFrame, dims: Sequence[str]) -> DataFrame:
    """``pv``, ``uv`` and ``session_cnt`` at any subset of the key columns, exact, from the loaded rows."""
    return loaded.groupBy(*dims).agg(
        F.sum("pv").alias("pv"), F.count_distinct("user_id").alias("uv"),
        F.count_distinct("session_id").alias("session_cnt"))


def traffic_state(loaded: DataFrame, dims: Sequence[str]) -> DataFrame:
    """A stored roll-up that merges with others: user bitmaps and session sketches.

    For grains coarser than the minute rows; ``plans.traffic_states`` stores the ones in use and reads the cheapest.
    """
    return build_state(loaded, dims)


def read_traffic_state(states: DataFrame, dims: Sequence[str]) -> DataFrame:
    """``pv``, exact ``uv`` and estimated ``session_cnt`` of stored roll-ups at their grain or a coarser one."""
    return read_state(states, dims)


DWELL_KEYS = ["dt", "user_id", "session_id", "province", "city", "region", "url", "page_start_time"]


def dwell_intervals(visits: DataFrame) -> DataFrame:
    """One row per page visit from marked events; events without a url have done their work by now."""
    merged = visits.where(F.col("url").isNotNull()).groupBy(
        "user_id", "session_id", *AREA, "url", F.col("page_load_time").alias("page_start_time"),
    ).agg(F.max("event_time").alias("page_end_time"))
    return merged.withColumn("dt", day_of(F.col("page_start_time"))).select(*DWELL_KEYS, "page_end_time")


def page_rows(dwd: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    return dwd.select("session_id", "event_id", "event_time", *ties, "user_id", *area_columns(),
                      F.col("properties")["url"].alias("url"))


PAGE_COLUMNS = ["user_id", *AREA, "url"]


def page_dwell(dwd: DataFrame, ties: Sequence[str] = (), cut: Slicer | None = None) -> DataFrame:
    """Start and end of every page visit."""
    return dwell_intervals(page_visits(page_rows(dwd, ties), PAGE_COLUMNS, ties, cut=cut))


# What a raw event's user and area are looked up by.
RAW_KEYS = ["username", "lat", "lng"]


def _looked_up(rows: DataFrame, users: DataFrame, geo: DataFrame, keep: Sequence[str]) -> DataFrame:
    wide = widen(rows, users, geo, keep=keep)
    return wide.select("user_id", "session_id", "event_time", *area_columns(), *keep)


def page_dwell_of_raw(events: DataFrame, users: DataFrame, geo: DataFrame, ties: Sequence[str] = (),
                      cut: Slicer | None = None) -> DataFrame:
    """``page_dwell`` of raw events: visits are found on the narrow rows, and looked up once afterwards."""
    rows = events.select("session_id", "event_id", F.col("action_time").alias("event_time"), *ties, *RAW_KEYS,
                         F.col("properties")["url"].alias("url"))
    visits = page_visits(rows, [*RAW_KEYS, "url"], ties, cut=cut)
    return dwell_intervals(_looked_up(visits, users, geo, ["url", "page_load_time"]))


def page_dwell_per_page(intervals: DataFrame) -> DataFrame:
    """Visits and time spent per day and page."""
    opened = intervals.where(F.col("page_start_time").isNotNull())
    return opened.groupBy("dt", page_url(F.col("url")).alias("page_url")).agg(
        F.count(F.lit(1)).alias("visits"),
        F.sum(F.col("page_end_time") - F.col("page_start_time")).alias("dwell_ms"))


def merge_max(loaded: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Merge on load of an interval table: the greatest end per key."""
    return loaded.groupBy(*keys).agg(F.max(measure).alias(measure))


VIDEO_DIM_DDL = ("id BIGINT, f STRUCT<video_name: STRING, video_type: STRING, video_album: STRING, video_author: STRING, "
                 "video_timelong: BIGINT>")
VIDEO_FIELDS = {"video_title": "f.video_name", "video_type": "f.video_type", "video_album": "f.video_album",
                "video_author": "f.video_author", "video_time_amt": "f.video_timelong"}
VIDEO_KEYS = ["dt", "user_id", "session_id", "province", "city", "region", "video_id", *VIDEO_FIELDS, "play_id",
              "part_no", "partial_start_time"]


def play_rows(dwd: DataFrame) -> DataFrame:
    """Play events; a video id that is no number becomes NULL."""
    return dwd.where(F.col("event_id").isin(*PLAY_EVENTS)).select(
        "user_id", "session_id", "event_id", "event_time", *area_columns(),
        as_long(F.col("properties")["video_id"]).alias("video_id"), F.col("properties")["play_id"].alias("play_id"))


def merge_segments(marked: DataFrame) -> DataFrame:
    return marked.groupBy(
        "user_id", "session_id", *AREA, "video_id", "play_id", "part_no",
        F.col("part_start_time").alias("partial_start_time"),
    ).agg(F.max("event_time").alias("partial_end_time"))


def name_videos(segments: DataFrame, videos: DataFrame) -> DataFrame:
    named = lookup(segments, videos, F.col("video_id").cast("string"), F.col("id").cast("string"), VIDEO_FIELDS,
                   ("play_id", "part_no", "session_id"))
    return named.withColumn("dt", day_of(F.col("partial_start_time"))).select(*VIDEO_KEYS, "partial_end_time")


def video_segments_of_raw(events: DataFrame, users: DataFrame, geo: DataFrame, videos: DataFrame,
                          cut: Slicer | None = None) -> DataFrame:
    """``video_segments`` of raw events: parts are marked on the narrow rows, and looked up once afterwards."""
    plays = events.where(F.col("event_id").isin(*PLAY_EVENTS)).select(
        "session_id", "event_id", F.col("action_time").alias("event_time"), *RAW_KEYS,
        as_long(F.col("properties")["video_id"]).alias("video_id"), F.col("properties")["play_id"].alias("play_id"))
    marked = mark_segments(plays, cut)
    wide = _looked_up(marked, users, geo, ["video_id", "play_id", "part_no", "part_start_time"])
    return name_videos(merge_segments(wide), videos)


def video_segments(dwd: DataFrame, videos: DataFrame, cut: Slicer | None = None) -> DataFrame:
    """Start and end of every played part, with the video's data."""
    return name_videos(merge_segments(mark_segments(play_rows(dwd), cut)), videos)
