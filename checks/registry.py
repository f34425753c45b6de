"""Every job and operator as a query over the test tables.

Windows come out as text and no result holds maps, binaries or zone-dependent columns, so results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.streamed import STREAMED
from footfall import samples
from footfall.functions import (as_long, day_of, geohash5, map_to_json, page_url, slice_index, time_slice, url_prefix,
                                wall_clock)
from footfall.functions.clock import millis
from footfall.operators.distinct_state import build_state, merge_state, read_state
from footfall.operators.dwell import page_visits
from footfall.operators.latest import live_rows
from footfall.operators.segments import mark_segments
from footfall.operators.slices import Slicer, running, slice_hot_keys
from footfall.plans import dashboards, dimensions, exploration, olap, traffic_states
from footfall.plans.widen import detail, lookup_misses
from footfall.sinks.partitions import partition_days, retained, scratch_path
from footfall.sources.events import ODS_DDL, good_records, parse_messages
from footfall.sources.tables import parse_changes, parse_lines

Query = Callable[[SparkSession, str], DataFrame]


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _windows(df: DataFrame) -> DataFrame:
    return _text(df, "window_start", "window_end")


# Jobs ---------------------------------------------------------------------------------------------------------------

def traffic_5m(spark, sf_dir):
    return _windows(dashboards.traffic_5m(samples.dwd(spark, sf_dir, users=True)))


def traffic_today(spark, sf_dir):
    return _windows(dashboards.traffic_today(samples.dwd(spark, sf_dir, users=True)))


def promotion_today(spark, sf_dir):
    return _windows(dashboards.promotion_today(samples.dwd(spark, sf_dir, users=True)))


def top_pages_overall(spark, sf_dir):
    return _windows(dashboards.top_pages_overall(samples.dwd(spark, sf_dir, users=True, pages=True)))


def top_pages_per_window(spark, sf_dir):
    return _windows(dashboards.top_pages_per_window(samples.dwd(spark, sf_dir, users=True, pages=True)))


def dwd_detail(spark, sf_dir):
    return _text(detail(samples.dwd(spark, sf_dir, users=True, geo=True, pages=True)), "register_time")


def lookup_miss_counts(spark, sf_dir):
    return lookup_misses(samples.dwd(spark, sf_dir, users=True, geo=True, pages=True))


def user_dim(spark, sf_dir):
    return dimensions.flatten(dimensions.user_dim(dimensions.fold_changes(samples.user_changes(spark, sf_dir))))


def video_dim(spark, sf_dir):
    return dimensions.flatten(dimensions.video_dim(dimensions.fold_changes(samples.video_changes(spark, sf_dir))))


def geo_dim(spark, sf_dir):
    return dimensions.geo_dim(samples.areas(spark, sf_dir))


def traffic_olap_1m(spark, sf_dir):
    return olap.traffic_olap(samples.dwd(spark, sf_dir, users=True, geo=True, pages=True))


def _rollup(spark: SparkSession, sf_dir: str, dims: list[str]) -> DataFrame:
    dwd = samples.dwd(spark, sf_dir, users=True, geo=True, pages=True)
    return olap.traffic_rollup(olap.traffic_olap(dwd), dims)


def traffic_rollup_province_1h(spark, sf_dir):
    return _rollup(spark, sf_dir, ["dt", "time_trunk_1h", "province"])


def traffic_rollup_page_30m(spark, sf_dir):
    return _rollup(spark, sf_dir, ["dt", "time_trunk_30m", "page_type", "page_url"])


def traffic_rollup_terminal_10m(spark, sf_dir):
    return _rollup(spark, sf_dir, ["dt", "time_trunk_10m", "device_type", "release_channel"])


def traffic_rollup_new_5m(spark, sf_dir):
    return _rollup(spark, sf_dir, ["dt", "time_trunk_5m", "is_new"])


def traffic_rollup_day(spark, sf_dir):
    return _rollup(spark, sf_dir, ["dt"])


def _device_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored roll-ups per day and device: bitmaps of users, sketches of sessions."""
    dwd = samples.dwd(spark, sf_dir, users=True, geo=True, pages=True)
    return olap.traffic_state(olap.traffic_olap(dwd), ["dt", "device_type"])


def bitmap_users_day(spark, sf_dir):
    """Events and exact users per day, from the bitmaps stored per device."""
    return olap.read_traffic_state(_device_states(spark, sf_dir), ["dt"]).select("dt", "pv", "uv")


def sessions_hll_day(spark, sf_dir):
    """Exact sessions per day, and whether the merged sketches' estimate is within five percent of them."""
    estimate = olap.read_traffic_state(_device_states(spark, sf_dir), ["dt"]).select("dt", "session_cnt")
    exact = samples.ods(spark, sf_dir).groupBy(day_of(F.col("action_time")).alias("dt")) \
        .agg(F.count_distinct("session_id").alias("sessions"))
    return exact.join(estimate, "dt").select(
        "dt", "sessions",
        (F.abs(F.col("session_cnt") - F.col("sessions")) <= F.col("sessions") * 0.05).alias("within_5_percent"))


def _by_session(spark: SparkSession, sf_dir: str) -> Slicer:
    """Hot sessions, counted on the raw events: the lookups do not change a session's rows."""
    raw = samples.ods(spark, sf_dir).select("session_id", F.col("action_time").alias("event_time"))
    return slice_hot_keys("session_id", "event_time", raw)


def _by_play(spark: SparkSession, sf_dir: str) -> Slicer:
    plays = samples.ods(spark, sf_dir).where(F.col("event_id").isin(*olap.PLAY_EVENTS)).select(
        F.col("properties")["play_id"].alias("play_id"), F.col("action_time").alias("event_time"))
    return slice_hot_keys("play_id", "event_time", plays)


def page_dwell(spark, sf_dir):
    return olap.page_dwell_of_raw(samples.ods(spark, sf_dir), samples.dim_user(spark, sf_dir),
                                  samples.dim_geo(spark, sf_dir), ["seq"], _by_session(spark, sf_dir))


def page_dwell_per_page(spark, sf_dir):
    return olap.page_dwell_per_page(page_dwell(spark, sf_dir))


def video_segments(spark, sf_dir):
    return olap.video_segments_of_raw(samples.ods(spark, sf_dir), samples.dim_user(spark, sf_dir),
                                      samples.dim_geo(spark, sf_dir), samples.dim_video(spark, sf_dir),
                                      _by_play(spark, sf_dir))


def running_sum_then_window(spark, sf_dir):
    return _windows(exploration.running_sum_then_window(samples.lines(spark, sf_dir)))


def retained_partitions(spark, sf_dir):
    """Detail rows per day that a retention of one day keeps, as of the newest day."""
    days = samples.ods(spark, sf_dir).select(day_of(F.col("action_time")).alias("dt"))
    return retained(days, days.agg(F.max("dt").alias("d")).scalar(), 1).groupBy("dt") \
        .agg(F.count(F.lit(1)).alias("events"))


# Operators ----------------------------------------------------------------------------------------------------------

def event_rows(spark, sf_dir):
    """Typed columns out of JSON messages of the raw events (schema applied, map access)."""
    raw = samples.ods(spark, sf_dir)
    messages = raw.select("seq", F.to_json(F.struct(*[c for c in raw.columns if c != "seq"])).alias("value"))
    parsed = good_records(parse_messages(messages, ODS_DDL))
    return parsed.select(*[c for c in raw.columns if c not in ("seq", "properties")],
                         F.col("properties")["url"].alias("url"))


def _as_text(rows: DataFrame) -> DataFrame:
    """JSON messages of the rows, and as many broken ones."""
    good = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    return good.unionByName(good.select(F.concat(F.lit("x"), F.col("value")).alias("value")))


def change_rows(spark, sf_dir):
    """User changes out of JSON texts, the broken ones kept aside."""
    ddl = "id BIGINT, username STRING, status INT"
    return good_records(parse_changes(_as_text(samples.user_changes(spark, sf_dir)), ddl))


def line_rows(spark, sf_dir):
    """Person lines out of delimited texts, the broken ones kept aside."""
    lines = samples.lines(spark, sf_dir)
    good = lines.select(F.concat_ws(",", *lines.columns).alias("value"))
    broken = good.select(F.concat(F.col("value"), F.lit("x")).alias("value"))
    return good_records(parse_lines(good.unionByName(broken))).select("user_id", "gender", "age", "action_time")


def event_clock(spark, sf_dir):
    """Each event's timestamp."""
    return samples.ods(spark, sf_dir).select(
        "seq", F.date_format(millis(F.col("action_time")), "yyyy-MM-dd HH:mm:ss.SSS").alias("event_clock"))


def merged_ranking(spark, sf_dir):
    """The ranking of the first half of the windows, merged with the other windows as a stream's next batch is."""
    uv = dashboards.page_uv_5m(samples.dwd(spark, sf_dir, users=True, pages=True))
    second = F.minute("window_start") % 10 >= 5
    best = dashboards.rank_overall(uv.where(~second), dashboards.TOP_PAGES)
    return _windows(dashboards.rank_overall(uv.where(second).unionByName(best), dashboards.TOP_PAGES))


def geohash_cells(spark, sf_dir):
    """Geohash, and its reverse, of every located event's position, with the events there."""
    return samples.ods(spark, sf_dir).groupBy("lat", "lng").agg(F.count(F.lit(1)).alias("events")).select(
        "lat", "lng", geohash5("lat", "lng").alias("geohash"),
        F.reverse(geohash5("lat", "lng")).alias("reversed"), "events")


def time_slices(spark, sf_dir):
    """Every slice text, the local day and the step of the day of each event."""
    ms = F.col("action_time")
    return samples.ods(spark, sf_dir).select(
        "seq", *olap.time_keys(ms), slice_index(ms, 5 * 60_000).alias("step"),
        wall_clock(ms).cast("date").alias("wall_date"))


def url_parts(spark, sf_dir):
    """Page url and url prefix per url, with the events of it."""
    url = F.col("properties")["url"]
    return samples.ods(spark, sf_dir).groupBy(url.alias("url")).agg(F.count(F.lit(1)).alias("events")).select(
        "url", page_url(F.col("url")).alias("page_url"), url_prefix(F.col("url")).alias("url_prefix"), "events")


def properties_json(spark, sf_dir):
    """JSON text of each event's properties and the numeric video id."""
    return samples.ods(spark, sf_dir).select(
        "seq", map_to_json(F.col("properties")).alias("properties"),
        as_long(F.col("properties")["video_id"]).alias("video_id"))


def user_lookup(spark, sf_dir):
    """Events per looked-up user and registration attributes."""
    return samples.dwd(spark, sf_dir, users=True).groupBy(
        "user_id", "register_province", "register_job", "user_status").agg(F.count(F.lit(1)).alias("events"))


def area_lookup(spark, sf_dir):
    """Events per looked-up area."""
    return samples.dwd(spark, sf_dir, geo=True).groupBy("gps_province", "gps_city", "gps_region") \
        .agg(F.count(F.lit(1)).alias("events"))


def page_lookup(spark, sf_dir):
    """Events per looked-up page type and service."""
    return samples.dwd(spark, sf_dir, pages=True).groupBy("page_type", "page_service") \
        .agg(F.count(F.lit(1)).alias("events"))


def area_hierarchy(spark, sf_dir):
    """Distinct cells with their province, city and region, before one row per cell is chosen."""
    return dimensions.area_cells(samples.areas(spark, sf_dir)).distinct()


def latest_user_changes(spark, sf_dir):
    """Newest change per user id that is no delete."""
    return live_rows(dimensions.fold_changes(samples.user_changes(spark, sf_dir)))


def promotion_loads(spark, sf_dir):
    """Promotion page loads: label, user and new user."""
    return _grouped(dashboards.promotion_events(samples.dwd(spark, sf_dir, users=True)),
                    ["promotion_page_name", "user_id", "new_user_id"])


def _grouped(df: DataFrame, by: list[str | Column]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("events"))


def page_uv_5m(spark, sf_dir):
    return _windows(dashboards.page_uv_5m(samples.dwd(spark, sf_dir, users=True, pages=True)))


def marked_visits(spark, sf_dir):
    """Events and closing rows with the load time of the page they belong to."""
    rows = samples.ods(spark, sf_dir).select(
        "session_id", "event_id", F.col("action_time").alias("event_time"), "seq",
        F.col("properties")["url"].alias("url"))
    return _grouped(page_visits(rows, ["url"], ["seq"]), ["session_id", "url", "page_load_time", "event_time"])


def play_parts(spark, sf_dir):
    """Part number and part start of every play event."""
    plays = samples.ods(spark, sf_dir).where(F.col("event_id").isin(*olap.PLAY_EVENTS)).select(
        "seq", F.col("properties")["play_id"].alias("play_id"), "event_id", F.col("action_time").alias("event_time"))
    return mark_segments(plays).select("seq", "play_id", "part_no", "part_start_time")


def running_sum_by_gender(spark, sf_dir):
    return exploration.running_sum(samples.lines(spark, sf_dir)).select(
        "user_id", "gender", "age", "action_time", "sum_age")


def running_loads_by_session(spark, sf_dir):
    """Page loads of the session so far at each event, with every session above 20 rows cut into slices of 20 to 40."""
    rows = samples.ods(spark, sf_dir).select("seq", "session_id", "event_id", "action_time")
    loads = F.when(F.col("event_id") == "page_load", 1).otherwise(0).cast("long")
    return running(rows, "session_id", "action_time", {"loads": ("sum", loads)},
                   slice_hot_keys("session_id", "action_time", min_rows=20))


def merged_bitmap_users(spark, sf_dir):
    """Users per day and channel: two loads of each state merged by key, as after a compaction."""
    rows = samples.dwd(spark, sf_dir, users=True).select(
        day_of(F.col("event_time")).alias("dt"), "release_channel", "user_id", "session_id", "seq",
        F.lit(1).cast("long").alias("pv"))
    keys = ["dt", "release_channel"]
    loads = build_state(rows.where("seq % 2 = 0"), keys).unionByName(build_state(rows.where("seq % 2 = 1"), keys))
    return read_state(merge_state(loads, keys), keys).select(*keys, "pv", "uv")


def sparse_users_day(spark, sf_dir):
    """Users per day and channel where ids lie 100,000 apart: listed ids, in two loads that are merged."""
    rows = samples.dwd(spark, sf_dir, users=True).select(
        day_of(F.col("event_time")).alias("dt"), "release_channel", (F.col("user_id") * 100_000).alias("user_id"),
        "session_id", "seq", F.lit(1).cast("long").alias("pv"))
    keys = ["dt", "release_channel"]
    loads = build_state(rows.where("seq % 2 = 0"), keys).unionByName(build_state(rows.where("seq % 2 = 1"), keys))
    return read_state(merge_state(loads, keys), ["dt"]).select("dt", "pv", "uv")


STORED_ROLLUPS = {
    "province_1h": ["dt", "time_trunk_1h", "province"], "page_30m": ["dt", "time_trunk_30m", "page_type", "page_url"],
    "terminal_10m": ["dt", "time_trunk_10m", "device_type", "release_channel"], "new_5m": ["dt", "time_trunk_5m", "is_new"],
    "day": ["dt"], "region_new": ["region", "is_new"]}


def stored_rollups(spark, sf_dir):
    """Roll-ups read from stored states: two loads, every day compacted, then a third load."""
    source, path = scratch_path(spark, "traffic_loads"), scratch_path(spark, "traffic_states")
    part = F.coalesce(F.pmod(F.xxhash64("session_id"), F.lit(3)), F.lit(0)).cast("int")
    rows = olap.traffic_olap(samples.dwd(spark, sf_dir, users=True, geo=True, pages=True)).withColumn("part", part)
    # The loads are made once, so that each reads its own rows instead of deriving them anew.
    rows.write.partitionBy("part").parquet(source)
    loaded = spark.read.schema(rows.schema).parquet(source)

    def load(number):
        traffic_states.store_load(loaded.where(F.col("part") == number).drop("part"), number, path)

    for number in (0, 1):
        load(number)
    for day in partition_days(spark, f"{path}/day"):
        traffic_states.compact_states(spark, path, day, upto=1)
    load(2)
    out = []
    for name, dims in STORED_ROLLUPS.items():
        key = F.concat_ws("|", *[F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dims])
        out.append(traffic_states.rollup(spark, path, dims).select(F.lit(name).alias("rollup"), key.alias("key"), "pv", "uv"))
    return reduce(DataFrame.unionByName, out)


def merged_dwell_loads(spark, sf_dir):
    """Page intervals loaded in one-minute pieces and merged by greatest end."""
    visits = page_visits(
        olap.page_rows(samples.dwd(spark, sf_dir, users=True, geo=True), ["seq"]),
        olap.PAGE_COLUMNS, ["seq"])
    pieces = visits.where(F.col("url").isNotNull()).groupBy(
        time_slice(F.col("event_time"), 1).alias("minute"), "user_id", "session_id", "url",
        F.col("page_load_time").alias("page_start_time")).agg(F.max("event_time").alias("page_end_time"))
    return olap.merge_max(pieces, ["user_id", "session_id", "url", "page_start_time"], "page_end_time")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    traffic_5m, traffic_today, promotion_today, top_pages_overall, top_pages_per_window, dwd_detail,
    lookup_miss_counts, user_dim, video_dim, geo_dim, traffic_olap_1m, traffic_rollup_province_1h,
    traffic_rollup_page_30m, traffic_rollup_terminal_10m, traffic_rollup_new_5m, traffic_rollup_day,
    bitmap_users_day, sessions_hll_day, page_dwell, page_dwell_per_page, video_segments, running_sum_then_window,
    retained_partitions, event_rows, change_rows, line_rows, event_clock, merged_ranking, geohash_cells, time_slices, url_parts, properties_json, user_lookup, area_lookup, page_lookup,
    area_hierarchy, latest_user_changes, promotion_loads, page_uv_5m, marked_visits, play_parts,
    running_sum_by_gender, running_loads_by_session, merged_bitmap_users, merged_dwell_loads,
    sparse_users_day, stored_rollups,
)} | STREAMED
