"""Raw events -> widened events, and the day-partitioned detail rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import day_of, map_to_json, url_prefix, with_geohash
from footfall.operators.lookup import lookup
from footfall.sources.events import DWD_DDL, struct_of

USER_FIELDS = {
    "user_id": "f.id", "register_phone": "f.phone", "user_status": "f.status", "register_time": "f.create_time",
    "register_gender": "f.gender", "register_birthday": "f.birthday", "register_province": "f.province",
    "register_city": "f.city", "register_job": "f.job", "register_source_type": "f.source_type",
}
GEO_FIELDS = {"gps_province": "f.p", "gps_city": "f.c", "gps_region": "f.r"}
PAGE_FIELDS = {"page_type": "f.page_type", "page_service": "f.page_service"}

WIDE_COLUMNS = [
    "user_id", "username", "session_id", "event_id", "event_time", "lat", "lng", "release_channel", "device_type",
    "properties", *[c for c in USER_FIELDS if c != "user_id"], *GEO_FIELDS, *PAGE_FIELDS,
]
DETAIL_COLUMNS = [
    *GEO_FIELDS, "dt", "user_id", "username", "session_id", "event_id", "event_time", "lat", "lng",
    "release_channel", "device_type", "properties", *[c for c in USER_FIELDS if c != "user_id"], *PAGE_FIELDS,
]
# Spreads events without a key; any columns that differ from event to event do.
SALT = ("session_id", "event_time")


def widen(events: DataFrame, users: DataFrame | None = None, geo: DataFrame | None = None,
          pages: DataFrame | None = None, keep: Sequence[str] = (),
          small: Sequence[str] = ()) -> DataFrame:
    """Look up user (by name), area (by reversed geohash) and page (by url prefix) of every event.

    Each dimension is ``key, f STRUCT<...>``; one that is not given is not joined and its columns are left out.
    ``keep`` names further event columns to pass on, ``small`` the dimensions that were counted and may be broadcast.
    """
    wide = events.withColumnRenamed("action_time", "event_time")
    if users is not None:
        wide = lookup(wide, users, F.col("username"), F.col("username"), USER_FIELDS, SALT, "users" in small)
    if geo is not None:
        wide = lookup(with_geohash(wide, "__cell"), geo, F.reverse("__cell"), F.col("geohash"), GEO_FIELDS, SALT,
                      "geo" in small)
    if pages is not None:
        prefix = url_prefix(F.col("properties")["url"])
        wide = lookup(wide, pages, prefix, F.col("url_prefix"), PAGE_FIELDS, SALT, "pages" in small)
    return wide.select(*[c for c in WIDE_COLUMNS if c in wide.columns], *keep)


def look_up_users(missed: DataFrame, users: DataFrame) -> DataFrame:
    """``missed``, widened events without a user, looked up once more."""
    found = lookup(missed.drop(*USER_FIELDS), users, F.col("username"), F.col("username"), USER_FIELDS, SALT)
    return found.select(*missed.columns)


def with_all_fields(wide: DataFrame) -> DataFrame:
    """``wide`` with the fields of dimensions that do not exist yet as NULL."""
    kinds = {f.name: f.dataType for f in struct_of(DWD_DDL).fields}
    return wide.withColumns({c: F.lit(None).cast(kinds[c]) for c in WIDE_COLUMNS if c not in wide.columns})


def detail(wide: DataFrame) -> DataFrame:
    """Detail rows: the wide columns with ``properties`` as JSON text and the local day ``dt``."""
    return wide.withColumn("properties", map_to_json(F.col("properties"))) \
        .withColumn("dt", day_of(F.col("event_time"))).select(*DETAIL_COLUMNS)


def lookup_misses(wide: DataFrame) -> DataFrame:
    """Events per day and how many found no user, area or page."""
    return wide.groupBy(day_of(F.col("event_time")).alias("dt")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("user_id").isNull()).alias("no_user"),
        F.count_if(F.col("gps_province").isNull()).alias("no_area"),
        F.count_if(F.col("page_type").isNull()).alias("no_page"))
