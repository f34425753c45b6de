"""Dashboard figures over widened events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import day_of, page_url, typed_null, wall_clock
from footfall.functions.clock import MINUTE_MS, floor_to
from footfall.operators.cumulate import cumulate
from footfall.operators.ranking import top_n

WINDOW_MS = 5 * MINUTE_MS

# Url fragment of each promotion page and its name.
PROMOTIONS = {
    "/mall/promotion/qxlx": "七夕拉新",
    "/mall/promotion/qxcd": "七夕促单",
    "/mall/promotion/qxjh": "七夕激活",
}
# The ranking keeps rows numbered below 10.
TOP_PAGES = 9


def page_loads() -> Column:
    return F.when(F.col("event_id") == "page_load", 1).otherwise(0).cast("long")


def window_bounds(start_ms: Column, width_ms: int) -> list[Column]:
    return [wall_clock(start_ms).alias("window_start"), wall_clock(start_ms + F.lit(width_ms)).alias("window_end")]


def traffic_5m(dwd: DataFrame) -> DataFrame:
    """Page views, users and sessions per five minutes."""
    timed = dwd.where(F.col("event_time").isNotNull())
    windows = timed.groupBy(floor_to(F.col("event_time"), WINDOW_MS).alias("start_ms")).agg(
        F.sum(page_loads()).alias("pv_amt"),
        F.count_distinct("user_id").alias("uv_amt"),
        F.count_distinct("session_id").alias("ses_amt"))
    return windows.select(*window_bounds(F.col("start_ms"), WINDOW_MS), "pv_amt", "uv_amt", "ses_amt")


def traffic_today(dwd: DataFrame) -> DataFrame:
    """Page views, users and sessions from local midnight to every five minutes."""
    return cumulate(dwd, "event_time", [], {"pv_amt": page_loads()},
                    {"uv_amt": F.col("user_id"), "ses_amt": F.col("session_id")})


def promotion_rows(dwd: DataFrame) -> DataFrame:
    """All events with ``promoted`` (a load of a promotion page), the page's name and the user as new user.

    A user is new from the event's day on; an unknown registration time counts as new.
    """
    url = F.col("properties")["url"]
    name = F.lit("")
    for fragment, label in reversed(PROMOTIONS.items()):
        name = F.when(url.contains(fragment), label).otherwise(name)
    registered = F.col("register_time").cast("date")
    is_old = registered < day_of(F.col("event_time"))
    return dwd.select(
        "event_time", "user_id", "register_province", name.alias("promotion_page_name"),
        F.when(is_old, typed_null()).otherwise(F.col("user_id")).alias("new_user_id"),
        ((F.col("event_id") == "page_load") & (name != "")).alias("promoted"))


def promotion_events(dwd: DataFrame) -> DataFrame:
    return promotion_rows(dwd).where("promoted").drop("promoted")


def promotion_today(dwd: DataFrame) -> DataFrame:
    """Views, users and new users per promotion page and province, from midnight to every five minutes."""
    figures = cumulate(
        promotion_events(dwd), "event_time", ["promotion_page_name", "register_province"],
        {"pv_amt": F.lit(1).cast("long")},
        {"uv_amt": F.col("user_id"), "new_uv_amt": F.col("new_user_id")})
    return figures.withColumnRenamed("register_province", "province")


def page_uv_5m(dwd: DataFrame) -> DataFrame:
    """Users per page and five minutes."""
    timed = dwd.where(F.col("event_time").isNotNull())
    pages = timed.groupBy(
        floor_to(F.col("event_time"), WINDOW_MS).alias("start_ms"), "page_type",
        page_url(F.col("properties")["url"]).alias("page_url"),
    ).agg(F.count_distinct("user_id").alias("uv_amt"))
    return pages.select(*window_bounds(F.col("start_ms"), WINDOW_MS), "page_type", "page_url", "uv_amt")


def _best_first() -> list[Column]:
    return [F.desc("uv_amt"), F.asc("window_start"), F.asc_nulls_first("page_url")]


def rank_overall(page_uv: DataFrame, n: int = TOP_PAGES) -> DataFrame:
    return top_n(page_uv, ["page_type"], _best_first(), n)


def rank_per_window(page_uv: DataFrame, n: int = TOP_PAGES) -> DataFrame:
    return top_n(page_uv, ["window_start", "page_type"], _best_first(), n)


def top_pages_overall(dwd: DataFrame, n: int = TOP_PAGES) -> DataFrame:
    """The n best (window, page) rows of each page type over all windows."""
    return rank_overall(page_uv_5m(dwd), n)


def top_pages_per_window(dwd: DataFrame, n: int = TOP_PAGES) -> DataFrame:
    """The n best pages of each page type in every window."""
    return rank_per_window(page_uv_5m(dwd), n)
