"""Behaviour events and dimensions derived from the star-schema test tables.

Every input of the jobs is a deterministic function of the given tables, so the same rows can be derived in any SQL
engine. Time is compressed 15 times (30 days to 2), which puts gaps inside sessions on both sides of 30 minutes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.clock import DAY_MS, UTC8_MS, epoch_ms_sql
from footfall.plans.dimensions import USER_STRUCT, VIDEO_STRUCT, as_keyed, keyed_geo_dim
from footfall.plans.widen import widen

START_MS = 1_704_067_200_000
COMPRESSION = 15

ACTION_TIME = f"{START_MS} + ({epoch_ms_sql('ts')} - {START_MS}) div {COMPRESSION}"


def _latitude(key: str) -> str:
    return f"double(3950 + ({key} % 40) * 2) / 100"


def _longitude(key: str) -> str:
    return f"double(11600 + ({key} % 37) * 3) / 100"


# Stated rather than inferred: inference would cost a job per table and query.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def ods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events plus ``seq``, the source's order."""
    events = _table(spark, sf_dir, "events").selectExpr(
        "event_id AS seq", "user_id", "event_type AS kind", "int(get_json_object(props, '$.k')) AS k",
        f"{ACTION_TIME} AS action_time", "event_type IN ('purchase', 'error') AS playing")
    return events.selectExpr(
        "concat('user_', user_id) AS username",
        f"concat('s', user_id, '_', (action_time + {UTC8_MS}) div {DAY_MS}) AS session_id",
        """CASE WHEN kind = 'view' OR (kind = 'click' AND seq % 2 = 0) THEN 'page_load'
                WHEN kind = 'click' THEN 'item_share'
                WHEN kind = 'signup' THEN 'wake_up'
                WHEN playing THEN elt(int(seq % 5) + 1, 'video_play', 'video_hb', 'video_pause', 'video_resume',
                                      'video_stop') END AS event_id""",
        "action_time",
        f"if(user_id % 13 <> 12, {_latitude('user_id')}, NULL) AS lat",
        f"if(user_id % 13 <> 12, {_longitude('user_id')}, NULL) AS lng",
        "concat('ch_', user_id % 4) AS release_channel",
        "concat('dev_', user_id % 3) AS device_type",
        """map_concat(
               CASE WHEN k % 8 = 0 THEN map('url', concat('/mall/promotion/qxlx', k, '.html?a=1'))
                    WHEN k % 8 = 1 THEN map('url', concat('/mall/promotion/qxcd', k, '.html'))
                    WHEN k % 8 = 2 THEN map('url', concat('/mall/promotion/qxjh', k, '.html?b=2'))
                    WHEN k % 8 IN (3, 4, 5) THEN map('url', concat('/content/article/', k, '.html?a=3'))
                    WHEN k % 8 = 6 THEN map('url', concat('/video/play/', k, '.html'))
                    ELSE CAST(map() AS MAP<STRING, STRING>) END,
               if(playing, map('video_id', string(seq % 2500), 'play_id', concat('p', user_id, '_', seq % 3)),
                  CAST(map() AS MAP<STRING, STRING>))) AS properties""",
        "seq")


def user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user per customer."""
    nations = _table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS province")
    return _table(spark, sf_dir, "customer").join(nations, "c_nationkey", "left").selectExpr(
        "c_custkey AS id", "concat('user_', c_custkey) AS username",
        "concat('1', lpad(string(c_custkey), 10, '0')) AS phone", "int(c_custkey % 3) AS status",
        """CASE WHEN c_custkey % 11 = 10 THEN NULL
                WHEN c_custkey % 5 = 0 THEN timestamp_ntz'2024-01-02 08:00:00'
                WHEN c_custkey % 5 = 1 THEN timestamp_ntz'2024-01-01 09:00:00'
                ELSE timestamp_ntz'2018-11-12 14:22:55' END AS create_time""",
        "int(c_custkey % 2) AS gender", "date_add(date'1980-01-01', int(c_custkey % 10000)) AS birthday",
        "province", "concat('city_', c_custkey % 50) AS city", "c_mktsegment AS job",
        "int(c_custkey % 4) AS source_type")


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by name; every tenth is missing."""
    return as_keyed(user_rows(spark, sf_dir).where("id % 10 <> 9"), "username", USER_STRUCT)


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert per customer, an update for every fourth (renaming every 28th), a delete for every twentieth."""
    changes = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        """explode(filter(array(1L, if(c_custkey % 4 = 0, 2L, NULL), if(c_custkey % 20 = 0, 3L, NULL)),
                          s -> s IS NOT NULL)) AS seq""")
    return changes.selectExpr(
        "elt(int(seq), 'c', 'u', 'd') AS op", "seq", "id",
        "concat(if(seq >= 2 AND id % 28 = 0, 'renamed_', 'user_'), id) AS username",
        "int(id % 3 + if(seq >= 2, 10, 0)) AS status")


def video_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_name AS video_name", "p_type AS video_type", "p_brand AS video_album",
        "concat('a', p_size) AS video_author", "bigint(p_size) * 60000 AS video_timelong")


def dim_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts but every tenth; play events name 2,500 ids, of which some are missing."""
    return as_keyed(video_rows(spark, sf_dir).where("id % 10 <> 9"), "id", VIDEO_STRUCT)


def video_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert per part, a longer version for every third, a delete for every tenth."""
    rows = video_rows(spark, sf_dir).selectExpr(
        "*", """explode(filter(array(1L, if(id % 3 = 0, 2L, NULL), if(id % 10 = 0, 3L, NULL)),
                               s -> s IS NOT NULL)) AS seq""")
    return rows.selectExpr(
        "elt(int(seq), 'c', 'u', 'd') AS op", "seq", "id", "video_name", "video_type", "video_album", "video_author",
        "video_timelong + if(seq >= 2, 1000, 0) AS video_timelong")


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region > nation > supplier > customer as a four-level area hierarchy, with unnamed areas on three levels."""
    supplier = _table(spark, sf_dir, "supplier")
    suppliers = supplier.selectExpr("count(*) AS n").scalar()
    customer = _table(spark, sf_dir, "customer").withColumn("suppliers", suppliers)

    def level(table: DataFrame, no: int, key: str, parent: str, name: str, lat: str = "NULL", lng: str = "NULL"):
        return table.selectExpr(
            f"bigint({no}0000000 + {key}) AS id", f"bigint({parent}) AS parentid", f"{no} AS level",
            f"string({name}) AS areaname", f"double({lat}) AS bd09_lat", f"double({lng}) AS bd09_lng")

    return level(
        _table(spark, sf_dir, "region"), 1, "r_regionkey", "0", "if(r_regionkey = 4, ' ', r_name)",
    ).unionByName(level(
        _table(spark, sf_dir, "nation"), 2, "n_nationkey", "10000000 + n_regionkey", "n_name",
    )).unionByName(level(
        supplier, 3, "s_suppkey", "20000000 + s_nationkey", "if(s_suppkey % 10 <> 9, s_name, NULL)",
    )).unionByName(level(
        customer, 4, "c_custkey", "30000000 + c_custkey % suppliers", "c_name",
        f"if(c_custkey % 50 <> 49, {_latitude('c_custkey')}, NULL)", _longitude("c_custkey")))


def dim_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_geo_dim(areas(spark, sf_dir))


# The page dimension. The prefix /video/play/ is left out on purpose.
PAGES = [("/mall/promotion/", "商城服务", "活动页"), ("/content/article/", "内容服务", "文章页")]


def dim_page(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{prefix}', named_struct('page_service', '{service}', 'page_type', '{kind}'))"
                     for prefix, service, kind in PAGES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS pages(url_prefix, f)")


def dwd(spark: SparkSession, sf_dir: str, users: bool = False, geo: bool = False, pages: bool = False) -> DataFrame:
    """Widened events with the wanted lookups, plus ``seq``.

    The area dimension is computed here instead of read from a snapshot, so Spark cannot see its size in advance;
    adaptive execution broadcasts it once it is known to be small.
    """
    return widen(
        ods(spark, sf_dir), dim_user(spark, sf_dir) if users else None, dim_geo(spark, sf_dir) if geo else None,
        dim_page(spark) if pages else None, keep=["seq"])


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person lines id, name, gender, age, seconds out of the events."""
    return _table(spark, sf_dir, "events").selectExpr(
        "string(user_id) AS user_id", "concat('user_', user_id) AS name", "if(user_id % 2 = 0, 'f', 'm') AS gender",
        "int(18 + user_id % 50) AS age", f"({ACTION_TIME}) div 1000 AS action_time")
