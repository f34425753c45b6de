"""Operators on small hand-made cases: cumulative windows, rankings, lookups, dimensions, roll-ups, stored tables."""

import random

import pytest
from pyspark.sql import functions as F

from footfall.functions.clock import DAY_MS, UTC8_MS
from footfall.operators.cumulate import cumulate
from footfall.operators.distinct_state import build_state, merge_state, read_state
from footfall.operators.latest import latest_changes, live_rows
from footfall.operators.lookup import at_most, lookup, unique_by
from footfall.operators.ranking import top_n
from footfall.operators.slices import running, running_state, slice_hot_keys
from footfall.plans import dashboards, dimensions, exploration, olap
from footfall.plans.widen import DETAIL_COLUMNS, detail, widen
from footfall.sinks.partitions import (compact_day, drop_days_before, partition_days, retained, write_batch)
from footfall.sinks.snapshots import current, newest_version, publish
from footfall.sources.events import DWD_DDL, bad_records, good_records, parse_messages
from tests.conftest import rows_of

MIDNIGHT = 1_714_752_000_000  # 2024-05-04 00:00 at +8


def test_cumulate_against_definition(spark):
    """Every row counts in each window of its day that ends after it: by brute force, with NULL keys and groups."""
    rng = random.Random(4)
    rows = [(MIDNIGHT + rng.choice([0, 1, 299_999, 300_000, 86_100_000, DAY_MS - 1, rng.randrange(2 * DAY_MS)]),
             rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "event_time BIGINT, page STRING, user_id BIGINT")
    got = {(str(r.window_start), str(r.window_end), r.page): (r.pv, r.uv)
           for r in cumulate(df, "event_time", ["page"], {"pv": F.lit(1)}, {"uv": F.col("user_id")}).collect()}
    expected = {}
    shown = df.sparkSession.range(0, 577).selectExpr(
        f"string(timestampadd(MILLISECOND, {MIDNIGHT + UTC8_MS} + id * 300000, timestamp_ntz'1970-01-01')) AS t").collect()
    for day in (0, 1):
        for step in range(1, 289):
            end = MIDNIGHT + day * DAY_MS + step * 300_000
            for page in ("a", "b", None):
                inside = [r for r in rows if MIDNIGHT + day * DAY_MS <= r[0] < end and r[1] == page]
                if inside:
                    key = (shown[day * 288].t, shown[day * 288 + step].t, page)
                    expected[key] = (len(inside), len({r[2] for r in inside} - {None}))
    assert got == expected


def test_top_n_ties_and_short_groups(spark):
    rows = [("t", "w1", "/b", 5), ("t", "w1", "/a", 5), ("t", "w0", "/z", 5), ("t", "w1", None, 5), (None, "w1", "/a", 1),
            ("t", "w2", "/c", 9)]
    df = spark.createDataFrame(rows, "page_type STRING, window_start STRING, page_url STRING, uv_amt BIGINT")
    assert rows_of(dashboards.rank_overall(df, 3)) == [
        ("", "w1", "/a", "1"), ("t", "w0", "/z", "5"), ("t", "w1", "", "5"), ("t", "w2", "/c", "9")]
    top = top_n(df, ["page_type"], [F.desc("uv_amt")], 1)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_lookup_keeps_unmatched_and_null_keys(spark):
    events = spark.createDataFrame([("a", 1), ("x", 2), (None, 3), (None, 4)], "k STRING, n INT")
    dim = spark.createDataFrame([("a", ("A",)), (None, ("N",))], "key STRING, f STRUCT<v: STRING>")
    for salt in ((), ("n",)):
        got = lookup(events, dim, F.col("k"), F.col("key"), {"v": "f.v"}, salt)
        assert rows_of(got) == [("", "3", ""), ("", "4", ""), ("a", "1", "A"), ("x", "2", "")]
    assert at_most(events, 4) and not at_most(events, 3)


def test_null_keys_spread_over_partitions(spark):
    """Rows without a key do not meet in one shuffle partition."""
    events = spark.range(4000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("n"))
    dim = spark.createDataFrame([("a", ("A",))], "key STRING, f STRUCT<v: STRING>")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup(events, dim, F.col("k"), F.col("key"), {"v": "f.v"}, ("n",))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4000 and max(sizes) < 1500


def test_unique_and_latest(spark):
    rows = spark.createDataFrame([("a", 1, 1, "c"), ("a", 2, 5, "u"), ("b", 3, 2, "c"), (None, 4, 9, "c")],
                                 "name STRING, id INT, seq BIGINT, op STRING")
    assert rows_of(unique_by(rows, "name", [F.col("seq"), F.col("id")])) == [("a", "2", "5", "u"), ("b", "3", "2", "c")]
    changes = spark.createDataFrame([(1, 1, "c"), (1, 3, "d"), (1, 2, "u"), (2, 1, "c"), (2, 2, "d"), (2, 3, "c")],
                                    "id BIGINT, seq BIGINT, op STRING")
    assert rows_of(live_rows(latest_changes(changes, "id"))) == [("2", "3", "c")]


def test_geo_dim_least_province_first(spark):
    """A NULL or blank least province removes the cell; parents that are missing remove the community."""
    rows = [(1, 0, 1, "P", None, None), (2, 0, 1, None, None, None), (11, 1, 2, "C", None, None), (12, 2, 2, "D", None, None),
            (21, 11, 3, "R", None, None), (22, 12, 3, "S", None, None), (23, 11, 3, None, None, None),
            (31, 21, 4, "x", 10.0, 10.0), (32, 21, 4, "y", 20.0, 20.0), (33, 22, 4, "z", 20.0, 20.0),
            (34, 23, 4, "n", 30.0, 30.0), (35, 99, 4, "o", 40.0, 40.0), (36, 21, 4, "p", None, 10.0)]
    areas = spark.createDataFrame(
        rows, "id BIGINT, parentid BIGINT, level INT, areaname STRING, bd09_lat DOUBLE, bd09_lng DOUBLE")
    got = {(r.province, r.city, r.region) for r in dimensions.geo_dim(areas).collect()}
    assert got == {("P", "C", "R"), ("P", "C", "")}
    assert dimensions.geo_dim(areas).count() == 2


def test_states_merge_like_counts(spark):
    """70,000 users over several bitmap buckets, in three loads, some without a user."""
    rows = spark.range(140_000).selectExpr(
        "id % 3 AS load", "if(id % 2 = 0, 'a', 'b') AS g", "if(id % 70000 = 7, NULL, id % 70000) AS user_id",
        "concat('s', id % 9000) AS session_id", "1L AS pv")
    states = None
    for load in range(3):
        state = build_state(rows.where(f"load = {load}"), ["g"])
        states = state if states is None else states.unionByName(state)
    total = read_state(merge_state(states, ["g"]), []).first()
    assert (total.pv, total.uv) == (140_000, 69_999)
    assert abs(total.session_cnt - 9000) <= 450
    by_group = {r.g: (r.pv, r.uv) for r in read_state(states, ["g"]).collect()}
    exact = {r.g: (r.pv, r.uv) for r in olap.traffic_rollup(rows, ["g"]).collect()}
    assert by_group == exact


@pytest.mark.parametrize("min_rows", [10, 1])
def test_running_with_null_key_and_slices(spark, min_rows):
    rng = random.Random(6)
    rows = [(rng.choice(["a", None]), i // 3 * 40_000, rng.randrange(9)) for i in range(200)]
    df = spark.createDataFrame(rows, "k STRING, ms BIGINT, v INT")
    cut = slice_hot_keys("k", "ms", min_rows=min_rows)
    got = rows_of(running(df, "k", "ms", {"s": ("sum", F.col("v"))}, cut), "k", "ms", "v", "s")
    expected = sorted((k or "", str(ms), str(v), str(sum(x for kk, m, x in rows if kk == k and m <= ms)))
                      for k, ms, v in rows)
    assert got == expected
    state = running_state(df, "k", "ms", {"s": ("sum", F.col("v"))})
    assert {r.k: r.s for r in state.collect()} == {k: sum(v for kk, _, v in rows if kk == k) for k in ("a", None)}


def test_sample_row_of_the_data_contract(spark):
    """One widened event by hand: page url, day and slice at +8, not a new user."""
    event = spark.sql("""
        SELECT 14L AS user_id, 's04' AS session_id, 'page_load' AS event_id, 1714789200000L AS event_time,
               map('url', '/content/article/2354.html?a=3') AS properties, 'g' AS gps_province, 'g' AS gps_city,
               'g' AS gps_region, 'd' AS device_type, 'c' AS release_channel, 't' AS page_type, 's' AS page_service,
               timestamp_ntz'2018-11-12 14:22:55' AS register_time""")
    row = olap.traffic_olap(event).first()
    assert (str(row.dt), row.time_trunk_1h, row.time_trunk_30m, row.page_url, row.is_new, row.pv) == (
        "2024-05-04", "2024-05-04 10:00:00", "2024-05-04 10:00:00", "/content/article/2354.html", 0, 1)


def test_new_users(spark):
    """Promotion: new from the event's day on or unknown. Traffic: new on the day only, unknown is not new."""
    rows = spark.sql(f"""
        SELECT id AS user_id, 'page_load' AS event_id, {MIDNIGHT}L AS event_time, 'P' AS register_province,
               map('url', '/mall/promotion/qxlx1.html') AS properties,
               CASE id WHEN 0 THEN timestamp_ntz'2024-05-03 23:59:59' WHEN 1 THEN timestamp_ntz'2024-05-04 09:00:00'
                       WHEN 2 THEN timestamp_ntz'2024-05-05 00:00:00' END AS register_time
        FROM range(4)""")
    assert rows_of(dashboards.promotion_events(rows), "user_id", "new_user_id") == [
        ("0", ""), ("1", "1"), ("2", "2"), ("3", "3")]
    wide = rows
    for name in ("gps_province", "gps_city", "gps_region", "device_type", "release_channel", "page_type",
                 "page_service", "session_id"):
        wide = wide.withColumn(name, F.lit("x"))
    assert rows_of(olap.traffic_rows(wide), "user_id", "is_new") == [("0", "0"), ("1", "1"), ("2", "0"), ("3", "0")]


def test_messages(spark):
    """Missing fields become NULL, other text goes to the bad records, an unknown field is ignored."""
    texts = ['{"username": "a", "action_time": 5, "properties": {"url": "/x"}, "more": 1}', "{}", "junk", '{"lat": "x"}']
    parsed = parse_messages(spark.createDataFrame([(t,) for t in texts], "value STRING"),
                            "username STRING, action_time BIGINT, lat DOUBLE, properties MAP<STRING, STRING>")
    assert rows_of(bad_records(parsed)) == [("junk",), ('{"lat": "x"}',)]
    good = {(r.username, r.action_time, (r.properties or {}).get("url")) for r in good_records(parsed).collect()}
    assert good == {("a", 5, "/x"), (None, None, None)}


def test_partitions_retention_compaction(spark, tmp_path):
    path, merged = str(tmp_path / "t"), str(tmp_path / "m")
    for batch_id in range(3):
        rows = spark.sql("SELECT date'2024-01-01' + int(id % 3) AS dt, id % 5 AS k, 1L AS pv FROM range(30)")
        write_batch(rows, path, batch_id)
    assert partition_days(spark, path) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    kept = retained(spark.read.parquet(path), F.lit("2024-01-03").cast("date"), 1)
    assert sorted({str(r.dt) for r in kept.collect()}) == ["2024-01-02", "2024-01-03"]
    assert "PartitionFilters: [isnotnull(dt" in kept._jdf.queryExecution().executedPlan().toString()
    for _ in range(2):
        compact_day(spark, path, "2024-01-02", lambda t: t.groupBy("dt", "k").agg(F.sum("pv").alias("pv")), merged)
    assert rows_of(spark.read.parquet(merged), "k", "pv") == [(str(k), "6") for k in range(5)]
    assert drop_days_before(spark, path, "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert partition_days(spark, path) == ["2024-01-03"]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    assert current(spark, path) is None
    for version in range(5):
        publish(spark.range(version + 1), path, version)
    assert current(spark, path).count() == 5
    assert current(spark, path, below=4).count() == 4
    (tmp_path / "s" / "version=4" / "_SUCCESS").unlink()
    assert newest_version(spark, path) == 3
    assert newest_version(spark, path, below=2) is None  # only the newest three are kept


def test_empty_inputs(spark):
    dwd = spark.createDataFrame([], DWD_DDL)
    lines = spark.createDataFrame([], "user_id STRING, name STRING, gender STRING, age INT, action_time BIGINT")
    videos = spark.createDataFrame([], "id BIGINT, f STRUCT<video_name: STRING, video_type: STRING, "
                                       "video_album: STRING, video_author: STRING, video_timelong: BIGINT>")
    for result in (dashboards.traffic_5m(dwd), dashboards.traffic_today(dwd), dashboards.promotion_today(dwd),
                   dashboards.top_pages_overall(dwd), dashboards.top_pages_per_window(dwd), olap.traffic_olap(dwd),
                   olap.page_dwell(dwd), olap.video_segments(dwd, videos), exploration.running_sum_then_window(lines)):
        assert result.count() == 0


def test_detail_columns(spark):
    events = spark.createDataFrame(
        [("u", "s", "page_load", MIDNIGHT, 39.9042, 116.4074, "c", "d", {"url": "/a/b.html", "n": None})],
        "username STRING, session_id STRING, event_id STRING, action_time BIGINT, lat DOUBLE, lng DOUBLE, "
        "release_channel STRING, device_type STRING, properties MAP<STRING, STRING>")
    users = spark.sql("SELECT 'u' AS username, named_struct('id', 9L, 'phone', 'p', 'status', 1, 'create_time', "
                      "timestamp_ntz'2020-01-01', 'gender', 0, 'birthday', date'2000-01-01', 'province', 'P', 'city', 'C', "
                      "'job', 'j', 'source_type', 2) AS f")
    geo = spark.sql("SELECT reverse('wx4g0') AS geohash, named_struct('p', 'gp', 'c', 'gc', 'r', 'gr') AS f")
    pages = spark.sql("SELECT '/a/' AS url_prefix, named_struct('page_service', 's1', 'page_type', 't1') AS f")
    rows = detail(widen(events, users, geo, pages))
    assert rows.columns == DETAIL_COLUMNS
    row = rows.first()
    assert (row.user_id, row.register_city, row.page_type, str(row.dt), row.properties) == (
        9, "C", "t1", "2024-05-04", '{"url":"/a/b.html"}')
    assert (row.gps_province, row.gps_city, row.gps_region) == ("gp", "gc", "gr")


def test_hot_lookup_key_is_split(spark, tmp_path):
    """Too large to broadcast: the shuffle partition of a key with a third of all events is split, rows stay whole."""
    publish(spark.range(2000).selectExpr("concat('u', id) AS username", "named_struct('id', id) AS f"),
            str(tmp_path / "users"), 0)
    spark.range(60_000).selectExpr("if(id % 3 = 0, 'u7', concat('u', id % 4000)) AS username", "id AS n",
                                   "sha2(string(id), 512) AS payload") \
        .repartition(16).write.parquet(str(tmp_path / "events"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup(spark.read.parquet(str(tmp_path / "events")), current(spark, str(tmp_path / "users")),
                        F.col("username"), F.col("username"), {"user_id": "f.id"}, ("n",))
        plan = joined.select("n", "user_id", "payload")
        rows = plan.collect()
        final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in final
    assert len(rows) == 60_000
    assert sum(r.user_id == 7 for r in rows) == 20_000 + sum(1 for i in range(60_000) if i % 3 and i % 4000 == 7)
