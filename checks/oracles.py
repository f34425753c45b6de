"""The registered queries in standard SQL, for an independent engine over the same tables.

They state each result directly: cumulative windows by a join to all steps of the day, distinct counts by
``count(distinct)``, visits and parts by plain window functions, geohash bit by bit.
"""

from __future__ import annotations

OFFSET = 28_800_000
DAY = 86_400_000

# Fixed value: the public geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def day(ms: str) -> str:
    return f"(DATE '1970-01-01' + CAST(({ms} + {OFFSET}) // {DAY} AS INTEGER))"


def clock(ms: str) -> str:
    """Wall-clock text of whole seconds."""
    return f"strftime(make_timestamp(({ms} + {OFFSET}) * 1000), '%Y-%m-%d %H:%M:%S')"


def trunk(ms: str, minutes: int) -> str:
    return clock(f"({ms} - {ms} % {minutes * 60_000})")


def geohash(lat: str, lng: str) -> str:
    x = f"CAST(floor(({lng} + 180) * 8192 / 360) AS BIGINT)"
    y = f"CAST(floor(({lat} + 90) * 4096 / 180) AS BIGINT)"
    letters = []
    for letter in range(5):
        terms = []
        for place in range(5):
            bit = 5 * letter + place
            axis, low = (x, 12 - bit // 2) if bit % 2 == 0 else (y, 11 - bit // 2)
            terms.append(f"({axis} // {2 ** low}) % 2 * {2 ** (4 - place)}")
        letters.append(f"substr('{ALPHABET}', CAST({' + '.join(terms)} + 1 AS INTEGER), 1)")
    return f"({' || '.join(letters)})"


def page_url(url: str) -> str:
    return f"nullif(regexp_extract({url}, '^(.*?\\.html)'), '')"


def url_prefix(url: str) -> str:
    return f"nullif(regexp_extract({url}, '(^.*/).*?'), '')"


def _lat(key: str) -> str:
    return f"CAST(3950 + ({key} % 40) * 2 AS DOUBLE) / 100"


def _lng(key: str) -> str:
    return f"CAST(11600 + ({key} % 37) * 3 AS DOUBLE) / 100"


PARTS = {
    "base": """
        SELECT event_id AS seq, user_id, event_type AS kind,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 15 AS action_time
        FROM events""",
    "ods": f"""
        SELECT seq, 'user_' || user_id AS username,
               's' || user_id || '_' || ((action_time + {OFFSET}) // {DAY}) AS session_id,
               CASE WHEN kind = 'view' OR (kind = 'click' AND seq % 2 = 0) THEN 'page_load'
                    WHEN kind = 'click' THEN 'item_share'
                    WHEN kind = 'signup' THEN 'wake_up'
                    WHEN seq % 5 = 0 THEN 'video_play'
                    WHEN seq % 5 = 1 THEN 'video_hb'
                    WHEN seq % 5 = 2 THEN 'video_pause'
                    WHEN seq % 5 = 3 THEN 'video_resume'
                    ELSE 'video_stop' END AS event_id,
               action_time,
               CASE WHEN user_id % 13 <> 12 THEN {_lat('user_id')} END AS lat,
               CASE WHEN user_id % 13 <> 12 THEN {_lng('user_id')} END AS lng,
               'ch_' || (user_id % 4) AS release_channel, 'dev_' || (user_id % 3) AS device_type,
               CASE WHEN k % 8 = 0 THEN '/mall/promotion/qxlx' || k || '.html?a=1'
                    WHEN k % 8 = 1 THEN '/mall/promotion/qxcd' || k || '.html'
                    WHEN k % 8 = 2 THEN '/mall/promotion/qxjh' || k || '.html?b=2'
                    WHEN k % 8 IN (3, 4, 5) THEN '/content/article/' || k || '.html?a=3'
                    WHEN k % 8 = 6 THEN '/video/play/' || k || '.html' END AS url,
               CASE WHEN kind IN ('purchase', 'error') THEN CAST(seq % 2500 AS VARCHAR) END AS video_id,
               CASE WHEN kind IN ('purchase', 'error') THEN 'p' || user_id || '_' || (seq % 3) END AS play_id
        FROM base""",
    "dim_user": """
        SELECT 'user_' || c_custkey AS username, c_custkey AS id, '1' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone,
               CAST(c_custkey % 3 AS INTEGER) AS status,
               CASE WHEN c_custkey % 11 = 10 THEN NULL
                    WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-01-02 08:00:00'
                    WHEN c_custkey % 5 = 1 THEN TIMESTAMP '2024-01-01 09:00:00'
                    ELSE TIMESTAMP '2018-11-12 14:22:55' END AS create_time,
               CAST(c_custkey % 2 AS INTEGER) AS gender,
               DATE '1980-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS birthday,
               n_name AS province, 'city_' || (c_custkey % 50) AS city, c_mktsegment AS job,
               CAST(c_custkey % 4 AS INTEGER) AS source_type
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_custkey % 10 <> 9""",
    "areas": f"""
        SELECT 10000000 + r_regionkey AS id, 0 AS parentid, 1 AS lvl,
               CASE WHEN r_regionkey = 4 THEN ' ' ELSE r_name END AS areaname,
               CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lng FROM region
        UNION ALL SELECT 20000000 + n_nationkey, 10000000 + n_regionkey, 2, n_name, NULL, NULL FROM nation
        UNION ALL SELECT 30000000 + s_suppkey, 20000000 + s_nationkey, 3,
               CASE WHEN s_suppkey % 10 <> 9 THEN s_name END, NULL, NULL FROM supplier
        UNION ALL SELECT 40000000 + c_custkey, 30000000 + c_custkey % (SELECT count(*) FROM supplier), 4, c_name,
               CASE WHEN c_custkey % 50 <> 49 THEN {_lat('c_custkey')} END, {_lng('c_custkey')} FROM customer""",
    "cells": f"""
        SELECT DISTINCT reverse({geohash('l4.lat', 'l4.lng')}) AS geohash, l1.areaname AS province, l2.areaname AS city,
               l3.areaname AS region
        FROM areas l4 JOIN areas l3 ON l4.parentid = l3.id JOIN areas l2 ON l3.parentid = l2.id
             JOIN areas l1 ON l2.parentid = l1.id
        WHERE l4.lvl = 4 AND l4.lat IS NOT NULL AND l4.lng IS NOT NULL""",
    "dim_geo": """
        SELECT geohash, province, city, coalesce(region, '') AS region
        FROM (SELECT *, row_number() OVER (PARTITION BY geohash ORDER BY province NULLS FIRST, city NULLS FIRST,
                                           region NULLS FIRST) AS rn FROM cells)
        WHERE rn = 1 AND length(trim(geohash)) = 5 AND trim(province) <> '' AND trim(city) <> ''""",
    "dim_page": """
        SELECT * FROM (VALUES ('/mall/promotion/', '商城服务', '活动页'), ('/content/article/', '内容服务', '文章页'))
            AS t(prefix, page_service, page_type)""",
    "dim_video": """
        SELECT p_partkey AS id, p_name, p_type, p_brand, 'a' || p_size AS author, CAST(p_size AS BIGINT) * 60000 AS len
        FROM part WHERE p_partkey % 10 <> 9""",
    "dwd": f"""
        SELECT u.id AS user_id, e.username, e.session_id, e.event_id, e.action_time AS event_time, e.lat, e.lng,
               e.release_channel, e.device_type, e.url, e.video_id, e.play_id, u.phone AS register_phone,
               u.status AS user_status, u.create_time AS register_time, u.gender AS register_gender,
               u.birthday AS register_birthday, u.province AS register_province, u.city AS register_city,
               u.job AS register_job, u.source_type AS register_source_type, g.province, g.city, g.region,
               p.page_type, p.page_service, e.seq
        FROM ods e LEFT JOIN dim_user u ON e.username = u.username
             LEFT JOIN dim_geo g ON reverse({geohash('e.lat', 'e.lng')}) = g.geohash
             LEFT JOIN dim_page p ON {url_prefix('e.url')} = p.prefix""",
    "user_changes": """
        SELECT c_custkey AS id, s AS seq, CASE s WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op,
               CASE WHEN s >= 2 AND c_custkey % 28 = 0 THEN 'renamed_' ELSE 'user_' END || c_custkey AS username,
               CAST(c_custkey % 3 + CASE WHEN s >= 2 THEN 10 ELSE 0 END AS INTEGER) AS status
        FROM customer, (SELECT CAST(range AS BIGINT) AS s FROM range(1, 4))
        WHERE s = 1 OR (s = 2 AND c_custkey % 4 = 0) OR (s = 3 AND c_custkey % 20 = 0)""",
    "user_latest": """
        SELECT id, seq, op, username, status FROM
            (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM user_changes)
        WHERE rn = 1 AND op <> 'd'""",
    "video_changes": """
        SELECT p_partkey AS id, s AS seq, CASE s WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op,
               p_name AS video_name, p_type AS video_type, p_brand AS video_album, 'a' || p_size AS video_author,
               CAST(p_size AS BIGINT) * 60000 + CASE WHEN s >= 2 THEN 1000 ELSE 0 END AS video_timelong
        FROM part, (SELECT CAST(range AS BIGINT) AS s FROM range(1, 4))
        WHERE s = 1 OR (s = 2 AND p_partkey % 3 = 0) OR (s = 3 AND p_partkey % 10 = 0)""",
    "steps": """
        SELECT CAST(range AS BIGINT) AS step FROM range(1, 289)""",
    "promo": f"""
        SELECT event_time, user_id, register_province,
               CASE WHEN url LIKE '%/mall/promotion/qxlx%' THEN '七夕拉新'
                    WHEN url LIKE '%/mall/promotion/qxcd%' THEN '七夕促单'
                    ELSE '七夕激活' END AS promotion_page_name,
               CASE WHEN CAST(register_time AS DATE) < {day('event_time')} THEN NULL ELSE user_id END AS new_user_id
        FROM dwd WHERE event_id = 'page_load'
             AND (url LIKE '%/mall/promotion/qxlx%' OR url LIKE '%/mall/promotion/qxcd%'
                  OR url LIKE '%/mall/promotion/qxjh%')""",
    "page_uv": f"""
        SELECT event_time - event_time % 300000 AS start_ms, page_type, {page_url('url')} AS page_url,
               count(DISTINCT user_id) AS uv_amt
        FROM dwd GROUP BY ALL""",
    "olap": f"""
        SELECT event_time - event_time % 60000 AS minute_ms, province, city, region, device_type, release_channel,
               {page_url('url')} AS page_url, page_type, page_service,
               CASE WHEN CAST(register_time AS DATE) = {day('event_time')} THEN 1 ELSE 0 END AS is_new,
               user_id, session_id, count(*) AS pv
        FROM dwd GROUP BY ALL""",
    "gaps": """
        SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY session_id ORDER BY event_time, seq)
                            >= 1800000 THEN 1 ELSE 0 END AS gap
        FROM dwd""",
    "islands": """
        SELECT *, sum(gap) OVER (PARTITION BY session_id ORDER BY event_time, seq) AS island FROM gaps""",
    "loads": """
        SELECT *, last_value(CASE WHEN event_id IN ('page_load', 'wake_up') THEN event_time END IGNORE NULLS) OVER
                   (PARTITION BY session_id, island ORDER BY event_time, seq
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS load_time
        FROM islands""",
    "setters": """
        SELECT *, lead(event_id) OVER w AS next_id, lead(event_time) OVER w AS next_time
        FROM islands WHERE event_id IN ('page_load', 'wake_up')
        WINDOW w AS (PARTITION BY session_id, island ORDER BY event_time, seq)""",
    "visits": """
        SELECT session_id, user_id, province, city, region, url, load_time, event_time FROM loads
        UNION ALL
        SELECT session_id, user_id, province, city, region, url, event_time, next_time FROM setters
        WHERE next_id = 'page_load'""",
    "dwell": f"""
        SELECT {day('load_time')} AS dt, user_id, session_id, province, city, region, url,
               load_time AS page_start_time, max(event_time) AS page_end_time
        FROM visits WHERE url IS NOT NULL GROUP BY ALL""",
    "plays": """
        SELECT *, sum(CASE WHEN event_id = 'video_resume' THEN 1 ELSE 0 END)
                      OVER (PARTITION BY play_id ORDER BY event_time) AS part_no
        FROM dwd WHERE event_id IN ('video_play', 'video_hb', 'video_pause', 'video_resume', 'video_stop')""",
    "parts": """
        SELECT *, first_value(event_time) OVER (PARTITION BY play_id, part_no ORDER BY event_time) AS part_start
        FROM plays""",
    "lines": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, CASE WHEN user_id % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
               CAST(18 + user_id % 50 AS INTEGER) AS age, action_time // 1000 AS action_time
        FROM base""",
}

NEEDS = {
    "ods": ["base"], "cells": ["areas"], "dim_geo": ["cells"], "lines": ["base"],
    "dwd": ["ods", "dim_user", "dim_geo", "dim_page"], "user_latest": ["user_changes"], "promo": ["dwd"],
    "page_uv": ["dwd"], "olap": ["dwd"], "gaps": ["dwd"], "islands": ["gaps"], "loads": ["islands"],
    "setters": ["islands"], "visits": ["loads", "setters"], "dwell": ["visits"], "plays": ["dwd"], "parts": ["plays"],
}


def _ordered(names: list[str], done: list[str]) -> list[str]:
    for name in names:
        if name not in done:
            _ordered(NEEDS.get(name, []), done)
            done.append(name)
    return done


def sql(body: str, *parts: str) -> str:
    """``body`` behind the named common table expressions and what they need."""
    ctes = ",\n".join(f"{name} AS ({PARTS[name]})" for name in _ordered(list(parts), []))
    return f"WITH {ctes}\n{body}" if ctes else body


def _windows(start: str, width: int) -> str:
    return f"{clock(start)} AS window_start, {clock(f'({start} + {width})')} AS window_end"


DAY_MS = f"(d * {DAY} - {OFFSET})"
SLICES = ", ".join(
    f"{trunk('minute_ms', m)} AS {n}" for n, m in
    (("time_trunk_1m", 1), ("time_trunk_5m", 5), ("time_trunk_10m", 10), ("time_trunk_30m", 30), ("time_trunk_1h", 60)))


def _rollup(keys: str) -> str:
    return sql(f"""
        SELECT {keys}, CAST(sum(pv) AS BIGINT) AS pv, count(DISTINCT user_id) AS uv,
               count(DISTINCT session_id) AS session_cnt FROM olap GROUP BY ALL""", "olap")


JSON_TEXT = """'{' || concat_ws(',', '"url":"' || url || '"', '"video_id":"' || video_id || '"',
                                '"play_id":"' || play_id || '"') || '}'"""

def _stored(name: str, *columns: str) -> str:
    key = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"""
        SELECT '{name}' AS rollup, concat_ws('|', {key}) AS key, CAST(sum(pv) AS BIGINT) AS pv, count(DISTINCT user_id) AS uv
        FROM olap GROUP BY ALL"""


ORACLES = {
    "traffic_5m": sql(f"""
        SELECT {_windows('start_ms', 300_000)}, pv_amt, uv_amt, ses_amt FROM (
            SELECT event_time - event_time % 300000 AS start_ms,
                   CAST(sum(CASE WHEN event_id = 'page_load' THEN 1 ELSE 0 END) AS BIGINT) AS pv_amt,
                   count(DISTINCT user_id) AS uv_amt, count(DISTINCT session_id) AS ses_amt
            FROM dwd GROUP BY 1)""", "dwd"),
    "traffic_today": sql(f"""
        SELECT {clock(DAY_MS)} AS window_start, {clock(f'({DAY_MS} + step * 300000)')} AS window_end,
               CAST(sum(CASE WHEN event_id = 'page_load' THEN 1 ELSE 0 END) AS BIGINT) AS pv_amt,
               count(DISTINCT user_id) AS uv_amt, count(DISTINCT session_id) AS ses_amt
        FROM (SELECT *, (event_time + {OFFSET}) // {DAY} AS d, (event_time + {OFFSET}) % {DAY} AS in_day FROM dwd)
             JOIN steps ON in_day < step * 300000
        GROUP BY d, step""", "dwd", "steps"),
    "promotion_today": sql(f"""
        SELECT {clock(DAY_MS)} AS window_start, {clock(f'({DAY_MS} + step * 300000)')} AS window_end,
               promotion_page_name, register_province AS province,
               count(*) AS pv_amt, count(DISTINCT user_id) AS uv_amt, count(DISTINCT new_user_id) AS new_uv_amt
        FROM (SELECT *, (event_time + {OFFSET}) // {DAY} AS d, (event_time + {OFFSET}) % {DAY} AS in_day FROM promo)
             JOIN steps ON in_day < step * 300000
        GROUP BY d, step, promotion_page_name, register_province""", "promo", "steps"),
    "top_pages_overall": sql(f"""
        SELECT {_windows('start_ms', 300_000)}, page_type, page_url, uv_amt FROM (
            SELECT *, row_number() OVER (PARTITION BY page_type ORDER BY uv_amt DESC, start_ms,
                                         page_url NULLS FIRST) AS rn FROM page_uv)
        WHERE rn < 10""", "page_uv"),
    "top_pages_per_window": sql(f"""
        SELECT {_windows('start_ms', 300_000)}, page_type, page_url, uv_amt FROM (
            SELECT *, row_number() OVER (PARTITION BY start_ms, page_type ORDER BY uv_amt DESC,
                                         page_url NULLS FIRST) AS rn FROM page_uv)
        WHERE rn < 10""", "page_uv"),
    "dwd_detail": sql(f"""
        SELECT province AS gps_province, city AS gps_city, region AS gps_region, {day('event_time')} AS dt, user_id,
               username, session_id, event_id, event_time, lat, lng, release_channel, device_type,
               {JSON_TEXT} AS properties, register_phone, user_status,
               strftime(register_time, '%Y-%m-%d %H:%M:%S') AS register_time, register_gender, register_birthday,
               register_province, register_city, register_job, register_source_type, page_type, page_service
        FROM dwd""", "dwd"),
    "lookup_miss_counts": sql(f"""
        SELECT {day('event_time')} AS dt, count(*) AS events, count(*) FILTER (user_id IS NULL) AS no_user,
               count(*) FILTER (province IS NULL) AS no_area, count(*) FILTER (page_type IS NULL) AS no_page
        FROM dwd GROUP BY 1""", "dwd"),
    "user_dim": sql("""
        SELECT username, id, status FROM
            (SELECT *, row_number() OVER (PARTITION BY username ORDER BY seq DESC, id DESC) AS rn FROM user_latest)
        WHERE rn = 1""", "user_latest"),
    "video_dim": sql("""
        SELECT id, video_name, video_type, video_album, video_author, video_timelong FROM
            (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM video_changes)
        WHERE rn = 1 AND op <> 'd'""", "video_changes"),
    "geo_dim": sql("SELECT geohash, province, city, region FROM dim_geo", "dim_geo"),
    "traffic_olap_1m": sql(f"""
        SELECT {day('minute_ms')} AS dt, {SLICES}, province, city, region, device_type, release_channel, page_url,
               page_type, page_service, is_new, pv, user_id, session_id FROM olap""", "olap"),
    "traffic_rollup_province_1h": _rollup(
        f"{day('minute_ms')} AS dt, {trunk('minute_ms', 60)} AS time_trunk_1h, province"),
    "traffic_rollup_page_30m": _rollup(
        f"{day('minute_ms')} AS dt, {trunk('minute_ms', 30)} AS time_trunk_30m, page_type, page_url"),
    "traffic_rollup_terminal_10m": _rollup(
        f"{day('minute_ms')} AS dt, {trunk('minute_ms', 10)} AS time_trunk_10m, device_type, release_channel"),
    "traffic_rollup_new_5m": _rollup(
        f"{day('minute_ms')} AS dt, {trunk('minute_ms', 5)} AS time_trunk_5m, is_new"),
    "traffic_rollup_day": _rollup(f"{day('minute_ms')} AS dt"),
    "bitmap_users_day": sql(f"""
        SELECT {day('event_time')} AS dt, count(*) AS pv, count(DISTINCT user_id) AS uv FROM dwd GROUP BY 1""", "dwd"),
    "sessions_hll_day": sql(f"""
        SELECT {day('action_time')} AS dt, count(DISTINCT session_id) AS sessions, TRUE AS within_5_percent
        FROM ods GROUP BY 1""", "ods"),
    "page_dwell": sql("SELECT * FROM dwell", "dwell"),
    "page_dwell_per_page": sql(f"""
        SELECT dt, page_url, count(*) AS visits, CAST(sum(ms) AS BIGINT) AS dwell_ms FROM (
            SELECT dt, {page_url('url')} AS page_url, max(page_end_time) - page_start_time AS ms
            FROM dwell WHERE page_start_time IS NOT NULL GROUP BY dt, user_id, session_id, url, page_start_time)
        GROUP BY dt, page_url""", "dwell"),
    "video_segments": sql(f"""
        SELECT {day('part_start')} AS dt, user_id, session_id, province, city, region, CAST(video_id AS BIGINT) AS video_id,
               p_name AS video_title, p_type AS video_type, p_brand AS video_album, author AS video_author,
               len AS video_time_amt, play_id, CAST(part_no AS BIGINT) AS part_no, part_start AS partial_start_time,
               max(event_time) AS partial_end_time
        FROM parts LEFT JOIN dim_video v ON CAST(video_id AS BIGINT) = v.id
        GROUP BY ALL""", "parts", "dim_video"),
    "running_sum_then_window": sql(f"""
        SELECT {_windows('s * 1000', 5_000)}, gender, count(DISTINCT user_id) AS uv, count(*) AS pv,
               CAST(sum(action_time) AS BIGINT) AS sum_action_time, CAST(max(sum_age) AS BIGINT) AS sum_age
        FROM (SELECT *, action_time - action_time % 5 AS s,
                     sum(age) OVER (PARTITION BY gender ORDER BY action_time) AS sum_age FROM lines)
        GROUP BY s, gender""", "lines"),
    "merged_ranking": sql(f"""
        SELECT {_windows('start_ms', 300_000)}, page_type, page_url, uv_amt FROM (
            SELECT *, row_number() OVER (PARTITION BY page_type ORDER BY uv_amt DESC, start_ms,
                                         page_url NULLS FIRST) AS rn FROM page_uv)
        WHERE rn < 10""", "page_uv"),
    "change_rows": sql("SELECT op, seq, id, username, status FROM user_changes", "user_changes"),
    "line_rows": sql("SELECT user_id, gender, age, action_time FROM lines", "lines"),
    "event_clock": sql("""
        SELECT seq, strftime(make_timestamp(action_time * 1000), '%Y-%m-%d %H:%M:%S.%g') AS event_clock
        FROM ods""", "ods"),
    "retained_partitions": sql("""
        SELECT dt, count(*) AS events FROM (SELECT """ + day("action_time") + """ AS dt FROM ods)
        WHERE dt >= (SELECT max(""" + day("action_time") + """) FROM ods) - 1 GROUP BY dt""", "ods"),
    "event_rows": sql("""
        SELECT username, session_id, event_id, action_time, lat, lng, release_channel, device_type, url
        FROM ods""", "ods"),
    "geohash_cells": sql(f"""
        SELECT lat, lng, {geohash('lat', 'lng')} AS geohash, reverse({geohash('lat', 'lng')}) AS reversed,
               count(*) AS events FROM ods GROUP BY lat, lng""", "ods"),
    "time_slices": sql(f"""
        SELECT seq, {day('minute_ms')} AS dt, {SLICES}, CAST(((minute_ms + {OFFSET}) % {DAY}) // 300000 + 1 AS INTEGER)
               AS step, {day('minute_ms')} AS wall_date
        FROM (SELECT seq, action_time AS minute_ms FROM ods)""", "ods"),
    "url_parts": sql(f"""
        SELECT url, {page_url('url')} AS page_url, {url_prefix('url')} AS url_prefix, count(*) AS events
        FROM ods GROUP BY url""", "ods"),
    "properties_json": sql(f"""
        SELECT seq, {JSON_TEXT} AS properties, CAST(video_id AS BIGINT) AS video_id FROM ods""", "ods"),
    "user_lookup": sql("""
        SELECT user_id, register_province, register_job, user_status, count(*) AS events FROM dwd GROUP BY ALL""", "dwd"),
    "area_lookup": sql("""
        SELECT province AS gps_province, city AS gps_city, region AS gps_region, count(*) AS events
        FROM dwd GROUP BY ALL""", "dwd"),
    "page_lookup": sql("SELECT page_type, page_service, count(*) AS events FROM dwd GROUP BY ALL", "dwd"),
    "area_hierarchy": sql("SELECT geohash, province, city, region FROM cells", "cells"),
    "latest_user_changes": sql("SELECT op, seq, id, username, status FROM user_latest", "user_latest"),
    "promotion_loads": sql("""
        SELECT promotion_page_name, user_id, new_user_id, count(*) AS events FROM promo GROUP BY ALL""", "promo"),
    "page_uv_5m": sql(f"""
        SELECT {_windows('start_ms', 300_000)}, page_type, page_url, uv_amt FROM page_uv""", "page_uv"),
    "marked_visits": sql("""
        SELECT session_id, url, load_time AS page_load_time, event_time, count(*) AS events
        FROM visits GROUP BY ALL""", "visits"),
    "play_parts": sql("""
        SELECT seq, play_id, CAST(part_no AS BIGINT) AS part_no, part_start AS part_start_time FROM parts""", "parts"),
    "running_sum_by_gender": sql("""
        SELECT user_id, gender, age, action_time,
               CAST(sum(age) OVER (PARTITION BY gender ORDER BY action_time) AS BIGINT) AS sum_age FROM lines""", "lines"),
    "running_loads_by_session": sql("""
        SELECT seq, session_id, event_id, action_time,
               CAST(sum(CASE WHEN event_id = 'page_load' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY session_id ORDER BY action_time) AS BIGINT) AS loads FROM ods""", "ods"),
    "merged_bitmap_users": sql(f"""
        SELECT {day('event_time')} AS dt, release_channel, count(*) AS pv, count(DISTINCT user_id) AS uv
        FROM dwd GROUP BY 1, 2""", "dwd"),
    "sparse_users_day": sql(f"""
        SELECT {day('event_time')} AS dt, count(*) AS pv, count(DISTINCT user_id) AS uv FROM dwd GROUP BY 1""", "dwd"),
    "stored_rollups": sql(" UNION ALL ".join([
        _stored("province_1h", day("minute_ms"), trunk("minute_ms", 60), "province"),
        _stored("page_30m", day("minute_ms"), trunk("minute_ms", 30), "page_type", "page_url"),
        _stored("terminal_10m", day("minute_ms"), trunk("minute_ms", 10), "device_type", "release_channel"),
        _stored("new_5m", day("minute_ms"), trunk("minute_ms", 5), "is_new"), _stored("day", day("minute_ms")),
        _stored("region_new", "region", "is_new")]), "olap"),
    "merged_dwell_loads": sql("""
        SELECT user_id, session_id, url, load_time AS page_start_time, max(event_time) AS page_end_time
        FROM visits WHERE url IS NOT NULL GROUP BY ALL""", "visits"),
    "streamed_traffic_loads": sql(f"""
        SELECT CAST({day('minute_ms')} AS VARCHAR) AS dt, count(*) AS loaded, CAST(sum(pv) AS BIGINT) AS pv,
               count(DISTINCT user_id) AS uv FROM olap GROUP BY 1""", "olap"),
    "streamed_late_rows": sql("""
        SELECT CAST(1 AS BIGINT) AS batch_id, event_id, count(*) AS late_rows FROM ods
        WHERE seq % 7 = 3 AND action_time < (SELECT max(action_time) FROM ods WHERE seq % 7 <> 3) GROUP BY event_id""", "ods"),
}
# What a streaming job stores is what its plan gives over the whole table.
ORACLES |= {f"streamed_{name}": ORACLES[of] for name, of in (
    ("traffic_5m", "traffic_5m"), ("traffic_today", "traffic_today"), ("running_sum", "running_sum_then_window"))}
