"""Wall time of the registered jobs: one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the warm runs per query (their median is
reported), ``BENCH_QUERIES`` a comma-separated choice. Results are computed in full and thrown away (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import QUERIES  # noqa: E402
from footfall.session import build_session  # noqa: E402

JOBS = [
    "traffic_5m", "traffic_today", "promotion_today", "top_pages_overall", "top_pages_per_window", "dwd_detail",
    "geo_dim", "user_dim", "video_dim", "traffic_olap_1m", "traffic_rollup_province_1h", "traffic_rollup_page_30m",
    "traffic_rollup_day", "bitmap_users_day", "sessions_hll_day", "page_dwell", "page_dwell_per_page",
    "video_segments", "running_sum_by_gender", "running_sum_then_window",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or JOBS
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(timed(spark, name, sf_dir), 3)
        warm[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3) if runs else cold[name]
    print(json.dumps({
        "metric": "total warm wall time of the jobs", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "first_run": cold, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
