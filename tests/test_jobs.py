"""The job runner end to end on files: raw events to dwell, rankings, compaction and retention."""

import json

from pyspark.sql import functions as F

from footfall import samples
from footfall.jobs import JOBS, main
from footfall.plans import dashboards, dimensions, olap
from footfall.functions.clock import DAY_MS
from footfall.sinks.partitions import NO_DAY, matching, partition_days
from footfall.sinks.snapshots import current, publish
from footfall.streaming.carried import late_counts
from tests.conftest import rows_of
from tests.test_streaming import drop_file


CLOCK = ("clock1", "clock2")


def run(spark, job, **settings):
    query = JOBS[job](spark, **settings)
    if query is not None:
        query.awaitTermination()


def test_chain(spark, sf, tmp_path):
    """Dimensions are built, raw events widened, and the wide stream feeds the next jobs."""
    at = {n: str(tmp_path / n) for n in ("raw", "areas", "users_in", "videos_in", "users", "geo", "pages", "videos", "wide",
                                         "detail", "notes", "bad", "dwell", "segments", "pages5", "merged")}
    samples.areas(spark, sf).write.parquet(at["areas"])
    run(spark, "build_geo_dim", source={"path": at["areas"]}, out=at["geo"])
    known = samples.user_rows(spark, sf).where("id % 10 <> 9").select(F.lit("c").alias("op"), F.lit(1).alias("seq"), "*")
    known.write.json(at["users_in"])
    run(spark, "sync_user_dim", source={"path": at["users_in"]}, state=str(tmp_path / "us"), out=at["users"],
        checkpoint=str(tmp_path / "ck1"))
    samples.video_changes(spark, sf).write.json(at["videos_in"])
    run(spark, "sync_video_dim", source={"path": at["videos_in"]}, state=str(tmp_path / "vs"), out=at["videos"],
        checkpoint=str(tmp_path / "ck2"))
    videos = dimensions.video_dim(dimensions.fold_changes(samples.video_changes(spark, sf)))
    assert rows_of(current(spark, at["videos"])) == rows_of(videos)
    publish(samples.dim_page(spark), at["pages"], 0)

    raw = samples.ods(spark, sf).orderBy("action_time", "seq").drop("seq").select(F.to_json(F.struct("*")).alias("v"))
    lines = [r.v for r in raw.collect()]
    # Two events far ahead: the first moves the clock on, so that all rows before it have their turn.
    ahead = json.loads(lines[-1])["action_time"] + 40 * DAY_MS
    lines += [json.dumps({"session_id": s, "event_id": "x", "action_time": ahead + n * DAY_MS}) for n, s in enumerate(CLOCK)]
    size = len(lines) // 3 + 1
    for number in range(3):
        drop_file(tmp_path / "raw", number, lines[number * size:(number + 1) * size] + ["no json"])
    run(spark, "widen_events", source={"path": at["raw"], "files_per_trigger": 1}, checkpoint=str(tmp_path / "ck3"),
        wait_s=0, **{n: at[n] for n in ("users", "geo", "pages", "wide", "detail", "notes", "bad")})
    dwd = samples.dwd(spark, sf, users=True, geo=True, pages=True).persist()
    assert spark.read.parquet(at["detail"]).count() == dwd.count() + len(CLOCK)
    assert spark.read.parquet(at["bad"]).count() == 3

    stream = {"path": f"{at['wide']}/batch_id=*", "files_per_trigger": 1}
    run(spark, "page_dwell", source=stream, out=at["dwell"], checkpoint=str(tmp_path / "ck4"), delay_ms=DAY_MS)
    expected = olap.page_dwell(dwd, ["seq"])
    intervals = spark.read.parquet(f"{at['dwell']}/intervals")
    loaded = olap.merge_max(intervals.where(~F.col("session_id").isin(*CLOCK)), olap.DWELL_KEYS, "page_end_time")
    assert rows_of(loaded, *expected.columns) == rows_of(expected)
    run(spark, "video_segments", source=stream, videos=at["videos"], out=at["segments"],
        checkpoint=str(tmp_path / "ck5"), delay_ms=DAY_MS)
    expected = olap.video_segments(dwd, videos)
    segments = olap.merge_max(spark.read.parquet(f"{at['segments']}/segments"), olap.VIDEO_KEYS, "partial_end_time")
    assert rows_of(segments, *expected.columns) == rows_of(expected)
    for table in ("dwell", "segments"):
        assert sum(r["rows"] for r in late_counts(spark, at[table]).collect()) == 0

    path = f"{at['dwell']}/intervals"
    for day in ("2024-01-02", "none"):
        run(spark, "compact", table="dwell", path=path, day=day, out=at["merged"])
    merged = spark.read.parquet(at["merged"]).where(~F.col("session_id").isin(*CLOCK))
    assert merged.count() == loaded.where("dt = '2024-01-02' or dt is null").count()
    assert merged.where("dt is null").count() > 0
    run(spark, "retire", table="dwell", path=path, today="2024-04-02")
    assert [d for d in partition_days(spark, path) if d[:4] == "2024"][0] == "2024-01-03"
    assert partition_days(spark, path)[-1] == NO_DAY
    run(spark, "retire", table="dwell", path=path, today="2199-01-01")
    assert matching(spark, f"{path}/dt=*/batch_id=*") == []


def test_ranking_per_window_from_settings_file(spark, sf, tmp_path):
    """Through ``main``; the windows closed within the stream equal the batch ranking."""
    dwd = samples.dwd(spark, sf, users=True, pages=True)
    lines = [r.v for r in dwd.orderBy("event_time").select(F.to_json(F.struct(
        "user_id", "event_time", "properties", "page_type")).alias("v")).collect()]
    drop_file(tmp_path / "in", 0, lines)
    drop_file(tmp_path / "in", 1, [json.dumps({"event_time": 1_704_067_200_000 + 30 * 86_400_000})])
    settings = tmp_path / "job.json"
    settings.write_text(json.dumps({"source": {"path": str(tmp_path / "in")}, "out": str(tmp_path / "out"),
                                    "checkpoint": str(tmp_path / "ck"), "n": 2}))
    main(["top_pages_per_window", str(settings)])
    out = spark.read.parquet(str(tmp_path / "out")).drop("batch_id")
    assert rows_of(out) == rows_of(dashboards.top_pages_per_window(dwd, 2))
