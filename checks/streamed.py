"""The streaming jobs as queries: events written as messages, streamed by a job with restarts, its table read back.

Messages come in chunks of event time. After every chunk the job runs until all is read, stops, and goes on from its
checkpoint with the next one; a last message closes the windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import samples
from footfall.functions.clock import DAY_MS
from footfall.jobs import JOBS, TRAFFIC_COLUMNS
from footfall.sinks.partitions import scratch_path
from footfall.streaming.cumulative import STEPS_PER_DAY, CumulativeJob

CHUNKS = 2
CLOCK_COLUMNS = ["user_id", "session_id", "event_id", "event_time"]


def _stream(job: str, chunks: list[DataFrame], path: str, **settings) -> str:
    """Run a job after each chunk of messages (one text column); where its tables are."""
    spark = chunks[0].sparkSession
    for chunk in chunks:
        chunk.write.mode("append").text(f"{path}/in")
        JOBS[job](spark, source={"path": f"{path}/in"}, out=f"{path}/out", checkpoint=f"{path}/checkpoint",
                  **settings).awaitTermination()
    return f"{path}/out"


def _by_time(rows: DataFrame, time: str, value, end_after: int, end) -> list[DataFrame]:
    """Messages ``value`` in chunks of equal spans of ``time``, and the message ``end(time)`` after the last.

    They are derived once and stored with their time, not once for the span and once for every chunk.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "messages")
    made = rows.select(F.col(time).alias("time"), value.alias("value"))
    made.write.parquet(path)
    made = spark.read.schema(made.schema).parquet(path)
    first, last = made.agg(F.min("time"), F.max("time")).first()
    if first is None:
        return [made.select("value")]
    span = (last - first) // CHUNKS + 1
    chunks = [made.where((F.col("time") >= first + k * span) & (F.col("time") < first + (k + 1) * span)) for k in range(CHUNKS)]
    closing = spark.range(1).select(end(F.lit(last + end_after)).alias("value"))
    return [chunk.select("value") for chunk in chunks] + [closing]


def _dwd_messages(spark: SparkSession, sf_dir: str, columns: list[str], **lookups) -> list[DataFrame]:
    def end(time):
        return F.to_json(F.struct(F.lit("end").alias("session_id"), F.lit("end").alias("event_id"), time.alias("event_time")))

    rows = samples.dwd(spark, sf_dir, **lookups).select(*columns)
    return _by_time(rows, "event_time", F.to_json(F.struct(*columns)), DAY_MS, end)


def streamed_traffic_5m(spark, sf_dir):
    """Closed windows of the job ``traffic_5m``, appended to its table."""
    out = _stream("traffic_5m", _dwd_messages(spark, sf_dir, CLOCK_COLUMNS, users=True), scratch_path(spark, "traffic_5m"))
    return spark.read.parquet(out).selectExpr(
        "string(window_start) AS window_start", "string(window_end) AS window_end", "pv_amt", "uv_amt", "ses_amt")


def streamed_traffic_today(spark, sf_dir):
    """Cumulative windows made from the increments that the job ``traffic_today`` stored."""
    out = _stream("traffic_today", _dwd_messages(spark, sf_dir, CLOCK_COLUMNS, users=True),
                  scratch_path(spark, "traffic_today"))
    job = CumulativeJob({}, "pv_amt", ["uv_amt", "ses_amt"], out)
    return job.dashboard(spark, closed_step=STEPS_PER_DAY).selectExpr(
        "string(window_start) AS window_start", "string(window_end) AS window_end", "pv_amt", "uv_amt", "ses_amt")


def streamed_traffic_loads(spark, sf_dir):
    """Rows, views and users per day of the loads that the job ``traffic_olap`` appended by day."""
    messages = _dwd_messages(spark, sf_dir, TRAFFIC_COLUMNS, users=True, geo=True, pages=True)
    out = _stream("traffic_olap", messages, scratch_path(spark, "traffic_olap"))
    return spark.read.parquet(out).groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("loaded"), F.sum("pv").alias("pv"), F.count_distinct("user_id").alias("uv"))


def streamed_running_sum(spark, sf_dir):
    """Closed windows over running sums of the job ``running_sum_then_window``, 10 seconds behind the newest line."""
    rows = samples.lines(spark, sf_dir)
    messages = _by_time(rows, "action_time", F.concat_ws(",", *rows.columns), 1000,
                        lambda time: F.concat(F.lit("x,x,x,1,"), time.cast("string")))
    out = _stream("running_sum_then_window", messages, scratch_path(spark, "running_sum"))
    return spark.read.parquet(f"{out}/windows").selectExpr(
        "string(window_start) AS window_start", "string(window_end) AS window_end", "gender", "uv", "pv",
        "sum_action_time", "sum_age")


def streamed_late_rows(spark, sf_dir):
    """Rows that the job ``page_dwell`` set aside as late, by batch and event: every seventh event comes in a second chunk."""
    columns = [*CLOCK_COLUMNS, "properties", "gps_province", "gps_city", "gps_region"]
    rows = samples.dwd(spark, sf_dir, users=True)
    behind = F.col("seq") % 7 == 3
    message = F.to_json(F.struct(*[c for c in columns if c in rows.columns])).alias("value")
    out = _stream("page_dwell", [rows.where(~behind).select(message), rows.where(behind).select(message)],
                  scratch_path(spark, "page_dwell"))
    return spark.read.parquet(f"{out}/late").groupBy(F.col("batch_id").cast("long").alias("batch_id"), "event_id").agg(
        F.count(F.lit(1)).alias("late_rows"))


STREAMED = {f.__name__: f for f in (
    streamed_traffic_5m, streamed_traffic_today, streamed_traffic_loads, streamed_running_sum, streamed_late_rows)}
