"""Tumbling windows on streams of widened events.

Streams cannot count distinct keys directly. Each figure is two chained aggregations: first per (window, key), which
makes keys distinct and spreads the state over them, then per window. Both end when the watermark passes the window,
in append mode, so every window is emitted once and final. Rows later than that are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions import page_url, wall_clock
from footfall.plans.dashboards import page_loads, rank_overall, rank_per_window
from footfall.plans.olap import TRAFFIC_DIMENSIONS, time_keys, traffic_rows
from footfall.sinks.partitions import write_batch
from footfall.sinks.snapshots import current, publish
from footfall.sources.events import with_event_time

FIVE_MINUTES = "5 minutes"


def _bound(edge: str) -> Column:
    return wall_clock(F.unix_millis(F.col(f"window.{edge}")))


def _bounds() -> list[Column]:
    return [_bound("start").alias("window_start"), _bound("end").alias("window_end")]


def traffic_5m(dwd: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Page views, users and sessions per closed five minutes."""
    kinds = F.array(
        F.struct(F.lit("user").alias("kind"), F.col("user_id").cast("string").alias("key"), page_loads().alias("n")),
        F.struct(F.lit("session").alias("kind"), F.col("session_id").alias("key"), F.lit(0).cast("long").alias("n")))
    keys = with_event_time(dwd, delay=delay).select("row_time", F.explode(kinds).alias("k")).select("row_time", "k.*")
    per_key = keys.groupBy(F.window("row_time", FIVE_MINUTES), "kind", "key").agg(F.sum("n").alias("n"))
    per_window = per_key.groupBy("window").agg(
        F.sum("n").alias("pv_amt"),
        F.count(F.when(F.col("kind") == "user", F.col("key"))).alias("uv_amt"),
        F.count(F.when(F.col("kind") == "session", F.col("key"))).alias("ses_amt"))
    return per_window.select(*_bounds(), "pv_amt", "uv_amt", "ses_amt")


def page_uv_5m(dwd: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Users per page and closed five minutes."""
    pages = with_event_time(dwd, delay=delay).withColumn("page_url", page_url(F.col("properties")["url"]))
    per_user = pages.groupBy(F.window("row_time", FIVE_MINUTES), "page_type", "page_url", "user_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("window", "page_type", "page_url").agg(F.count("user_id").alias("uv_amt")) \
        .select(*_bounds(), "page_type", "page_url", "uv_amt")


def traffic_olap(dwd: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Events per minute, dimensions, user and session: rows to load into the aggregate table."""
    minutes = with_event_time(traffic_rows(dwd), delay=delay) \
        .groupBy(F.window("row_time", "1 minute"), *TRAFFIC_DIMENSIONS, "user_id", "session_id") \
        .agg(F.sum(F.lit(1).cast("long")).alias("pv"))
    return minutes.select(*time_keys(F.unix_millis(F.col("window.start"))), *TRAFFIC_DIMENSIONS, "pv", "user_id",
                          "session_id")


def running_sum_windows(lines: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """Users, lines and the sum of times per gender and closed five seconds."""
    timed = with_event_time(lines, "action_time", unit_ms=1000, delay=delay)
    per_user = timed.groupBy(F.window("row_time", "5 seconds"), "gender", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("action_time").alias("t"))
    return per_user.groupBy("window", "gender").agg(
        F.count("user_id").alias("uv"), F.sum("n").alias("pv"), F.sum("t").alias("sum_action_time")) \
        .select(*_bounds(), "gender", "uv", "pv", "sum_action_time")


def start_table(rows: DataFrame, path: str, checkpoint: str, day: str | None = None, trigger: dict | None = None,
                prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append closed windows to a table, repeatable per batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(prepare(batch) if prepare else batch, path, batch_id, day)

    return start_batches(rows, step, checkpoint, trigger)


def start_ranking(page_uv: DataFrame, tables: list[str], checkpoint: str, n: int,
                  trigger: dict | None = None) -> StreamingQuery:
    """Keep the n best (window, page) rows per page type in every one of ``tables``.

    The ranking itself is all the state there is: a batch of closed windows is ranked together with it, and rows that
    fall out disappear because the table is replaced.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        best = current(batch.sparkSession, tables[0], below=batch_id)
        ranked = rank_overall(batch if best is None else batch.unionByName(best), n)
        first = publish(ranked, tables[0], batch_id)
        for other in tables[1:]:
            publish(first, other, batch_id)

    return start_batches(page_uv, step, checkpoint, trigger)


def start_ranking_per_window(page_uv: DataFrame, path: str, checkpoint: str, n: int,
                             trigger: dict | None = None) -> StreamingQuery:
    """Append the n best pages per page type of every closed window; a window closes within one batch."""
    return start_table(page_uv, path, checkpoint, trigger=trigger, prepare=lambda batch: rank_per_window(batch, n))


def start_console(rows: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Print closed windows, for trying things out."""
    return rows.writeStream.outputMode("append").format("console").option("truncate", "false") \
        .trigger(**(trigger or {"availableNow": True})).start()


def start_batches(rows: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Run ``step`` on every batch of closed windows."""
    return rows.writeStream.outputMode("append").foreachBatch(step).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()
