"""Ordered per-key work on a stream: the batch operators, continued from carried state.

A micro-batch runs the same window expressions as the batch job, with the state of earlier batches as seed rows, so a
hot session or play is sliced here as well. The state is a snapshot per batch.

Rows need not arrive in event-time order. The clock is the newest event time seen; rows newer than the clock less a
tolerated delay wait, and are worked on in time order once the clock has passed them. Rows that come later than that,
and rows without a time, go to the table ``late``, by batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.dwell import KEY as SESSION
from footfall.operators.dwell import TTL_MS, open_pages, order_events, visits_of
from footfall.operators.segments import KEY as PLAY
from footfall.operators.segments import mark_segments, play_state
from footfall.operators.slices import Slicer, running_state
from footfall.plans.exploration import WINDOW_S, age_sum, running_sum, timed_lines, window_start, windows_of
from footfall.plans.olap import PAGE_COLUMNS, dwell_intervals, merge_segments, name_videos, page_rows, play_rows
from footfall.sinks.partitions import BATCH, write_batch
from footfall.sinks.snapshots import buckets_of, current, publish, read_buckets, write_buckets
from footfall.sources.events import POSITION, placed_in


def _in_order(rows: DataFrame, time: str, path: str, batch_id: int, delay: int) -> tuple[DataFrame, Column]:
    """The rows whose turn it is, and the time up to which all is done; ``delay`` is in units of ``time``."""
    spark = rows.sparkSession
    before = current(spark, f"{path}/clock", below=batch_id)
    seen, done = rows.agg(F.max(time).alias("ms")), F.lit(-1 << 62)
    if before is not None:
        seen = seen.unionByName(before).agg(F.max("ms").alias("ms"))
        done = F.coalesce(before.scalar() - F.lit(delay), done)
    upto = publish(seen.coalesce(1), f"{path}/clock", batch_id).scalar() - F.lit(delay)
    in_time = F.col(time) >= done
    write_batch(rows.where(~F.coalesce(in_time, F.lit(False))), f"{path}/late", batch_id, day=None)
    rows = rows.where(in_time)
    if delay:
        waiting = current(spark, f"{path}/waiting", below=batch_id)
        rows = rows if waiting is None else rows.unionByName(waiting)
        publish(rows.where(F.col(time) > upto), f"{path}/waiting", batch_id)
        rows = rows.where(F.col(time) <= upto)
    return rows, upto


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """Late rows per batch of the job that writes to ``path``."""
    rows = spark.read.schema(f"{BATCH} BIGINT").parquet(f"{path}/late")
    return rows.groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows"))


def dwell_batch(dwd: DataFrame, batch_id: int, path: str, ties: tuple[str, ...] = (POSITION,),
                cut: Slicer | None = None, delay_ms: int = 0) -> None:
    """Add one batch's page intervals to ``path/intervals``; ``merge_max`` reads them.

    Events of one session and time come in the order of their positions in the source. Open pages lie in buckets by
    session: those of the batch's sessions are read and written, and only these sessions' pages go through the
    windows. Lapsed pages leave with the next batch that touches their bucket; until then they are not continued.
    """
    spark = dwd.sparkSession
    rows, clock = _in_order(placed_in(dwd, batch_id), "event_time", path, batch_id, delay_ms)
    pages = page_rows(rows, ties)
    touched = buckets_of(pages, SESSION)
    schema = open_pages(order_events(spark.createDataFrame([], pages.schema), PAGE_COLUMNS, ties)).schema
    known = read_buckets(spark, f"{path}/open", schema, batch_id, touched)
    mine = pages.select(F.col(SESSION).alias("__session")).distinct()
    same = F.col(SESSION).eqNullSafe(F.col("__session"))
    ordered = order_events(pages, PAGE_COLUMNS, ties, cut=cut, carried=known.join(mine, same, "left_semi")).persist()
    try:
        write_batch(dwell_intervals(visits_of(ordered, PAGE_COLUMNS)), f"{path}/intervals", batch_id)
        silent = known.join(mine, same, "left_anti").where(clock - F.col("event_time") < F.lit(TTL_MS))
        write_buckets(open_pages(ordered, clock).unionByName(silent), f"{path}/open", SESSION, batch_id, touched)
    finally:
        ordered.unpersist()


def video_batch(dwd: DataFrame, videos: DataFrame, batch_id: int, path: str, idle_ms: int | None = None,
                cut: Slicer | None = None, delay_ms: int = 0) -> None:
    """Add one batch's segments to ``path/segments``; ``merge_max`` reads them.

    Plays are remembered for ever, or for ``idle_ms`` after their last event; a batch touches only the buckets of state
    that its plays are in.
    """
    spark = dwd.sparkSession
    rows, clock = _in_order(dwd, "event_time", path, batch_id, delay_ms)
    plays = play_rows(rows)
    touched = buckets_of(plays, PLAY)
    schema = play_state(plays).schema
    known = read_buckets(spark, f"{path}/plays", schema, batch_id, touched)
    mine = plays.select(F.col(PLAY).alias("__play")).distinct()
    carried = known.join(mine, F.col(PLAY).eqNullSafe(F.col("__play")), "left_semi")
    segments = merge_segments(mark_segments(plays, cut, carried))
    write_batch(name_videos(segments, videos), f"{path}/segments", batch_id)
    state = play_state(plays, known)
    if idle_ms is not None:
        state = state.where(clock - F.col("event_time") < F.lit(idle_ms))
    write_buckets(state, f"{path}/plays", PLAY, batch_id, touched)


def running_sum_batch(lines: DataFrame, batch_id: int, path: str, delay_s: int = 0) -> None:
    """Add one batch's lines with the running sum of their gender to ``path/sums``."""
    spark = lines.sparkSession
    rows, _ = _in_order(lines, "action_time", path, batch_id, delay_s)
    carried = current(spark, f"{path}/state", below=batch_id)
    write_batch(running_sum(rows, carried), f"{path}/sums", batch_id, day=None)
    publish(running_state(timed_lines(rows), "gender", "ms", age_sum(), carried), f"{path}/state", batch_id)


def running_sum_windows_batch(lines: DataFrame, batch_id: int, path: str, delay_s: int = 0) -> None:
    """As ``running_sum_batch``, and the windows over the sums that have closed, once each, to ``path/windows``.

    Sums of windows that are still open are carried over.
    """
    spark = lines.sparkSession
    rows, upto = _in_order(lines, "action_time", path, batch_id, delay_s)
    carried = current(spark, f"{path}/state", below=batch_id)
    sums = running_sum(rows, carried).persist()
    try:
        write_batch(sums, f"{path}/sums", batch_id, day=None)
        publish(running_state(timed_lines(rows), "gender", "ms", age_sum(), carried), f"{path}/state", batch_id)
        open_before = current(spark, f"{path}/open", below=batch_id)
        known = sums if open_before is None else sums.unionByName(open_before)
        closed = window_start(F.col("action_time")) + F.lit(WINDOW_S) <= upto
        write_batch(windows_of(known.where(closed)), f"{path}/windows", batch_id, day=None)
        publish(known.where(~closed), f"{path}/open", batch_id)
    finally:
        sums.unpersist()


def start_carried(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Run ``step`` on every micro-batch, read once from the source."""

    def once(batch: DataFrame, batch_id: int) -> None:
        batch = (placed_in(batch, batch_id) if POSITION in batch.columns else batch).persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()
