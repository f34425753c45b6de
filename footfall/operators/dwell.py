"""Page visits of a session: which page an event belongs to, and when that page was left.

Per session in event order the job remembers the last page that was loaded (``page_load``) or resumed (``wake_up``).
Every event takes its load time from that page; a ``page_load`` also closes the page before it, by one extra row that
carries the old page's columns and the new page's time. The memory lapses when a session is silent for ``ttl_ms``.

As window expressions: the remembered page is the running maximum of a struct led by (event_time, ties); it counts
only if it is not older than the running maximum of the times at which a silence ended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.clock import MINUTE_MS
from footfall.operators.slices import HOT_ROWS, SEED, SLICE, Slicer, slice_hot_keys

TTL_MS = 30 * MINUTE_MS
LOAD = "page_load"
WAKE = "wake_up"
KEY = "session_id"
PAGE = "__page"


def _silence_end(time: Column, previous: Column, ttl_ms: int) -> Column:
    return F.when(time - previous >= F.lit(ttl_ms), time)


def _alive(page: Column, silence_end: Column) -> Column:
    return F.when(silence_end.isNull() | (page["event_time"] >= silence_end), page)


def order_events(events: DataFrame, page_columns: Sequence[str], ties: Sequence[str] = (), ttl_ms: int = TTL_MS,
                 cut: Slicer | None = None, carried: DataFrame | None = None) -> DataFrame:
    """Events with what their session remembered before them.

    ``events`` needs ``session_id``, ``event_id``, ``event_time``, ``ties`` (what orders equal times) and
    ``page_columns``. ``carried`` is ``open_pages`` of the events before these.
    """
    order = ["event_time", *ties]
    extra = [c for c in page_columns if c not in order]
    rows = events.where(F.col("event_time").isNotNull()).select(
        KEY, "event_id", *order, *extra, F.lit(False).alias(SEED),
        F.when(F.col("event_id").isin(LOAD, WAKE), F.struct(*order, *extra)).alias(PAGE))
    if carried is not None:
        rows = rows.unionByName(carried.withColumn(SEED, F.lit(True)), allowMissingColumns=True)
    sliced = (cut or slice_hot_keys(KEY, "event_time"))(rows)
    seeds = _seeds(sliced.where(F.col(HOT_ROWS).isNotNull()), order, ttl_ms)

    # What was carried over comes before the rows of its time.
    upto = Window.partitionBy(KEY, SLICE).orderBy(
        F.col("event_time").asc_nulls_first(), F.col(SEED).desc(), *[F.col(c).asc_nulls_first() for c in ties])
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    return sliced.unionByName(seeds, allowMissingColumns=True).select(
        "*", F.lag("event_time").over(upto).alias("__previous"), F.max(PAGE).over(before).alias("__last"),
    ).select(
        "*", F.max(_silence_end(F.col("event_time"), F.col("__previous"), ttl_ms)).over(
            upto.rowsBetween(Window.unboundedPreceding, 0)).alias("__silence_end"))


def visits_of(ordered: DataFrame, page_columns: Sequence[str]) -> DataFrame:
    """Rows (session, ``page_columns``, ``page_load_time``, ``event_time``) of all events and closing rows."""
    now = F.col("event_time")
    known = ordered.where(~F.col(SEED)).withColumn("__open", _alive(F.col("__last"), F.col("__silence_end")))
    own = F.struct(
        *page_columns,
        F.when(F.col(PAGE).isNotNull(), now).otherwise(F.col("__open.event_time")).alias("page_load_time"),
        now.alias("event_time"))
    closing = F.struct(
        *[F.col(f"__open.{c}").alias(c) for c in page_columns],
        F.col("__open.event_time").alias("page_load_time"),
        now.alias("event_time"))
    closes = (F.col("event_id") == LOAD) & F.col("__open").isNotNull()
    return known.select(KEY, F.explode(F.when(closes, F.array(own, closing)).otherwise(F.array(own))).alias("__v")) \
        .select(KEY, "__v.*")


def open_pages(ordered: DataFrame, clock_ms: Column | None = None, ttl_ms: int = TTL_MS) -> DataFrame:
    """What every session remembers after its last event: (session, time of that event, page).

    With ``clock_ms``, sessions silent for ``ttl_ms`` at that time are left out.
    """
    state = ordered.groupBy(KEY).agg(
        F.max("event_time").alias("event_time"), F.max(PAGE).alias(PAGE),
        F.max("__silence_end").alias("__silence_end"),
    ).select(KEY, "event_time", _alive(F.col(PAGE), F.col("__silence_end")).alias(PAGE))
    return state if clock_ms is None else state.where(clock_ms - F.col("event_time") < F.lit(ttl_ms))


def page_visits(events: DataFrame, page_columns: Sequence[str], ties: Sequence[str] = (), ttl_ms: int = TTL_MS,
                cut: Slicer | None = None) -> DataFrame:
    return visits_of(order_events(events, page_columns, ties, ttl_ms, cut), page_columns)


def _seeds(hot: DataFrame, order: Sequence[str], ttl_ms: int) -> DataFrame:
    """One row per slice of a hot key, holding the last event time and the open page of the slices before it."""
    inside = Window.partitionBy(KEY, SLICE).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    now = F.col("event_time")
    summary = hot.select(
        KEY, SLICE, "event_time", PAGE,
        _silence_end(now, F.lag("event_time").over(inside), ttl_ms).alias("__silence_end"),
    ).groupBy(KEY, SLICE).agg(
        F.min("event_time").alias("__first"), F.max("event_time").alias("__final"),
        F.max("__silence_end").alias("__silence_end"), F.max(PAGE).alias(PAGE))
    across = Window.partitionBy(KEY).orderBy(SLICE)
    upto = across.rowsBetween(Window.unboundedPreceding, 0)
    entered = summary.withColumn("__before", F.lag("__final").over(across))
    state = entered.select(
        KEY, SLICE, "__before",
        F.max(PAGE).over(upto).alias(PAGE),
        F.max(F.coalesce("__silence_end", _silence_end(F.col("__first"), F.col("__before"), ttl_ms)))
        .over(upto).alias("__silence_end"),
    ).withColumn(PAGE, _alive(F.col(PAGE), F.col("__silence_end")))
    return state.select(
        KEY, SLICE, F.col("__before").alias("event_time"), F.lag(PAGE).over(across).alias(PAGE),
        F.lit(True).alias(SEED),
    ).where(F.col("event_time").isNotNull())
