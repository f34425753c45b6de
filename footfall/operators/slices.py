"""Ordered per-key work when one key may hold a large share of all rows.

``OVER (PARTITION BY key ORDER BY time)`` puts a key in one task. Here a hot key is cut into time slices, each its own
window partition. What a slice must know of the slices before it arrives as one *seed* row that sorts before its
rows; the seeds come from one summary row per slice. Ordinary keys stay whole (slice -1) and have no seeds, so they
pay one shuffle as before.

A micro-batch continues where the last one stopped in the same way: the state carried over enters as seed rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.clock import floor_to

SLICE = "__slice"
HOT_ROWS = "__hot_rows"
SEED = "__seed"
WHOLE = -1
SECOND_MS = 1000
MOST_CUTS = 100_000

Slicer = Callable[[DataFrame], DataFrame]


def _places_in(cuts: Column, time: Column) -> Column:
    """How many of the ordered ``cuts`` are at or before ``time``, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in range(MOST_CUTS.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(cuts, at + step - 1) <= time, at + step).otherwise(at))


def slice_hot_keys(key: str, time_ms: str, counted: DataFrame | None = None, min_rows: int = 1_000_000,
                   share: float = 1 / MOST_CUTS) -> Slicer:
    """Adds ``__slice`` and ``__hot_rows`` (NULL for an ordinary key).

    A key is hot from ``min_rows`` rows and ``share`` of all rows on, say n rows; at most ``1 / share`` keys hold such a
    share. It is cut in time order at n rows or a little later: its rows are counted by second, and by millisecond in
    seconds that hold more than n, so a slice has at most 2 n rows unless one time has more. All keys together have at
    most ``1 / share`` cuts, which bounds the broadcast list whatever the data. ``counted`` may name a narrower
    input with the same keys and times to count on.
    """
    def cut(rows: DataFrame) -> DataFrame:
        source = (rows if counted is None else counted).select(F.col(key).alias("__key"), F.col(time_ms).alias("__at"))
        counts = source.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"))
        enough = counts.agg(F.greatest(F.lit(min_rows), F.ceil(F.coalesce(F.sum("__n"), F.lit(0)) * F.lit(share)))
                            .cast("long").alias("n"))
        hot = counts.where(F.col("__n") >= enough.scalar())

        def of(keys: DataFrame) -> DataFrame:
            other = keys.select(F.col("__key").alias("__hot_key"), *[c for c in keys.columns if c == "__second"])
            same = F.col("__key").eqNullSafe(F.col("__hot_key"))
            if "__second" in keys.columns:
                same = same & (floor_to(F.col("__at"), SECOND_MS) == F.col("__second"))
            return source.join(F.broadcast(other), same).select("__key", "__at")

        seconds = of(hot).groupBy("__key", floor_to(F.col("__at"), SECOND_MS).alias("__second")).agg(
            F.count(F.lit(1)).alias("__n"))
        dense = F.col("__n") > enough.scalar()
        pieces = seconds.where(~dense).withColumnRenamed("__second", "__at").unionByName(
            of(seconds.where(dense).select("__key", "__second")).groupBy("__key", "__at").agg(
                F.count(F.lit(1)).alias("__n")))
        in_order = Window.partitionBy("__key").orderBy("__at")
        before = F.coalesce(F.sum("__n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        numbered = pieces.withColumn("__no", F.floor(before / enough.scalar()))
        cuts = numbered.withColumn("__last", F.lag("__no").over(in_order)).where("__no > __last").groupBy("__key").agg(
            F.sort_array(F.collect_list("__at")).alias("__cuts")).withColumnRenamed("__key", "__cut_key")
        table = hot.join(cuts, F.col("__key").eqNullSafe(F.col("__cut_key")), "left").select(
            "__key", F.col("__n").alias(HOT_ROWS), F.coalesce("__cuts", F.array().cast("array<bigint>")).alias("__cuts"))
        marked = rows.join(F.broadcast(table), F.col(key).eqNullSafe(F.col("__key")), "left")
        number = F.when(F.col(HOT_ROWS).isNotNull(), _places_in(F.col("__cuts"), F.col(time_ms))).otherwise(F.lit(WHOLE))
        return marked.withColumn(SLICE, number.cast("long")).drop("__key", "__cuts")

    return cut


MERGE = {"sum": F.sum, "min": F.min, "max": F.max}
# New column -> (sum, min or max; input expression).
Measures = dict[str, tuple[str, Column]]


def _inputs(rows: DataFrame, key: str, time_ms: str, measures: Measures, carried: DataFrame | None) -> DataFrame:
    inputs = rows.select("*", F.lit(False).alias(SEED),
                         *[value.alias(f"__in_{name}") for name, (_, value) in measures.items()])
    if carried is None:
        return inputs
    return inputs.unionByName(carried.select(
        key, time_ms, F.lit(True).alias(SEED), *[F.col(name).alias(f"__in_{name}") for name in measures],
    ), allowMissingColumns=True)


def running(rows: DataFrame, key: str, time_ms: str, measures: Measures, cut: Slicer,
            carried: DataFrame | None = None) -> DataFrame:
    """Add running aggregates over (``key`` ordered by ``time_ms``), rows of one time sharing a value.

    ``time_ms`` must not be NULL: NULL marks the seeds of slices and sorts first. ``carried`` holds, per key, the time
    and the measures reached before (``running_state`` of the rows before these).
    """
    sliced = cut(_inputs(rows, key, time_ms, measures, carried))
    summary = sliced.where(F.col(HOT_ROWS).isNotNull()).groupBy(key, SLICE).agg(
        *[MERGE[kind](f"__in_{name}").alias(f"__in_{name}") for name, (kind, _) in measures.items()])
    before = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    seeds = summary.select(
        key, SLICE, F.lit(True).alias(SEED),
        *[MERGE[kind](f"__in_{name}").over(before).alias(f"__in_{name}")
          for name, (kind, _) in measures.items()])
    upto = Window.partitionBy(key, SLICE).orderBy(time_ms)
    return sliced.unionByName(seeds, allowMissingColumns=True).select(
        *rows.columns, SEED,
        *[MERGE[kind](f"__in_{name}").over(upto).alias(name) for name, (kind, _) in measures.items()],
    ).where(~F.col(SEED)).drop(SEED)


def running_state(rows: DataFrame, key: str, time_ms: str, measures: Measures,
                  carried: DataFrame | None = None) -> DataFrame:
    """Per key the last time and the measures reached, to be carried into later rows."""
    return _inputs(rows, key, time_ms, measures, carried).groupBy(key).agg(
        F.max(time_ms).alias(time_ms),
        *[MERGE[kind](f"__in_{name}").alias(name) for name, (kind, _) in measures.items()])

