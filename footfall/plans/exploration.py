"""Running sum per gender, and five-second windows over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.clock import floor_to, wall_clock
from footfall.operators.slices import Measures, running, slice_hot_keys

WINDOW_S = 5


def timed_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("action_time").isNotNull()).withColumn("ms", F.col("action_time") * 1000)


def age_sum() -> Measures:
    return {"sum_age": ("sum", F.col("age").cast("long"))}


def running_sum(lines: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Each line with the sum of ages of its gender up to its second; genders are hot keys of large inputs."""
    return running(timed_lines(lines), "gender", "ms", age_sum(), slice_hot_keys("gender", "ms"), carried).drop("ms")


def window_start(time: Column) -> Column:
    return floor_to(time, WINDOW_S)


def windows_of(sums: DataFrame) -> DataFrame:
    """Users, lines, the sum of times and the last running sum, per gender and five seconds."""
    windows = sums.groupBy(window_start(F.col("action_time")).alias("start_s"), "gender").agg(
        F.count_distinct("user_id").alias("uv"), F.sum(F.lit(1).cast("long")).alias("pv"),
        F.sum("action_time").alias("sum_action_time"),
        F.max(F.struct("action_time", "sum_age"))["sum_age"].alias("sum_age"))
    return windows.select(
        wall_clock(F.col("start_s") * 1000).alias("window_start"),
        wall_clock((F.col("start_s") + WINDOW_S) * 1000).alias("window_end"),
        "gender", "uv", "pv", "sum_action_time", "sum_age")


def running_sum_then_window(lines: DataFrame) -> DataFrame:
    return windows_of(running_sum(lines))
