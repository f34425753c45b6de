"""Cumulative windows: from local midnight to every step of the day.

A row belongs to each window of its day that ends after it. Instead of copying a row into up to 288 windows, the
job keeps per step what is *new* in it (row sums, and keys seen for the first time that day) and adds the steps up.
One pass over the input feeds one shuffle: grouping sets bring the sums to (day, step) and each distinct key to its
first step, both combined before the shuffle. What is left per day and group is at most one row per step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.clock import DAY_MS, MINUTE_MS, UTC8_MS, floor_div, slice_index, wall_clock

STEP_MS = 5 * MINUTE_MS


def step_increments(rows: DataFrame, time_ms: str, by: Sequence[str], sums: dict[str, Column],
                    distincts: dict[str, Column], step_ms: int = STEP_MS, offset_ms: int = UTC8_MS) -> DataFrame:
    """Per (``by``, day, step): the sums, and for each distinct the number of keys first seen in that step.

    Result columns: ``by``, ``day`` (days since 1970), ``step`` (1-based), then the named measures.
    """
    ms = F.col(time_ms)
    keyed = rows.where(ms.isNotNull()).select(
        *by,
        floor_div(ms + F.lit(offset_ms), DAY_MS).cast("int").alias("day"),
        slice_index(ms, step_ms, offset_ms).alias("step"),
        *[value.alias(f"sum_{name}") for name, value in sums.items()],
        *[value.alias(f"key_{name}") for name, value in distincts.items()],
    ).withColumn("first_step", F.col("step"))

    group = [*by, "day"]
    sets = [[*group, "step"], *[[*group, f"key_{name}"] for name in distincts]]
    seen = keyed.groupingSets(sets, *group, "step", *[f"key_{name}" for name in distincts]).agg(
        F.min("first_step").alias("at_step"),
        F.grouping("step").alias("no_step"),
        *[F.grouping(f"key_{name}").alias(f"no_{name}") for name in distincts],
        *[F.sum(f"sum_{name}").alias(f"sum_{name}") for name in sums],
    )
    return seen.groupBy(*group, F.col("at_step").alias("step")).agg(
        *[F.sum(F.when(F.col("no_step") == 0, F.col(f"sum_{name}")).otherwise(0)).alias(name) for name in sums],
        *[F.count_if((F.col(f"no_{name}") == 0) & F.col(f"key_{name}").isNotNull()).alias(name)
          for name in distincts],
    )


def add_up_steps(increments: DataFrame, by: Sequence[str], measures: Sequence[str], step_ms: int = STEP_MS,
                 offset_ms: int = UTC8_MS, last_step: Column | int | None = None,
                 after_step: Column | None = None) -> DataFrame:
    """Cumulative windows from step increments; a quiet step repeats the value before it.

    Windows start at the group's first step and run to the end of the day, or to ``last_step``; of a day's windows
    those up to ``after_step`` are left out. Both may depend on ``day``.
    """
    last = F.lit(DAY_MS // step_ms) if last_step is None else last_step if isinstance(last_step, Column) else F.lit(last_step)
    in_order = Window.partitionBy(*by, "day").orderBy("step")
    totals = increments.select(
        *by, "day", "step",
        F.coalesce(F.lead("step").over(in_order), last + 1).alias("next_step"),
        *[F.sum(m).over(in_order).alias(m) for m in measures],
    )
    totals = totals.where(F.col("step") < F.col("next_step"))
    midnight_ms = F.col("day").cast("long") * F.lit(DAY_MS) - F.lit(offset_ms)
    return totals.select(
        *by, "day", *measures,
        F.explode(F.sequence(F.col("step"), F.col("next_step") - 1)).alias("step"),
    ).where(F.lit(True) if after_step is None else F.col("step") > after_step).select(
        wall_clock(midnight_ms, offset_ms).alias("window_start"),
        wall_clock(midnight_ms + F.col("step") * F.lit(step_ms), offset_ms).alias("window_end"),
        *by, *measures,
    )


def cumulate(rows: DataFrame, time_ms: str, by: Sequence[str], sums: dict[str, Column],
             distincts: dict[str, Column], step_ms: int = STEP_MS, offset_ms: int = UTC8_MS) -> DataFrame:
    """Day-to-date sums and exact distinct counts every ``step_ms``."""
    increments = step_increments(rows, time_ms, by, sums, distincts, step_ms, offset_ms)
    return add_up_steps(increments, by, [*sums, *distincts], step_ms, offset_ms)
