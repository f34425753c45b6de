"""Play segments: a play splits where it resumes after a pause.

A part starts at the latest resume so far, or at the play's first event. Part number and start are running aggregates
of one window, so no second shuffle by (play, part) is needed; events of one time share both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.slices import Measures, Slicer, running, running_state, slice_hot_keys

RESUME = "video_resume"
KEY = "play_id"
TIME = "event_time"


def _measures() -> Measures:
    resumed = F.col("event_id") == RESUME
    return {
        "part_no": ("sum", F.when(resumed, F.lit(1)).otherwise(F.lit(0)).cast("long")),
        "resumed_at": ("max", F.when(resumed, F.col(TIME))),
        "started_at": ("min", F.col(TIME)),
    }


def mark_segments(plays: DataFrame, cut: Slicer | None = None, carried: DataFrame | None = None) -> DataFrame:
    """Add ``part_no`` (resumes so far) and ``part_start_time``. ``carried`` is ``play_state`` of earlier events."""
    marked = running(plays.where(F.col(TIME).isNotNull()), KEY, TIME, _measures(),
                     cut or slice_hot_keys(KEY, TIME), carried)
    return marked.withColumn("part_start_time", F.coalesce("resumed_at", "started_at")) \
        .drop("resumed_at", "started_at")


def play_state(plays: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Per play: last event time, resumes so far, last resume, start."""
    return running_state(plays.where(F.col(TIME).isNotNull()), KEY, TIME, _measures(), carried)
