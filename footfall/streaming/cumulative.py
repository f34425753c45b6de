"""Day-to-date figures on a stream.

The stream closes five-minute steps: one row per step and combination of keys, so a key that floods a step costs one row. Each batch
compares its keys with those already seen that day and adds, per step, the sums and the number of new keys. Running
totals per group are carried on, so a batch writes the dashboard rows of the steps it closed, for every group of the day,
and none beyond the newest closed step; no event is read twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.clock import DAY_MS, UTC8_MS, floor_div, slice_index
from footfall.operators.cumulate import STEP_MS, add_up_steps
from footfall.plans.dashboards import page_loads, promotion_rows
from footfall.sinks.partitions import read_batches, write_batch
from footfall.sinks.snapshots import current, publish
from footfall.sources.events import with_event_time

ROWS = "rows"
STEPS_PER_DAY = DAY_MS // STEP_MS


class CumulativeJob:
    """One dashboard: row sum ``rows_as``, distinct counts ``distincts`` (name -> key column), groups ``by``."""

    def __init__(self, by: dict[str, str], rows_as: str, distincts: Sequence[str], path: str):
        self.by, self.rows_as, self.distincts, self.path = by, rows_as, list(distincts), path

    @property
    def _group(self) -> str:
        return "".join(f"{name} {kind}, " for name, kind in self.by.items())

    def closed_steps(self, rows: DataFrame, row_value: Column, keys: dict[str, Column],
                     wanted: Column | None = None, delay: str = "0 seconds") -> DataFrame:
        """Streaming rows (``by``, day, step, ``distincts``, n) of closed steps; ``rows`` needs ``event_time``.

        The keys of a row stay together: the stream keeps one state row per step and combination that occurs, not one
        for every key of it. ``wanted`` picks the rows that count. It is no filter, as Spark would move one below the
        watermark: all rows drive the clock, so a step closes in time however rare the wanted rows are.
        """
        timed = with_event_time(rows, delay=delay)
        values = [*[key.alias(name) for name, key in keys.items()], row_value.cast("long").alias("n")]
        if wanted is None:
            marked = timed.select(*self.by, "row_time", *values)
        else:
            marked = timed.select(*self.by, "row_time", F.explode_outer(F.when(wanted, F.array(F.struct(*values)))).alias("k")) \
                .where(F.col("k").isNotNull()).select(*self.by, "row_time", "k.*")
        steps = marked.groupBy(F.window("row_time", f"{STEP_MS // 60_000} minutes"), *self.by, *keys).agg(F.sum("n").alias("n"))
        start = F.unix_millis(F.col("window.start"))
        return steps.select(
            *self.by, floor_div(start + F.lit(UTC8_MS), DAY_MS).cast("int").alias("day"),
            slice_index(start, STEP_MS).alias("step"), *keys, "n")

    def _marks(self, closed: DataFrame) -> DataFrame:
        """Closed steps as (``by``, day, step, kind, key, n): the row sum and each key by itself."""
        nothing = F.lit(0).cast("long")
        kinds = [F.struct(F.lit(ROWS).alias("kind"), F.lit(None).cast("string").alias("key"), F.col("n"))]
        kinds += [F.struct(F.lit(name).alias("kind"), F.col(name).cast("string").alias("key"), nothing.alias("n"))
                  for name in self.distincts]
        group = [*self.by, "day", "step"]
        return closed.select(*group, F.explode(F.array(*kinds)).alias("k")).select(*group, "k.*")

    def add_closed(self, closed: DataFrame, batch_id: int) -> None:
        """``add_batch`` of rows as ``closed_steps`` gives them."""
        closed = closed.persist()
        try:
            self._add(self._marks(closed), batch_id)
        finally:
            closed.unpersist()

    def add_batch(self, steps: DataFrame, batch_id: int) -> None:
        """Add closed steps (``by``, day, step, kind, key, n) to the keys seen and to the increments; both are repeatable
        per batch."""
        steps = steps.persist()
        try:
            self._add(steps, batch_id)
        finally:
            steps.unpersist()

    def _add(self, steps: DataFrame, batch_id: int) -> None:
        spark = steps.sparkSession
        group = [*self.by, "day"]
        seen_path = f"{self.path}/seen"
        seen_ddl = f"{self._group}kind STRING, key STRING, step INT, day INT"
        first = steps.where((F.col("kind") != ROWS) & F.col("key").isNotNull()) \
            .groupBy(*group, "kind", "key").agg(F.min("step").alias("step"))
        seen = read_batches(spark, seen_path, seen_ddl, before=batch_id)
        if seen is not None:
            # One number to the driver; as a literal it keeps all earlier days' directories from being read.
            earliest = steps.agg(F.min("day")).first()[0]
            first = _without(first, seen.where(F.col("day") >= F.lit(earliest)), [*group, "kind", "key"])
        write_batch(first.select(*self.by, "kind", "key", "step", "day"), seen_path, batch_id, "day")
        new = read_batches(spark, seen_path, seen_ddl, only=batch_id)
        increments = steps.where(F.col("kind") == ROWS).select(*group, "step", "kind", "n") \
            .unionByName(new.select(*group, "step", "kind", F.lit(1).cast("long").alias("n"))) \
            .groupBy(*group, "step").agg(
                F.sum(F.when(F.col("kind") == ROWS, F.col("n")).otherwise(0)).alias(self.rows_as),
                *[F.count_if(F.col("kind") == name).alias(name) for name in self.distincts])
        write_batch(increments, f"{self.path}/increments", batch_id, "day")
        self._add_to_dashboard(steps, batch_id)

    def _add_to_dashboard(self, steps: DataFrame, batch_id: int) -> None:
        """Dashboard rows of the steps that this batch closed; the newest closed step and the totals go on."""
        spark = steps.sparkSession
        now = steps.agg(F.max(F.struct("day", "step")).alias("m")).select("m.*").first()
        before = current(spark, f"{self.path}/closed", below=batch_id)
        past = None if before is None else before.first()
        if now is None or now["day"] is None:
            return
        measures = [self.rows_as, *self.distincts]
        rows = self.increments(spark, only=batch_id).select(*self.by, "day", "step", *measures)
        totals = current(spark, f"{self.path}/totals", below=batch_id)
        if totals is not None:
            rows = rows.unionByName(totals)
        # Earlier days are over once a later day has a closed step.
        last = F.when(F.col("day") < now["day"], STEPS_PER_DAY).otherwise(now["step"])
        done = F.lit(0) if past is None else F.when(F.col("day") == past["day"], past["step"]).otherwise(0)
        write_batch(add_up_steps(rows, list(self.by), measures, last_step=last, after_step=done),
                    f"{self.path}/dashboard", batch_id, day=None)
        open_day = rows.where(F.col("day") == now["day"]).groupBy(*self.by, "day").agg(
            F.lit(now["step"]).cast("int").alias("step"), *[F.sum(m).alias(m) for m in measures])
        publish(open_day, f"{self.path}/totals", batch_id)
        publish(spark.createDataFrame([(now["day"], now["step"])], "day INT, step INT").coalesce(1),
                f"{self.path}/closed", batch_id)

    def increments(self, spark: SparkSession, only: int | None = None) -> DataFrame | None:
        ddl = f"{self._group}step INT, {self.rows_as} BIGINT, " \
              + "".join(f"{name} BIGINT, " for name in self.distincts) + "day INT"
        return read_batches(spark, f"{self.path}/increments", ddl, only=only)

    def dashboard(self, spark: SparkSession, day: int | None = None, closed_step: int | None = None) -> DataFrame:
        """All cumulative windows, or those of one day (days since 1970), made anew from the increments.

        They run up to ``closed_step`` of each day; by default to the newest closed step.
        """
        rows = self.increments(spark)
        if day is not None:
            rows = rows.where(F.col("day") == day)
        last = F.lit(closed_step)
        if closed_step is None:
            newest = current(spark, f"{self.path}/closed").first()
            last = F.when(F.col("day") < newest["day"], STEPS_PER_DAY).otherwise(newest["step"])
        return add_up_steps(rows, list(self.by), [self.rows_as, *self.distincts], last_step=last)

    def start(self, steps: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return steps.writeStream.outputMode("append").foreachBatch(self.add_closed) \
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _without(rows: DataFrame, seen: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose ``columns`` do not occur in ``seen``; NULL equals NULL."""
    other = seen.select(*[F.col(c).alias(f"__{c}") for c in columns])
    same = None
    for c in columns:
        equal = F.col(c).eqNullSafe(F.col(f"__{c}"))
        same = equal if same is None else same & equal
    return rows.join(other, same, "left_anti")


def traffic_today(dwd: DataFrame, path: str, delay: str = "0 seconds") -> tuple[CumulativeJob, DataFrame]:
    job = CumulativeJob({}, "pv_amt", ["uv_amt", "ses_amt"], path)
    keys = {"uv_amt": F.col("user_id"), "ses_amt": F.col("session_id")}
    return job, job.closed_steps(dwd, page_loads(), keys, delay=delay)


def promotion_today(dwd: DataFrame, path: str, delay: str = "0 seconds") -> tuple[CumulativeJob, DataFrame]:
    job = CumulativeJob({"promotion_page_name": "STRING", "province": "STRING"}, "pv_amt", ["uv_amt", "new_uv_amt"],
                        path)
    events = promotion_rows(dwd).withColumnRenamed("register_province", "province")
    keys = {"uv_amt": F.col("user_id"), "new_uv_amt": F.col("new_user_id")}
    return job, job.closed_steps(events, F.lit(1), keys, wanted=F.col("promoted"), delay=delay)
