"""Dimension snapshots kept current from change rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from footfall.plans.dimensions import fold_changes
from footfall.sinks.partitions import write_batch
from footfall.sinks.snapshots import SHARED_KEEP_MS, buckets_of, publish, read_buckets, write_buckets
from footfall.sources.events import BAD_RECORD, bad_records, good_records


def sync_batch(changes: DataFrame, batch_id: int, state_path: str, dim_path: str,
               build: Callable[[DataFrame], DataFrame]) -> None:
    """Fold one batch of changes into the state per id and publish the dimension built from it.

    The state is read and written in the buckets of the changed ids only. Text that is no change row goes to the table ``<state>_bad``. A batch without changes publishes nothing.
    """
    if BAD_RECORD in changes.columns:
        write_batch(bad_records(changes), f"{state_path}_bad", batch_id, day=None)
        changes = good_records(changes)
    if changes.isEmpty():
        return
    spark, key = changes.sparkSession, "id"
    touched = buckets_of(changes, key)
    folded = fold_changes(changes, read_buckets(spark, state_path, changes.schema, batch_id, touched))
    write_buckets(folded.select(*changes.columns), state_path, key, batch_id, touched)
    state = read_buckets(spark, state_path, changes.schema, batch_id + 1)
    publish(build(state), dim_path, batch_id, keep_ms=SHARED_KEEP_MS)


def start_sync(changes: DataFrame, state_path: str, dim_path: str, checkpoint: str,
               build: Callable[[DataFrame], DataFrame], trigger: dict | None = None) -> StreamingQuery:
    """``build`` is ``user_dim`` or ``video_dim``."""

    def step(batch: DataFrame, batch_id: int) -> None:
        sync_batch(batch, batch_id, state_path, dim_path, build)

    return changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()
