"""Tables that merge on load: batches are appended, days compacted, and one read view holds at any time.

A load is a batch of a day-partitioned table (``dt=<day>/batch_id=<n>``). Compacting a day up to batch N merges its loads
up to N into the batch -(N + 2) of that day; then, and not before, an empty file below ``_compacted`` says so. Readers take
of each day the newest compacted batch that is so marked and the loads after it, so they see every load once, before, while
and after a day is compacted, and loads that come later to a compacted day as well. A compaction that failed may be run
again. Loads that may still be repeated must not be compacted: the newest batch stays out unless it is asked for.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.sinks.partitions import (
    BATCH, NO_DAY, create_empty, delete, exists, matching, modified_ms, now_ms, write_batch)

MARKS = "_compacted"
DAY = "dt"


def _mark(path: str, day: str | None, upto: int) -> str:
    return f"{path}/{MARKS}/{DAY}={NO_DAY if day is None else day}/upto={upto}"


def compacted_upto(spark: SparkSession, path: str) -> dict[str | None, int]:
    """Of each compacted day the number of the last batch within: one listing."""
    found: dict[str | None, int] = {}
    for place in matching(spark, f"{path}/{MARKS}/{DAY}=*/upto=*"):
        day, upto = (part.split("=", 1)[1] for part in place.rsplit("/", 2)[1:])
        key = None if day == NO_DAY else day
        found[key] = max(found.get(key, -1), int(upto))
    return found


def _is_day(day: str | None) -> Column:
    return F.col(DAY).eqNullSafe(F.lit(day).cast("date"))


def _current(upto: dict[str | None, int]) -> Column:
    """Which partitions count; on partition columns only, so others are never opened."""
    marked = [_is_day(day) & ((F.col(BATCH) > n) | (F.col(BATCH) == -(n + 2))) for day, n in upto.items()]
    plain = [~_is_day(day) for day in upto]
    return reduce(Column.__or__, marked, reduce(Column.__and__, plain, F.col(BATCH) >= 0))


def read_loads(spark: SparkSession, path: str, ddl: str) -> DataFrame | None:
    """All loads, each once; ``ddl`` states the columns, the day included. None while there is no table."""
    if not exists(spark, path):
        return None
    table = spark.read.schema(f"{ddl}, {BATCH} BIGINT").parquet(path)
    return table.where(_current(compacted_upto(spark, path))).drop(BATCH)


def loaded_batches(spark: SparkSession, path: str, day: str | None) -> list[int]:
    places = matching(spark, f"{path}/{DAY}={NO_DAY if day is None else day}/{BATCH}=*")
    return sorted(int(place.rsplit("=", 1)[1]) for place in places)


def compact_loads(spark: SparkSession, path: str, ddl: str, day: str | None, merge: Callable[[DataFrame], DataFrame],
                  upto: int | None = None) -> int | None:
    """Merge the loads of ``day`` up to batch ``upto`` (by default all of the table but the newest); returns its number.

    None if there is nothing new to merge.
    """
    done = compacted_upto(spark, path)
    if upto is None:
        newest = max((int(p.rsplit("=", 1)[1]) for p in matching(spark, f"{path}/{DAY}=*/{BATCH}=*")), default=0)
        upto = newest - 1
    new = [n for n in loaded_batches(spark, path, day) if done.get(day, -1) < n <= upto]
    if not new:
        return None
    rows = spark.read.schema(f"{ddl}, {BATCH} BIGINT").parquet(path).where(
        _is_day(day) & _current(done) & (F.col(BATCH) <= new[-1])).drop(BATCH)
    write_batch(merge(rows), path, -(new[-1] + 2), DAY, whole=False)
    create_empty(spark, _mark(path, day, new[-1]))
    return new[-1]


def drop_merged(spark: SparkSession, path: str, keep_ms: int) -> list[str]:
    """Delete what compacted batches older than ``keep_ms`` replace: readers that began earlier may still be at it."""
    gone = []
    for day, upto in compacted_upto(spark, path).items():
        if now_ms() - modified_ms(spark, _mark(path, day, upto)) <= keep_ms:
            continue
        for batch in loaded_batches(spark, path, day):
            if -(upto + 2) < batch <= upto:
                place = f"{path}/{DAY}={NO_DAY if day is None else day}/{BATCH}={batch}"
                delete(spark, place)
                gone.append(place)
    return gone
