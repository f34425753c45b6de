"""Day-partitioned tables: repeatable batch writes, compaction, retention.

A table lies in ``dt=<day>/batch_id=<n>`` directories. Writing a batch again replaces its own directories and nothing
else (dynamic partition overwrite), and removes those that it does not fill any more, so a replayed micro-batch leaves
neither a duplicate nor a remnant.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Days that each table keeps.
RETENTION_DAYS = {"detail": 30, "traffic": 30, "dwell": 90, "video": 90}

BATCH = "batch_id"
COMPACTED = -1
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def write_batch(rows: DataFrame, path: str, batch_id: int, day: str | None = "dt", whole: bool = True) -> None:
    """Append one micro-batch; repeating it overwrites what it wrote before and nothing else.

    ``whole`` states that ``rows`` are all there is to the batch, so that days it no longer fills are removed.

    Rows are rebalanced by day first: adaptive execution then writes few files of a proper size per day, and splits a
    day that holds most of the rows.
    """
    by = [day, BATCH] if day else [BATCH]
    spark = rows.sparkSession
    own = f"{path}/{day}=*/{BATCH}={batch_id}" if day else f"{path}/{BATCH}={batch_id}"
    earlier = matching(spark, own) if whole else []
    filled = _filled_dirs(rows, path, batch_id, day) if earlier else set()
    for stale in earlier:
        if stale.rstrip("/").split("/")[-len(by):] not in [f.split("/")[-len(by):] for f in filled]:
            delete(spark, stale)
    if day:
        rows = rows.hint("rebalance", day)
    rows.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _filled_dirs(rows: DataFrame, path: str, batch_id: int, day: str | None) -> set[str]:
    """The directories that ``rows`` will be in; only asked for when the batch was written before."""
    if day is None:
        return set() if rows.isEmpty() else {f"{path}/{BATCH}={batch_id}"}
    days = [r[0] for r in rows.select(F.col(day).cast("string")).distinct().collect()]
    return {f"{path}/{day}={NO_DAY if d is None else d}/{BATCH}={batch_id}" for d in days}


def read_batches(spark: SparkSession, path: str, ddl: str, before: int | None = None,
                 only: int | None = None) -> DataFrame | None:
    """All batches, those numbered below ``before`` or just ``only``; None while there is no table.

    ``ddl`` states the columns, so nothing is inferred and an early empty batch does no harm.
    """
    if not exists(spark, path):
        return None
    table = spark.read.schema(f"{ddl}, {BATCH} BIGINT").parquet(path)
    if before is not None:
        table = table.where(F.col(BATCH) < before)
    if only is not None:
        table = table.where(F.col(BATCH) == only)
    return table.drop(BATCH)


def retained(rows: DataFrame, today: Column, days: int, day: str = "dt") -> DataFrame:
    """Rows of the last ``days`` days and today; on the partition column this prunes directories."""
    return rows.where(F.col(day) >= F.date_sub(today, days))


def _hadoop_dir(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _hadoop_dir(spark, path)
    return files.exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory: one listing of the table's root, no data is read."""
    files, where = _hadoop_dir(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, by one listing."""
    files, where = _hadoop_dir(spark, pattern)
    return [s.getPath().toString() for s in files.globStatus(where) or []]


def modified_ms(spark: SparkSession, path: str) -> int:
    files, where = _hadoop_dir(spark, path)
    return files.getFileStatus(where).getModificationTime()


def bytes_in(spark: SparkSession, path: str) -> int:
    files, where = _hadoop_dir(spark, path)
    return files.getContentSummary(where).getLength()


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file, there at once or not at all."""
    files, where = _hadoop_dir(spark, path)
    files.create(where).close()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (``spark.checkpoint.dir``); where none is set, as in tests,
    below the warehouse."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/footfall/{name}-{uuid.uuid4().hex}"


def now_ms() -> int:
    return time.time_ns() // 1_000_000


def delete(spark: SparkSession, path: str) -> None:
    files, where = _hadoop_dir(spark, path)
    files.delete(where, True)


def partition_days(spark: SparkSession, path: str, day: str = "dt") -> list[str]:
    return sorted(n.split("=", 1)[1] for n in names_in(spark, path) if n.startswith(f"{day}="))


def drop_days_before(spark: SparkSession, path: str, first_kept: str, day: str = "dt") -> list[str]:
    """Delete the directories of all days before ``first_kept`` (yyyy-MM-dd); returns the dropped days.

    Rows without a day go by the time they were loaded: their batches written before ``first_kept`` (UTC) are deleted.
    """
    expired = [d for d in partition_days(spark, path, day) if d[:1].isdigit() and d < first_kept]
    for value in expired:
        delete(spark, f"{path}/{day}={value}")
    limit = datetime.fromisoformat(first_kept).replace(tzinfo=UTC).timestamp() * 1000
    for batch in matching(spark, f"{path}/{day}={NO_DAY}/{BATCH}=*"):
        if modified_ms(spark, batch) < limit:
            delete(spark, batch)
    return expired


def compact_day(spark: SparkSession, path: str, value: str | None, merge: Callable[[DataFrame], DataFrame], target: str,
                day: str = "dt") -> None:
    """Merge all batches of one closed day, or of the rows without a day, into one compacted batch of ``target``.

    The source stays as it is; readers switch to the target, and retention removes the rest. A failed run can be
    repeated.
    """
    rows = spark.read.parquet(path).where(F.col(day).eqNullSafe(F.lit(value).cast("date"))).drop(BATCH)
    write_batch(merge(rows), target, COMPACTED, day, whole=False)
