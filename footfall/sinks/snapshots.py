"""Versioned snapshots: dimensions, carried state, rankings that are replaced as a whole.

A snapshot is a parquet directory ``version=<n>``, where n is the number of the batch that made it. A batch reads the
newest version *below* its own number, so running it again starts from the same input and writes the same result.
A version counts once its ``_SUCCESS`` file is there; readers never see a half-written one. Other jobs may still read a
version after it was replaced, so tables they read keep replaced versions for a time (``keep_ms``).

Large keyed state is kept in ``BUCKETS`` buckets by a hash of the key. A batch reads and rewrites only the buckets that
its keys are in: its version holds these, and a bucket's state is in the newest version that has the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from footfall.sinks.partitions import delete, exists, matching, modified_ms, names_in, now_ms

VERSION = "version="
# How long jobs may go on reading a dimension that was replaced: longer than any of their batches lasts.
MARK = "__mark"
SHARED_KEEP_MS = 6 * 3_600_000


def _versions(spark: SparkSession, path: str, below: int | None = None) -> list[int]:
    """Complete versions from the newest down, looking no further than needed."""
    found = sorted((int(n[len(VERSION):]) for n in names_in(spark, path) if n.startswith(VERSION)), reverse=True)
    return [v for v in found if (below is None or v < below)]


def newest_version(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    for version in _versions(spark, path, below):
        if exists(spark, f"{path}/{VERSION}{version}/_SUCCESS"):
            return version
    return None


def publish(rows: DataFrame, path: str, version: int, keep: int = 3, keep_ms: int = 0) -> DataFrame:
    """Write ``rows`` as ``version`` and return the written rows.

    Of the older versions those go that are neither among the newest ``keep`` nor were replaced within ``keep_ms``.
    """
    spark = rows.sparkSession
    target = f"{path}/{VERSION}{version}"
    rows.write.mode("overwrite").parquet(target)
    found = _versions(spark, path)
    for newer, old in zip(found[keep - 1:], found[keep:], strict=False):
        if not keep_ms or now_ms() - modified_ms(spark, f"{path}/{VERSION}{newer}") > keep_ms:
            delete(spark, f"{path}/{VERSION}{old}")
    return spark.read.schema(rows.schema).parquet(target)


BUCKET = "bucket"
BUCKETS = 64


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def buckets_of(rows: DataFrame, key: str) -> list[int]:
    """The buckets that the keys of ``rows`` are in: at most ``BUCKETS`` numbers."""
    return sorted(r[0] for r in rows.select(_bucket(key)).distinct().collect())


def _bucket_versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """The complete versions of each bucket, newest first, by two listings."""
    done = {int(p.rsplit(VERSION, 1)[1].split("/")[0]) for p in matching(spark, f"{path}/{VERSION}*/_SUCCESS")}
    found: dict[int, list[int]] = {}
    for place in matching(spark, f"{path}/{VERSION}*/{BUCKET}=*"):
        version, bucket = place.rsplit(VERSION, 1)[1].split("/")
        if int(version) in done:
            found.setdefault(int(bucket.split("=")[1]), []).append(int(version))
    return {bucket: sorted(versions, reverse=True) for bucket, versions in found.items()}


def read_buckets(spark: SparkSession, path: str, schema: StructType, below: int,
                 buckets: list[int] | None = None) -> DataFrame:
    """The state of some buckets, or of all, as it was before batch ``below``."""
    places = []
    for bucket, versions in _bucket_versions(spark, path).items():
        newest = next((v for v in versions if v < below), None)
        if newest is not None and (buckets is None or bucket in buckets):
            places.append(f"{path}/{VERSION}{newest}/{BUCKET}={bucket}")
    if not places:
        return spark.createDataFrame([], schema)
    stored = StructType([*schema.fields, StructField(MARK, BooleanType())])
    return spark.read.schema(stored).parquet(*places).where(~F.col(MARK)).drop(MARK)


def write_buckets(rows: DataFrame, path: str, key: str, version: int, buckets: list[int], keep: int = 3) -> None:
    """Write the whole state of ``buckets``; of each bucket the newest ``keep`` versions stay.

    A bucket whose state has become empty is written with a row that no key has.
    """
    spark = rows.sparkSession
    marks = spark.createDataFrame([(b,) for b in buckets], f"{BUCKET} INT").withColumn(MARK, F.lit(True))
    rows = rows.withColumn(BUCKET, _bucket(key)).withColumn(MARK, F.lit(False))
    # Dynamic overwrite would not leave the file that says the version is complete.
    rows.unionByName(marks, allowMissingColumns=True).repartition(BUCKET).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(f"{path}/{VERSION}{version}")
    for bucket, versions in _bucket_versions(spark, path).items():
        for old in versions[keep:]:
            delete(spark, f"{path}/{VERSION}{old}/{BUCKET}={bucket}")


def read_version(spark: SparkSession, path: str, version: int | None) -> DataFrame | None:
    return None if version is None else spark.read.parquet(f"{path}/{VERSION}{version}")


def current(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """Newest complete version, or the newest below a batch number; None when there is none."""
    return read_version(spark, path, newest_version(spark, path, below))
