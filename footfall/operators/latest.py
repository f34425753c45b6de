"""Folding change rows into the newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELETE = "d"


def latest_changes(changes: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Newest change per key, deletes included: what a later fold needs to see.

    ``max`` of a struct led by ``seq`` combines before the shuffle, so a key with very many changes costs no task
    more than one row per upstream task.
    """
    rest = [c for c in changes.columns if c not in (key, seq)]
    newest = changes.groupBy(key).agg(F.max(F.struct(seq, *rest)).alias("__row"))
    return newest.select(*[F.col(key) if c == key else F.col(f"__row.{c}") for c in changes.columns])


def live_rows(latest: DataFrame, op: str = "op") -> DataFrame:
    """Rows whose newest change is not a delete."""
    return latest.where(F.col(op).isNull() | (F.col(op) != DELETE))
