"""Left lookups into keyed dimensions.

A dimension snapshot is unique per key (``unique_by`` is applied when it is published), so a lookup never multiplies
events. A stored snapshot needs no hint: Spark broadcasts it when its files are small enough, and else joins by a
sort-merge join whose skewed partitions adaptive execution splits. A computed dimension hides its size from that
check; a caller who has counted it (``at_most``) may ask for the broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 4096
# Marks the keys of rows without one; a dimension key that starts with it is left out.
NO_KEY = "\u0000"


def at_most(table: DataFrame, rows: int) -> bool:
    """Whether ``table`` has no more than ``rows`` rows; reads only as far as needed to tell."""
    return table.limit(rows + 1).count() <= rows


def spread_nulls(key: Column, salt_by: Sequence[str]) -> Column:
    """``key``, with NULL replaced by one of many texts that match nothing.

    Rows without a key would otherwise meet in one shuffle partition. The salt is a hash of the row's own columns, so
    a task that is run again sends each row to the same place.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_by]), F.lit(SALTS)).cast("string")
    return F.coalesce(key, F.concat(F.lit(NO_KEY), salt))


def lookup(events: DataFrame, dimension: DataFrame, event_key: Column, dim_key: Column,
           fields: dict[str, str], salt_by: Sequence[str] = (), small: bool = False) -> DataFrame:
    """Add ``fields`` (new name -> dimension column) to every event; NULL where the dimension has no such key.

    With ``salt_by`` the keys are texts and rows without a key are spread by these columns. ``small`` states that the
    dimension has been counted and fits every executor.
    """
    usable = dim_key.isNotNull() & ~dim_key.startswith(NO_KEY) if salt_by else dim_key.isNotNull()
    side = dimension.where(usable).select(
        dim_key.alias("__dim_key"), *[F.col(source).alias(name) for name, source in fields.items()])
    key = spread_nulls(event_key, salt_by) if salt_by else event_key
    joined = events.withColumn("__event_key", key).join(
        F.broadcast(side) if small else side, F.col("__event_key") == F.col("__dim_key"), "left")
    return joined.drop("__event_key", "__dim_key")


def unique_by(table: DataFrame, key: str, prefer: Sequence[Column]) -> DataFrame:
    """One row per non-NULL ``key``: the greatest by ``prefer``, then by the remaining columns.

    An aggregate, so duplicates already collapse before the shuffle.
    """
    rest = [c for c in table.columns if c != key]
    ranked = F.struct(*[p.alias(f"__p{i}") for i, p in enumerate(prefer)], *rest)
    picked = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(ranked).alias("__row"))
    return picked.select(*[F.col(key) if c == key else F.col(f"__row.{c}") for c in table.columns])
