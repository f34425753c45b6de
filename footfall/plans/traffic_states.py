"""The traffic aggregate as stored states at several grains, and roll-ups from the cheapest of them.

Each load of minute rows is stored as it is (users and sessions as keys) and as states at every grain of ``GRAINS``. The
grains are a lattice by their key columns: a roll-up can be read from every grain that has its columns, and is read from
the one that takes the fewest bytes; the minute rows are the finest, from which any roll-up can be made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from footfall.operators.distinct_state import MEASURES_DDL, build_state, count_state, merge_state, read_state
from footfall.plans.olap import TRAFFIC_KEYS, traffic_merge
from footfall.sinks.loads import compact_loads, drop_merged, read_loads
from footfall.sinks.partitions import bytes_in, exists, write_batch

MINUTE = "minute"
# Key columns per grain, the day first. Coarser time columns follow from finer ones, so they do not add groups.
GRAINS: dict[str, list[str]] = {
    "day": ["dt"],
    "area_hour": ["dt", "time_trunk_1h", "province", "city", "region"],
    "page_half_hour": ["dt", "time_trunk_30m", "time_trunk_1h", "page_url", "page_type", "page_service"],
    "terminal_ten": ["dt", "time_trunk_10m", "time_trunk_30m", "time_trunk_1h", "device_type", "release_channel"],
    "new_five": ["dt", "time_trunk_5m", "time_trunk_10m", "time_trunk_30m", "time_trunk_1h", "is_new"],
}


def _ddl(keys: Sequence[str]) -> str:
    types = {"dt": "DATE", "is_new": "INT"}
    return ", ".join(f"{key} {types.get(key, 'STRING')}" for key in keys)


def ddl_of(grain: str) -> str:
    if grain == MINUTE:
        return f"{_ddl(TRAFFIC_KEYS)}, pv BIGINT, user_id BIGINT, session_id STRING"
    return f"{_ddl(GRAINS[grain])}, {MEASURES_DDL}"


def merge_of(grain: str):
    return traffic_merge if grain == MINUTE else lambda states: merge_state(states, GRAINS[grain])


def store_load(loaded: DataFrame, batch_id: int, path: str) -> None:
    """Write one load at every grain; repeating it replaces what it wrote."""
    loaded = loaded.persist()
    try:
        write_batch(loaded, f"{path}/{MINUTE}", batch_id)
        for grain, keys in GRAINS.items():
            write_batch(build_state(loaded, keys), f"{path}/{grain}", batch_id)
    finally:
        loaded.unpersist()


def covering(dims: Sequence[str]) -> list[str]:
    """The grains that have all columns of ``dims``."""
    return [grain for grain, keys in GRAINS.items() if set(dims) <= set(keys)] + [MINUTE]


def cheapest(spark: SparkSession, path: str, dims: Sequence[str]) -> str:
    """Of the stored grains that cover ``dims`` the one of the fewest bytes."""
    unknown = set(dims) - set(TRAFFIC_KEYS)
    if unknown:
        raise ValueError(f"not a column of the traffic table: {sorted(unknown)}")
    return min((grain for grain in covering(dims) if exists(spark, f"{path}/{grain}")),
               key=lambda grain: bytes_in(spark, f"{path}/{grain}"))


def rollup(spark: SparkSession, path: str, dims: Sequence[str], grain: str | None = None) -> DataFrame:
    """``pv``, exact ``uv`` and estimated ``session_cnt`` at any subset of the key columns, from stored loads."""
    grain = grain or cheapest(spark, path, dims)
    rows = read_loads(spark, f"{path}/{grain}", ddl_of(grain))
    return count_state(build_state(rows, dims), dims) if grain == MINUTE else read_state(rows, dims)


def compact_states(spark: SparkSession, path: str, day: str | None, upto: int | None = None) -> dict[str, int | None]:
    """Merge a day's loads at every grain; returns the last batch merged per grain."""
    return {grain: compact_loads(spark, f"{path}/{grain}", ddl_of(grain), day, merge_of(grain), upto)
            for grain in (MINUTE, *GRAINS) if exists(spark, f"{path}/{grain}")}


def sweep_states(spark: SparkSession, path: str, keep_ms: int) -> None:
    for grain in (MINUTE, *GRAINS):
        drop_merged(spark, f"{path}/{grain}", keep_ms)

