"""Scalar column functions, all built from Spark expressions."""

from footfall.functions.clock import day_of, epoch_ms, epoch_ms_sql, millis, slice_index, time_slice, wall_clock
from footfall.functions.geohash import geohash5, with_geohash
from footfall.functions.text import as_long, map_to_json, page_url, typed_null, url_prefix

__all__ = [
    "as_long", "day_of", "epoch_ms", "epoch_ms_sql", "geohash5", "map_to_json", "millis", "page_url", "slice_index",
    "time_slice", "typed_null", "url_prefix", "wall_clock", "with_geohash",
]
