"""The scalar functions under their SQL names, for queries written as SQL text.

They are SQL functions: Spark puts their body in place of the call, so they cost what the expression costs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from footfall.functions.clock import MINUTE_MS, UTC8_MS, epoch_ms_sql
from footfall.functions.geohash import geohash5_sql


def _time_trunk(offset_ms: int) -> str:
    ms = f"({epoch_ms_sql('at')} - {offset_ms})"
    start = f"({ms} - pmod({ms}, unit * {MINUTE_MS}))"
    return f"string(timestampadd(MILLISECOND, {start} + {offset_ms}, timestamp_ntz'1970-01-01 00:00:00'))"


def register_functions(spark: SparkSession, offset_ms: int = UTC8_MS) -> None:
    """``geo(lat, lng)``, ``time_trunk(wall clock, minutes)``, ``toJson(map)`` and ``getNull()``."""
    bodies = {
        "geo(lat DOUBLE, lng DOUBLE) RETURNS STRING": geohash5_sql("lat", "lng"),
        "time_trunk(at TIMESTAMP_NTZ, unit INT) RETURNS STRING": _time_trunk(offset_ms),
        "toJson(properties MAP<STRING, STRING>) RETURNS STRING":
            "to_json(map_filter(properties, (name, value) -> value IS NOT NULL))",
        "getNull() RETURNS BIGINT": "CAST(NULL AS BIGINT)",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
