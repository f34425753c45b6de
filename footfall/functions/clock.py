"""Time as BIGINT epoch milliseconds.

Days and slices are integer arithmetic on the milliseconds plus a fixed zone offset, so no result depends on the
session time zone. The warehouse's wall clock is UTC+8.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000
UTC8_MS = 8 * HOUR_MS


def floor_to(ms: Column, step_ms: int) -> Column:
    """Largest multiple of ``step_ms`` that is not above ``ms`` (also below zero)."""
    return ms - F.pmod(ms, F.lit(step_ms))


def floor_div(ms: Column, step_ms: int) -> Column:
    return F.call_function("div", floor_to(ms, step_ms), F.lit(step_ms))


def millis(ms: Column, unit_ms: int = 1) -> Column:
    """TIMESTAMP of an epoch count in milliseconds (``unit_ms=1``) or seconds (``unit_ms=1000``)."""
    return F.timestamp_millis(ms) if unit_ms == 1 else F.timestamp_seconds(ms)


def epoch_ms_sql(ntz: str) -> str:
    """SQL text: milliseconds since 1970 of a TIMESTAMP_NTZ read as UTC, truncated.

    Built from calendar fields, which no session time zone touches.
    """
    return (f"(bigint(datediff({ntz}, date'1970-01-01')) * {DAY_MS} + hour({ntz}) * {HOUR_MS} "
            f"+ minute({ntz}) * {MINUTE_MS} + bigint(extract(SECOND FROM {ntz}) * 1000))")


def epoch_ms(ntz: str) -> Column:
    return F.expr(epoch_ms_sql(ntz))


def day_of(ms: Column, offset_ms: int = UTC8_MS) -> Column:
    """Local calendar day as DATE."""
    return F.date_from_unix_date(floor_div(ms + F.lit(offset_ms), DAY_MS).cast("int"))


def wall_clock(ms: Column, offset_ms: int = UTC8_MS) -> Column:
    """Local wall clock as TIMESTAMP_NTZ."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MILLISECOND", ms + F.lit(offset_ms), zero)


def time_slice(ms: Column, minutes: int, offset_ms: int = UTC8_MS) -> Column:
    """Start of the ``minutes``-long slice as text ``yyyy-MM-dd HH:mm:ss``.

    The slice is cut on the epoch, then shown at the offset.
    """
    return wall_clock(floor_to(ms, minutes * MINUTE_MS), offset_ms).cast("string")


def slice_index(ms: Column, step_ms: int, offset_ms: int = UTC8_MS) -> Column:
    """1-based number of the step inside its local day."""
    in_day = F.pmod(ms + F.lit(offset_ms), F.lit(DAY_MS))
    return (F.call_function("div", in_day, F.lit(step_ms)) + 1).cast("int")
