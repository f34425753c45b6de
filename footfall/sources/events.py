"""Behaviour events as JSON messages or stored rows.

Messages come from a directory of JSON lines (``path=...``) or from a broker (``kafka={option: value}``, when the
connector is on the classpath). Missing fields become NULL. Text that is no JSON object of the schema goes to a
separate table of bad records instead of stopping the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.clock import millis

ODS_DDL = """
    username STRING, session_id STRING, event_id STRING, action_time BIGINT, lat DOUBLE, lng DOUBLE,
    release_channel STRING, device_type STRING, properties MAP<STRING, STRING>
"""

DWD_DDL = """
    user_id BIGINT, username STRING, session_id STRING, event_id STRING, event_time BIGINT, lat DOUBLE, lng DOUBLE,
    release_channel STRING, device_type STRING, properties MAP<STRING, STRING>,
    register_phone STRING, user_status INT, register_time TIMESTAMP_NTZ, register_gender INT, register_birthday DATE,
    register_province STRING, register_city STRING, register_job STRING, register_source_type INT,
    gps_province STRING, gps_city STRING, gps_region STRING, page_type STRING, page_service STRING
"""

BAD_RECORD = "_bad_record"
# Where a message stood in its source: what orders events of one time. The batch that took it in leads.
POSITION = "position"
POSITION_DDL = "STRUCT<batch: BIGINT, part: STRING, block: BIGINT, row: BIGINT>"


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def read_messages(spark: SparkSession, path: str | None = None, kafka: dict[str, str] | None = None,
                  files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with a text column ``value`` and the message's ``position``, as far as the source tells."""
    def position(part: Column, block: Column, row: Column) -> Column:
        return F.struct(F.lit(None).cast("long").alias("batch"), part.cast("string").alias("part"),
                        block.cast("long").alias("block"), row.cast("long").alias("row")).alias(POSITION)

    if kafka is not None:
        options = {"startingOffsets": "latest", **kafka}
        return spark.readStream.format("kafka").options(**options).load().select(
            F.col("value").cast("string"), position(F.concat_ws("-", "topic", "partition"), F.lit(0), F.col("offset")))
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select("value", position(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.lit(None)))


def parse_messages(messages: DataFrame, ddl: str) -> DataFrame:
    """Columns of ``ddl``, ``_bad_record`` with the text of a message that could not be parsed, and the position.

    Text that is JSON but no object of the schema, such as a number, is bad as well; NULL is an empty text.
    """
    schema = struct_of(ddl).add(BAD_RECORD, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    own = [c for c in messages.columns if c == POSITION]
    text = F.coalesce("value", F.lit(""))
    parsed = messages.select(text.alias("value"), F.from_json(text, schema, options).alias("m"), *own)
    bad = F.when(F.col("m").isNull() | F.col(f"m.{BAD_RECORD}").isNotNull(), F.col("value"))
    wanted = [c for c in struct_of(ddl).names if c not in own]
    return parsed.select(*[F.col(f"m.{c}").alias(c) for c in wanted], bad.alias(BAD_RECORD),
                         *[_placed(ddl) for _ in own])


def _placed(ddl: str) -> Column:
    """The position that a message carries, else its own."""
    carried = [F.col(f"m.{POSITION}")] if POSITION in struct_of(ddl).names else []
    return F.coalesce(*carried, POSITION).alias(POSITION)


def placed_in(rows: DataFrame, batch_id: int) -> DataFrame:
    """A micro-batch with batch and row filled in where a position has none; without positions, with empty ones.

    To be applied before rows are shuffled: a row's number is its place in its task.
    """
    if POSITION not in rows.columns:
        return rows.withColumn(POSITION, F.lit(None).cast(POSITION_DDL))
    place = F.col(POSITION)
    return rows.withColumn(POSITION, place.withField("batch", F.coalesce(place["batch"], F.lit(batch_id).cast("long")))
                           .withField("row", F.coalesce(place["row"], F.monotonically_increasing_id())))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)


def bad_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(BAD_RECORD).isNotNull()).select(F.col(BAD_RECORD).alias("value"))


def read_ods_stream(spark: SparkSession, **source) -> DataFrame:
    """Parsed raw events including ``_bad_record``."""
    return parse_messages(read_messages(spark, **source), ODS_DDL)


def parse_dwd_stream(spark: SparkSession, columns: Sequence[str] | None = None, **source) -> DataFrame:
    """Widened events and their positions from JSON messages, including ``_bad_record``; only ``columns`` are parsed."""
    wanted = [f for f in struct_of(DWD_DDL).fields if columns is None or f.name in columns]
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in wanted] + [f"{POSITION} {POSITION_DDL}"])
    return parse_messages(read_messages(spark, **source), fields)


def read_dwd_stream(spark: SparkSession, columns: Sequence[str] | None = None, **source) -> DataFrame:
    """The good records of ``parse_dwd_stream``; the job ``bad_events`` keeps and counts the others."""
    return good_records(parse_dwd_stream(spark, columns, **source))


def read_dwd(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Stored widened events (parquet, partitioned by ``dt``), only the wanted columns."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def with_event_time(events: DataFrame, column: str = "event_time", unit_ms: int = 1, delay: str = "0 seconds",
                    out: str = "row_time") -> DataFrame:
    """Add the event-time attribute and its watermark."""
    return events.withColumn(out, millis(F.col(column), unit_ms)).withWatermark(out, delay)
