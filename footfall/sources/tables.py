"""Bounded tables, change rows and delimited lines.

Text that cannot be parsed is kept apart from the rows: the ``parse_`` functions give it as ``_bad_record``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.sources.events import BAD_RECORD, good_records, parse_messages, struct_of

# Column names and types of the inputs.
USER_DDL = """
    id BIGINT, username STRING, phone STRING, status INT, create_time TIMESTAMP_NTZ, gender INT, birthday DATE,
    province STRING, city STRING, job STRING, source_type INT
"""
VIDEO_DDL = """
    id BIGINT, video_name STRING, video_type STRING, video_album STRING, video_author STRING, video_timelong BIGINT
"""
CHANGE_DDL = "op STRING, seq BIGINT"
AREA_DDL = "id BIGINT, parentid BIGINT, level INT, areaname STRING, bd09_lat DOUBLE, bd09_lng DOUBLE"
LINE_DDL = "user_id STRING, name STRING, gender STRING, age INT, action_time BIGINT"


def read_table(spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None) -> DataFrame:
    """A bounded table from parquet, or over JDBC when a driver is on the classpath.

    For a large JDBC table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``: without
    them one task reads it all.
    """
    if jdbc is not None:
        return spark.read.format("jdbc").options(**jdbc).load()
    return spark.read.parquet(path)


def parse_changes(messages: DataFrame, ddl: str) -> DataFrame:
    """Change rows ``op`` (c, u or d), ``seq`` and the table's columns out of JSON texts, with ``_bad_record``."""
    return parse_messages(messages.select("value"), f"{CHANGE_DDL}, {ddl}")


def read_changes(spark: SparkSession, path: str, ddl: str, streaming: bool = False) -> DataFrame:
    """Change rows from JSON lines, including ``_bad_record``: folding them keeps the bad ones aside."""
    reader = spark.readStream if streaming else spark.read
    return parse_changes(reader.text(path), ddl)


def parse_lines(messages: DataFrame) -> DataFrame:
    """Comma-separated lines id,name,gender,age,seconds out of texts, with ``_bad_record``."""
    schema = struct_of(LINE_DDL).add(BAD_RECORD, T.StringType())
    text = F.coalesce("value", F.lit(""))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    parsed = messages.select(text.alias("value"), F.from_csv(text, schema.simpleString()[7:-1].replace(":", " "), options)
                             .alias("m"))
    # An empty line has no columns to be wrong.
    bad = F.when(F.col("m").isNull() | F.col(f"m.{BAD_RECORD}").isNotNull() | (F.trim("value") == ""), F.col("value"))
    return parsed.select(*[F.col(f"m.{c}").alias(c) for c in struct_of(LINE_DDL).names], bad.alias(BAD_RECORD))


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """The good lines of a text; the job ``bad_lines`` keeps and counts the others."""
    reader = spark.readStream if streaming else spark.read
    return good_records(parse_lines(reader.text(path)))
