"""Raw events -> widened stream and detail table, with further chances for users that are not known yet."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from time import sleep

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.plans.widen import WIDE_COLUMNS, detail, look_up_users, widen, with_all_fields
from footfall.sinks.partitions import exists, read_batches, write_batch
from footfall.sinks.snapshots import newest_version, read_version
from footfall.sources.events import POSITION, bad_records, good_records, placed_in

ODS_COLUMNS = ["username", "session_id", "event_id", "action_time", "lat", "lng", "release_channel", "device_type",
               "properties"]


@dataclass
class EnrichTables:
    """Where the job reads its dimension snapshots and writes its tables, and how often it asks for a missing user."""

    users: str
    geo: str
    pages: str
    wide: str
    detail: str
    notes: str
    bad: str
    checkpoint: str
    wide_kafka: dict[str, str] | None = None  # options of a broker topic that takes the wide stream instead
    attempts: int = 3
    wait_s: float = 5.0


def _noted(spark: SparkSession, path: str) -> dict | None:
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if exists(spark, f"{path}/_SUCCESS") else None


def _versions(spark: SparkSession, tables: EnrichTables) -> dict:
    return {"users": [newest_version(spark, tables.users)], "geo": newest_version(spark, tables.geo),
            "pages": newest_version(spark, tables.pages)}


def enrich_batch(spark: SparkSession, parsed: DataFrame, batch_id: int, tables: EnrichTables) -> None:
    """One micro-batch: evaluated once, written to the wide stream and the detail table.

    Users that are missing are looked up again, in newer versions of the dimension only, ``attempts`` times in all and
    ``wait_s`` seconds apart; then their events are written without a user. Names so given up are remembered with the
    version they were missing in, and not waited for again until there is a newer one. The versions used are written down
    before any row is, and a repeat of the batch uses the same, so both outputs always hold the same rows. A dimension
    without any version gives NULLs.
    """
    write_batch(bad_records(parsed), tables.bad, batch_id, day=None)
    events = placed_in(good_records(parsed), batch_id).select(*ODS_COLUMNS, POSITION)
    note = f"{tables.notes}/batch_id={batch_id}"
    noted = _noted(spark, note)
    used = noted or _versions(spark, tables)

    wide = with_all_fields(widen(
        events, read_version(spark, tables.users, used["users"][0]), read_version(spark, tables.geo, used["geo"]),
        read_version(spark, tables.pages, used["pages"]), keep=[POSITION])).persist()
    try:
        rows = wide
        if noted is None:
            for _ in range(1, tables.attempts):
                if _not_given_up(rows, used["users"][-1], batch_id, tables).isEmpty():
                    break
                sleep(tables.wait_s)
                newest = newest_version(spark, tables.users)
                if newest != used["users"][-1]:
                    used["users"].append(newest)
                    rows = _asked_again(spark, rows, newest, tables)
            given_up = _not_given_up(rows, used["users"][-1], batch_id, tables)
            write_batch(given_up, _given_up(used["users"][-1], tables), batch_id, day=None)
            spark.createDataFrame([(json.dumps(used),)], "value STRING").coalesce(1).write.mode("overwrite").text(note)
        else:
            for version in used["users"][1:]:
                rows = _asked_again(spark, rows, version, tables)
        _write(spark, rows, batch_id, tables)
    finally:
        wide.unpersist()


def _is_missed():
    return F.col("user_id").isNull() & F.col("username").isNotNull()


def _missed(rows: DataFrame) -> DataFrame:
    return rows.where(_is_missed())


def _given_up(version: int | None, tables: EnrichTables) -> str:
    """Where the names are that are missing in a version of the users. A version's names are read with it alone."""
    return f"{tables.notes}_unknown/users={version}"


def _not_given_up(rows: DataFrame, version: int | None, batch_id: int, tables: EnrichTables) -> DataFrame:
    """The missing names that no earlier batch has given up in this version."""
    names = _missed(rows).select("username").distinct()
    known = read_batches(rows.sparkSession, _given_up(version, tables), "username STRING", before=batch_id)
    return names if known is None else names.join(known, "username", "left_anti")


def _asked_again(spark: SparkSession, rows: DataFrame, version: int, tables: EnrichTables) -> DataFrame:
    again = look_up_users(_missed(rows), read_version(spark, tables.users, version))
    return rows.where(~_is_missed()).unionByName(again)


def _write(spark: SparkSession, wide: DataFrame, batch_id: int, tables: EnrichTables) -> None:
    write_batch(detail(wide), tables.detail, batch_id)
    messages = wide.select(F.to_json(F.struct(*WIDE_COLUMNS, POSITION)).alias("value"))
    if tables.wide_kafka is not None:
        messages.write.format("kafka").options(**tables.wide_kafka).save()
        return
    # Downstream streams read these files once, so a batch that is already complete keeps its files.
    target = f"{tables.wide}/batch_id={batch_id}"
    if not exists(spark, f"{target}/_SUCCESS"):
        messages.write.mode("overwrite").text(target)


def start_enrich(parsed: DataFrame, tables: EnrichTables, trigger: dict | None = None,
                 after: Callable[[int], None] | None = None) -> StreamingQuery:
    """Run ``enrich_batch`` on every micro-batch of parsed raw events."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = placed_in(batch, batch_id).persist()
        try:
            enrich_batch(batch.sparkSession, batch, batch_id, tables)
        finally:
            batch.unpersist()
        if after:
            after(batch_id)

    return parsed.writeStream.foreachBatch(step).option("checkpointLocation", tables.checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()
