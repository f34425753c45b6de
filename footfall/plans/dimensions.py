"""Dimension jobs: area hierarchy -> geohash, change rows -> user and video snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import with_geohash
from footfall.operators.latest import latest_changes, live_rows
from footfall.operators.lookup import unique_by

USER_STRUCT = ["id", "phone", "status", "create_time", "gender", "birthday", "province", "city", "job", "source_type"]
VIDEO_STRUCT = ["video_name", "video_type", "video_album", "video_author", "video_timelong"]


def as_keyed(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key, f STRUCT<columns>``: the shape in which dimensions are stored."""
    return rows.select(key, F.struct(*columns).alias("f"))


def flatten(keyed: DataFrame) -> DataFrame:
    return keyed.select("*", "f.*").drop("f")


def area_cells(areas: DataFrame) -> DataFrame:
    """(reversed geohash, province, city, region) of every community, duplicates by cell and region removed.

    Communities collapse to their (cell, parent) before the three parent joins. On the globe a geohash always has its
    five characters, so the range check is all the validation it needs; missing coordinates fail it too.
    """
    located = areas.where((F.col("level") == 4) & F.col("bd09_lat").between(-90, 90)
                          & F.col("bd09_lng").between(-180, 180))
    cells = with_geohash(located, "cell", "bd09_lat", "bd09_lng").select(
        F.reverse("cell").alias("geohash"), F.col("parentid").alias("region_id")).distinct()

    def level(name: str, up: str | None = None) -> DataFrame:
        parent = [F.col("parentid").alias(f"{up}_id")] if up else []
        return areas.select(F.col("id").alias(f"{name}_id"), F.col("areaname").alias(name), *parent)

    return cells.join(level("region", "city"), "region_id").join(level("city", "province"), "city_id") \
        .join(level("province"), "province_id").select("geohash", "province", "city", "region")


def geo_dim(areas: DataFrame) -> DataFrame:
    """One row per reversed geohash: the least (province, city, region), NULLs first.

    Blank names are rejected after the choice, so a cell whose least province is unknown has no row.
    """
    first = area_cells(areas).groupBy("geohash").agg(F.min(F.struct("province", "city", "region")).alias("a"))
    return first.select("geohash", "a.province", "a.city", F.coalesce("a.region", F.lit("")).alias("region")).where(
        F.col("province").isNotNull() & (F.trim("province") != "")
        & F.col("city").isNotNull() & (F.trim("city") != ""))


def keyed_geo_dim(areas: DataFrame) -> DataFrame:
    return geo_dim(areas).select(
        "geohash", F.struct(F.col("province").alias("p"), F.col("city").alias("c"), F.col("region").alias("r"))
        .alias("f"))


def fold_changes(changes: DataFrame, previous: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Newest change per key out of the previous fold and new change rows. Deletes stay as markers, so an older
    change that arrives late cannot bring a row back."""
    return latest_changes(changes if previous is None else previous.unionByName(changes), key)


def user_dim(folded: DataFrame) -> DataFrame:
    """Users by name. Two ids that share a name: the newest change, then the larger id. A renamed user's old name
    has no row."""
    by_name = unique_by(live_rows(folded), "username", [F.col("seq"), F.col("id")])
    return as_keyed(by_name, "username", [c for c in USER_STRUCT if c in by_name.columns])


def video_dim(folded: DataFrame) -> DataFrame:
    return as_keyed(live_rows(folded), "id", VIDEO_STRUCT)
