"""Connected components of links, by alternating stars on DataFrames; no link or label reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.storage import stored


def _is_forest(pairs: DataFrame) -> bool:
    """Whether every node hangs on one node at most, and none that others hang on hangs itself."""
    roles = pairs.select(F.col("u").alias("node"), F.lit(1).alias("hangs")).unionByName(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("hangs")))
    return roles.groupBy("node").agg(F.sum("hangs").alias("up"), F.min("hangs").alias("least")).where(
        "up > 1 or (up = 1 and least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(a, b) BIGINT links -> (node, label): each linked node and the smallest node it can reach.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller ones; the rounds needed grow
    with the logarithm of the longest chain. Minima are aggregates, which combine before the shuffle; they are written
    before the join back, so that the join may split a node that has most of the links.
    """
    pairs = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), "links")
    while not _is_forest(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = stored(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct(), "large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        pairs = stored(large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
