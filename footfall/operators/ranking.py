"""First n rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(rows: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group.

    ``row_number() <= n`` lets Spark keep only ``n`` rows per group and task before the shuffle, so a group of any
    size reaches its reducer as n rows per upstream task.
    """
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("__rank") <= n).drop("__rank")
