"""Dashboard tables in a relational database; needs a JDBC driver on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append(rows: DataFrame, options: dict[str, str]) -> None:
    """Append closed windows. A replayed batch appends again: give the table a unique key on its window columns."""
    rows.write.format("jdbc").options(**options).mode("append").save()


def replace(rows: DataFrame, options: dict[str, str]) -> None:
    """Replace a whole small table (a ranking) while keeping its definition."""
    rows.write.format("jdbc").options(**options).option("truncate", "true").mode("overwrite").save()
