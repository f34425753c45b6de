"""Text and map helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two url patterns of the data contract.
PAGE_URL_PATTERN = r"^(.*?\.html)"
URL_PREFIX_PATTERN = r"(^.*/).*?"


def page_url(url: Column) -> Column:
    """Url up to and including the first ``.html``; NULL when there is none."""
    return F.regexp_substr(url, F.lit(PAGE_URL_PATTERN))


def url_prefix(url: Column) -> Column:
    """Url up to and including the last slash; NULL when there is none."""
    return F.regexp_substr(url, F.lit(URL_PREFIX_PATTERN))


def map_to_json(properties: Column) -> Column:
    """JSON object text of a string map without its NULL values; NULL for a NULL map."""
    return F.to_json(F.map_filter(properties, lambda _, value: value.isNotNull()))


def as_long(text: Column) -> Column:
    """BIGINT of a text; NULL instead of a failure when it is no number."""
    return text.try_cast("bigint")


def typed_null(kind: str = "bigint") -> Column:
    return F.lit(None).cast(kind)
