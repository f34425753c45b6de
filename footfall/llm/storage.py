"""Intermediate tables in the folder that driver and executors share.

A written table cuts lineage: what follows reads files that outlive the executor that wrote them. The folder is the
cluster's ``spark.checkpoint.dir``; where it is unset, as in tests, a folder below the warehouse is taken.
"""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/footfall/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``frame`` written once and read again."""
    spark = frame.sparkSession
    path = fresh_path(spark, name)
    frame.write.option("compression", compression).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _package() -> bytes:
    """This library's source files as a zip archive."""
    root = Path(__file__).parents[1]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent).as_posix())
    return out.getvalue()


def map_arrow(frame: DataFrame, function: Callable[[Iterator], Iterator], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this library sent along, once per session, to executors that do not have it installed."""
    context = frame.sparkSession.sparkContext
    if not any(name.startswith("footfall-") for name in context._python_includes):
        content = _package()
        name = f"footfall-{hashlib.sha256(content).hexdigest()[:12]}.zip"
        path = os.path.join(tempfile.mkdtemp(prefix="footfall-"), name)
        with open(path, "wb") as file:
            file.write(content)
        context.addPyFile(path)
    return frame.mapInArrow(function, schema)
