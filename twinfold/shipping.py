"""Make this package importable in Spark's Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once an application. Spark itself hands the file on to new executors."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="spark-")
        shutil.copytree(root, f"{folder}/sources/{root.name}", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/{root.name}", "zip", f"{folder}/sources"))


def map_pandas(df: DataFrame, run, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInPandas(run, schema)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
