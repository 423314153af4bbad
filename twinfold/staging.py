"""Folders and tables that driver and executors share, for what is written on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []
_made: list[str] = []


def hadoop(spark: SparkSession, path: str):
    """(file system, path) by Spark's own configuration, for any scheme that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Where that is unset, a folder of this machine, if the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own_dir:
            _own_dir.append(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        found = _own_dir[0]
    _made.append(f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def made() -> list[str]:
    """The folders that were handed out so far, in order."""
    return list(_made)


def clean(spark: SparkSession, paths: list[str]) -> None:
    """Remove some of them. Results are lazy and read them, so this is for the caller, once a result is written elsewhere."""
    for path in paths:
        fs, place = hadoop(spark, path)
        fs.delete(place, True)
        _made.remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in a new folder: later reads don't compute them again, and survive lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
