"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_own_dir: list[str] = []
_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. One of a few files, which may be of a single row group and so a single task, is spread over all cores; its rows are the same."""
    found, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    files = len(found.inputFiles())
    return found.repartition(cores) if files <= 4 and files < cores else found


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset (tests, one machine)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append(f"file://{tempfile.mkdtemp(prefix='spark-')}")
    return _own_dir[0]


def new_path(spark: SparkSession, name: str) -> str:
    _written.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _written[-1]


def written() -> list[str]:
    """The tables and files that operators have written to the shared folder so far, in order."""
    return list(_written)


def clean(spark: SparkSession, paths: list[str]) -> None:
    """Remove some of them. Results are lazy and read these tables, so this is for the caller, once a result is written elsewhere."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _written.remove(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by a Parquet table in the shared folder; later reads survive lost executors and prune columns."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """Mark a materialised table of narrow rows for broadcast if its counted rows are few; otherwise leave the join to shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def free_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names that df doesn't have (in any case), one like each base."""
    return beside(df.columns, list(bases))


def beside(keep: list[str], results: list[str]) -> list[str]:
    """Names for result columns beside kept ones: a name that is taken gets an underscore behind it."""
    taken, out = {c.lower() for c in keep}, []
    for name in results:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column name as an expression, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def portions(texts, chars: int = 500_000):
    """The texts (null: empty) in lists of about so many characters, so that words are looked up together and memory stays bounded."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))
