"""A table in buckets by key: an upsert rewrites the buckets it touches, and a manifest says which files make the table.

    <table>/manifest/v<number>.json   {"batch": ..., "schema": ..., "buckets": {bucket: folder below the table}}
    <table>/v<number>-<id>/bucket=<n>/part-*.parquet

A version is there once its manifest is; readers take the latest one and see all of an upsert or nothing of it. Files
that no version names are removed by vacuum().
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import hadoop


class Conflict(Exception):
    """Another writer made this version first; read again and repeat."""


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, place = hadoop(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(place)) if fs.exists(place) else []


def _read(spark: SparkSession, path: str) -> str:
    fs, place = hadoop(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, text: str) -> None:
    """Written under another name, then renamed, which fails if the name is taken."""
    fs, place = hadoop(spark, path)
    _, own = hadoop(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(own, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(place) or not fs.rename(own, place):
        fs.delete(own, False)
        raise Conflict(path)


def versions(spark: SparkSession, table: str) -> list[int]:
    return [int(n[1:-5]) for n in _names(spark, f"{table}/manifest") if n.startswith("v") and n.endswith(".json")]


def manifest(spark: SparkSession, table: str, version: int | None = None) -> dict:
    """The manifest of a version, the latest if none is named; of no table one without buckets."""
    version = max(versions(spark, table), default=None) if version is None else version
    if version is None:
        return {"version": -1, "batch": None, "schema": None, "n_buckets": None, "buckets": {}}
    return json.loads(_read(spark, f"{table}/manifest/v{version:010d}.json"))


def read_table(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the latest if none is named. Raises ValueError if there is no table."""
    found = manifest(spark, table, version)
    if found["schema"] is None:
        raise ValueError(f"no table at {table}")
    return _rows(spark, table, T.StructType.fromJson(found["schema"]), found["buckets"].values())


def _rows(spark: SparkSession, table: str, schema: T.StructType, folders) -> DataFrame:
    paths = [f"{table}/{f}" for f in folders]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def bucket_of(key: str, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


def last_rows(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key that is largest by order, an aggregate with partial merges; of equals the largest row."""
    others = [c for c in rows.columns if c != key and c not in order]
    best = F.max(F.struct(*order, *others))
    return rows.groupBy(key).agg(best.alias("_row")).select(*[key if c == key else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def upsert(delta: DataFrame, table: str, key: str, order: list[str], n_buckets: int = 64, batch: int | None = None) -> int:
    """Insert or replace by key: of a key's old and new rows the largest by `order` stays. Returns the version.

    Only buckets that hold a key of delta are read and written. A batch whose number is not above that of the table's
    latest batch is left out, so one that runs again changes nothing. delta must have the table's columns; a null key is
    a key. n_buckets holds for a new table; an old one keeps its own. Two writers at once: the later one gets Conflict.
    """
    spark = delta.sparkSession
    found = manifest(spark, table)
    if batch is not None and found["batch"] is not None and batch <= found["batch"]:
        return found["version"]
    n_buckets = found["n_buckets"] or n_buckets
    schema = T.StructType.fromJson(found["schema"]) if found["schema"] else T.StructType([T.StructField(f.name, f.dataType, True) for f in delta.schema])
    new = delta.select(*schema.names).withColumn("bucket", bucket_of(key, n_buckets))
    # numbers of buckets, n_buckets at most
    touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())
    old = _rows(spark, table, schema, [found["buckets"][str(b)] for b in touched if str(b) in found["buckets"]])
    version = found["version"] + 1
    folder = f"v{version:010d}-{uuid.uuid4().hex}"
    if touched:
        merged = last_rows(old.unionByName(new.drop("bucket")), key, order).withColumn("bucket", bucket_of(key, n_buckets))
        merged.repartition(len(touched), "bucket").write.partitionBy("bucket").parquet(f"{table}/{folder}")
    buckets = found["buckets"] | {str(b): f"{folder}/bucket={b}" for b in touched}
    last = found["batch"] if batch is None else batch
    _publish(spark, f"{table}/manifest/v{version:010d}.json", json.dumps({"version": version, "batch": last, "schema": schema.jsonValue(), "n_buckets": n_buckets, "buckets": buckets}))
    return version


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Remove the manifests of all but the last `keep` versions, and the folders that none of these names. Run it while nobody writes.

    Returns what was removed. Readers of a version that is kept aren't disturbed.
    """
    have = sorted(versions(spark, table))
    held = {f"manifest/v{v:010d}.json" for v in have[-keep:]} | {path for v in have[-keep:] for path in manifest(spark, table, v)["buckets"].values()}
    found = [f"manifest/{n}" for n in _names(spark, f"{table}/manifest")]
    for folder in _names(spark, table):
        if folder.startswith("v"):
            found += [f"{folder}/{n}" for n in _names(spark, f"{table}/{folder}") if n.startswith("bucket=")]
    gone = [x for x in found if x not in held]
    for name in gone:
        fs, place = hadoop(spark, f"{table}/{name}")
        fs.delete(place, True)
    for folder in _names(spark, table):
        if folder.startswith("v") and not any(n.startswith("bucket=") for n in _names(spark, f"{table}/{folder}")):
            fs, place = hadoop(spark, f"{table}/{folder}")
            fs.delete(place, True)
    return gone
