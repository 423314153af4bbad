"""Landed pages of a listing as a data source, and numbered batches as a sink.

    <path>/page_no=<n>/*.json    {"data": {"items": [node, ...], "has_more": true}}, one object a page

The listing ends with the page whose has_more is false, whatever older pages lie behind it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    LessThan, LessThanOrEqual, WriterCommitMessage,
)

from ..shipping import ship

_TEXTS = ("node_token", "parent_node_token", "obj_token", "obj_type", "title", "obj_edit_time")
NODES = T.StructType([T.StructField("page_no", T.LongType()), T.StructField("item", T.IntegerType()), *[T.StructField(n, T.StringType()) for n in _TEXTS], T.StructField("has_child", T.BooleanType())])
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
_PUSH = "spark.sql.python.filterPushdown.enabled"
#: Rows of a batch that a task hands to Spark.
_ROWS = 10_000


def files(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder that all executors reach, by its scheme; s3a and s3n are names that only Spark has for s3."""
    path = re.sub("^s3[an]:", "s3:", path)
    return pyarrow.fs.FileSystem.from_uri(path if re.match(r"[a-z0-9]+:", path) else f"file://{path}")


def _page_numbers(fs: pyarrow.fs.FileSystem, base: str) -> list[int]:
    found = fs.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True))
    return sorted(int(m[1]) for f in found if (m := re.fullmatch("page_no=([0-9]+)", f.base_name)))


def _page(fs: pyarrow.fs.FileSystem, base: str, number: int) -> dict:
    """The items of a page and whether more follow; of a page that was landed twice, one."""
    for f in sorted(fs.get_file_info(pyarrow.fs.FileSelector(f"{base}/page_no={number}")), key=lambda f: f.path):
        if f.is_file and f.size and not f.base_name.startswith(("_", ".")):
            with fs.open_input_stream(f.path) as stream:
                return json.loads(stream.read().decode().split("\n")[0]).get("data") or {}
    return {}


@dataclass
class PageRange(InputPartition):
    first: int
    last: int


def _batches(path: str, part: PageRange, names: list[str], same: dict[str, object]) -> Iterator[pa.RecordBatch]:
    fs, base = files(path)
    kinds = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in NODES if f.name in names])
    rows: list[dict] = []
    for number in range(part.first, part.last + 1):
        for i, node in enumerate(_page(fs, base, number).get("items") or []):
            row = {**node, "page_no": number, "item": i}
            if all(row.get(k) == v for k, v in same.items()):
                rows.append({n: row.get(n) for n in kinds.names})
        if len(rows) >= _ROWS:
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
            rows = []
    yield pa.RecordBatch.from_pylist(rows, schema=kinds)


class PageSource(DataSource):
    """Options: path; columns (all, if not given); last (the last page to read); pages_per_task; max_pages (of a micro-batch)."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> T.StructType:
        wanted = self.options.get("columns")
        return NODES if not wanted else T.StructType([f for f in NODES if f.name in wanted.split(",")])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PageReader(self.options, schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PageStream(self.options, schema)


class PageReader(DataSourceReader):
    """A partition is a range of pages. Bounds on page_no leave pages unread; equalities on other columns are tested before rows are made."""

    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.names = options["path"], schema.names
        self.step, self.high = int(options.get("pages_per_task", 100)), int(options["last"]) if "last" in options else None
        self.low, self.only, self.same = 0, None, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name == "page_no" and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = values if self.only is None else self.only & values
            elif name == "page_no" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            elif name == "page_no" and isinstance(f, (LessThan, LessThanOrEqual)):
                most = f.value - isinstance(f, LessThan)
                self.high = most if self.high is None else min(self.high, most)
            elif isinstance(f, EqualTo) and name in self.names and name != "item" and name not in self.same:
                self.same[name] = f.value
            else:
                yield f

    def partitions(self) -> Sequence[PageRange]:
        fs, base = files(self.path)
        pages = [p for p in _page_numbers(fs, base) if p >= self.low and (self.high is None or p <= self.high) and (self.only is None or p in self.only)]
        out: list[PageRange] = []
        for p in pages:
            if out and p == out[-1].last + 1 and p - out[-1].first < self.step:
                out[-1].last = p
            else:
                out.append(PageRange(p, p))
        return out or [PageRange(0, -1)]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        return _batches(self.path, partition, self.names, self.same)


class PageStream(DataSourceStreamReader):
    """Offsets are numbers of pages, and whether the last one was seen; a restarted query begins by asking for the partitions of its last offset. A micro-batch takes the pages that follow without a gap, max_pages at most, up to the one that says it is the last."""

    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.names = options["path"], schema.names
        self.step, self.most = int(options.get("pages_per_task", 100)), int(options.get("max_pages", 1000))
        self.at: int | None = None
        self.ended = False

    def initialOffset(self) -> dict:
        return {"next": 0, "ended": False}

    def latestOffset(self) -> dict:
        fs, base = files(self.path)
        self.at = self.at or 0
        have, upto = set(_page_numbers(fs, base)), self.at
        while not self.ended and upto in have and upto - self.at < self.most:
            self.ended = not _page(fs, base, upto).get("has_more", True)
            upto += 1
        self.at = upto
        return {"next": upto, "ended": self.ended}

    def partitions(self, start: dict, end: dict) -> Sequence[PageRange]:
        self.at, self.ended = max(self.at or 0, end["next"]), self.ended or end["ended"]
        return [PageRange(i, min(i + self.step, end["next"]) - 1) for i in range(start["next"], end["next"], self.step)]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        return _batches(self.path, partition, self.names, {})


def last_page(spark: SparkSession, path: str) -> int | None:
    """The first page that says no more follow, found by Spark from that one field."""
    pages = spark.read.schema("page_no long, data struct<has_more:boolean>").option("basePath", path).json(path)
    return pages.where("not data.has_more").agg(F.min("page_no")).first()[0]


def src_node_pages(spark: SparkSession, path: str, columns: list[str] | None = None, pages_per_task: int = 100) -> DataFrame:
    """Nodes of a landed listing with page_no and item, their place; pages behind the last one aren't read. Filters on the result reach the source."""
    ship(spark)
    spark.dataSource.register(PageSource)
    spark.conf.set(_PUSH, "true")
    last = last_page(spark, path)
    options = {"path": path, "pages_per_task": str(pages_per_task)} | ({} if last is None else {"last": str(last)}) | ({"columns": ",".join(columns)} if columns else {})
    return spark.read.format("landed_pages").options(**options).load()


def stream_node_pages(spark: SparkSession, path: str, pages_per_task: int = 100, max_pages: int = 1000) -> DataFrame:
    """The same listing as a stream that follows the pages as they land, and stops at the last one."""
    ship(spark)
    spark.dataSource.register(PageSource)
    return spark.readStream.format("landed_pages").options(path=path, pages_per_task=str(pages_per_task), max_pages=str(max_pages)).load()


# --- numbered batches


@dataclass
class Attempt(WriterCommitMessage):
    folder: str
    n_batches: int


class BatchSink(DataSource):
    """Rows (batch, body) as a file a batch, in the order in which they come. Options: path."""

    @classmethod
    def name(cls) -> str:
        return "numbered_batches"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return BatchWriter(self.options["path"])


class BatchWriter(DataSourceArrowWriter):
    """A task writes its batches into a folder of this attempt; the driver's commit names the folders of the attempts that count.

    A task that failed, or ran twice, leaves a folder that no commit names. Rows of a batch stand together.
    """

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        fs, base = files(self.path)
        folder = f"attempt-{uuid.uuid4().hex}"
        fs.create_dir(f"{base}/{folder}", recursive=True)
        done, name, out = 0, None, None
        try:
            for part in iterator:
                for batch, body in zip(part.column("batch").to_pylist(), part.column("body").to_pylist(), strict=True):
                    if batch != name:
                        if out:
                            out.close()
                        name, done = batch, done + 1
                        out = fs.open_output_stream(f"{base}/{folder}/{batch}.json")
                    out.write(body.encode() + b"\n")
        finally:
            if out:
                out.close()
        return Attempt(folder, done)

    def commit(self, messages: list[Attempt | None]) -> None:
        fs, base = files(self.path)
        done = [m for m in messages if m and m.n_batches]
        name = f"{base}/commit-{uuid.uuid4().hex}.json"
        with fs.open_output_stream(f"{name}.tmp") as f:
            f.write(json.dumps([m.folder for m in done]).encode())
        fs.move(f"{name}.tmp", name)

    def abort(self, messages: list[Attempt | None]) -> None:
        fs, base = files(self.path)
        for m in messages:
            if m:
                fs.delete_dir(f"{base}/{m.folder}")


def write_batches(rows: DataFrame, key: str, order: str, path: str) -> None:
    """Write rows with batch_id (see sink_chunked_batches): each batch is one file of JSON lines, named by key and number, in order."""
    ship(rows.sparkSession)
    rows.sparkSession.dataSource.register(BatchSink)
    name = F.concat_ws("-", F.lit("batch"), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col("batch_id").cast("string"))
    framed = rows.select(name.alias("batch"), F.col(order).alias("_order"), F.to_json(F.struct(*rows.columns)).alias("body"))
    framed.repartition("batch").sortWithinPartitions("batch", "_order").select("batch", "body").write.format("numbered_batches").mode("append").save(path)


def committed(path: str) -> list[str]:
    """The folders that commits name."""
    fs, base = files(path)
    commits = [f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True)) if re.fullmatch("commit-[0-9a-f]+[.]json", f.base_name)]
    return [f"{path}/{folder}" for c in sorted(commits) for folder in json.loads(fs.open_input_stream(c).read())]


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all committed batches, with the name of the batch."""
    folders = committed(path)
    found = spark.read.schema(schema).json(folders) if folders else spark.createDataFrame([], schema)
    return found.withColumn("batch", F.regexp_extract(F.input_file_name(), r"([^/]+)[.]json$", 1))
