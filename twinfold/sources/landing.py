"""Reading landed JSON pages, records, blocks and logs, and looking at files."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .pages import files

NODE = "node_token string, parent_node_token string, obj_token string, obj_type string, title string, obj_edit_time string, has_child boolean"
LOG = "correlation_id string, stage string, record string, event string, seconds double, _corrupt_record string"
PART_BYTES = 4 << 20
WHOLE_BYTES = 20 << 20


def src_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of page dumps {page_no, data: {items: [...], has_more}} with pos, their place over pages."""
    pages = spark.read.schema(f"page_no long, data struct<items:array<struct<{NODE.replace(' ', ':').replace(',:', ',')}>>,has_more:boolean>").json(path)
    rows = pages.select("page_no", F.posexplode("data.items").alias("i", "node"))
    # pages are of one size but the last, so a place needs no global numbering
    return rows.select((F.col("page_no") * 1_000_000 + F.col("i")).alias("pos"), "node.*")


def src_records(spark: SparkSession, path: str, where: str = "true", order: str | None = None, fields: list[str] | None = None) -> DataFrame:
    """State records {record_id, fields{}} as text fields, filtered, sorted and cut to some fields."""
    rows = spark.read.schema("record_id string, fields map<string,string>").json(path).where(where)
    rows = rows.orderBy(order) if order else rows
    return rows.select("record_id", *[F.col("fields")[f].alias(f) for f in fields]) if fields else rows


def src_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of document dumps {doc_id, items: [...]} in order."""
    rows = spark.read.schema("doc_id long, items array<struct<block_id:string,parent_id:string,block_type:int,content:string,url:string>>").json(path)
    return rows.select("doc_id", F.posexplode("items").alias("idx", "b")).select("doc_id", "idx", "b.*")


def src_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of a log; lines that don't parse keep their text in _corrupt_record."""
    return spark.read.schema(LOG).json(path)


def parse_link_field(raw: Column) -> Column:
    """struct(link, text) from a raw JSON value: a string is both, of a list the first counts, anything else is empty."""
    first = F.when(F.rlike(raw, F.lit(r"^\s*\[")), F.get_json_object(raw, "$[0]")).otherwise(raw)
    link, text = F.get_json_object(first, "$.link"), F.get_json_object(first, "$.text")
    plain = F.when(F.rlike(first, F.lit(r'^\s*"')), F.get_json_object(F.concat(F.lit('{"x":'), first, F.lit("}")), "$.x")).when(~F.rlike(first, F.lit(r"^\s*([\[{\"]|null|true|false|-?\d)")), first)
    return F.struct(F.coalesce(link, plain, F.lit("")).alias("link"), F.coalesce(text, plain, F.lit("")).alias("text"))


def parse_text_field(raw: Column) -> Column:
    """Text of a raw JSON value: null is empty, of a list the first element's text, of an object its text."""
    return F.when(raw.isNull() | (raw == "null"), "").when(F.rlike(raw, F.lit(r"^\s*\[")), F.coalesce(F.get_json_object(raw, "$[0].text"), F.lit(""))).when(F.rlike(raw, F.lit(r"^\s*\{")), F.coalesce(F.get_json_object(raw, "$.text"), F.lit(""))).otherwise(raw)


def parse_record_fields(records: DataFrame) -> DataFrame:
    """Typed columns of records (record_id, fields as JSON text); numbers that don't parse become null."""
    f = lambda name: F.get_json_object("fields", f"$.{name}")
    return records.select("record_id", parse_text_field(f("title")).alias("title"), f("stt").try_cast("int").alias("stt"), f("pct").try_cast("double").alias("pct"), parse_link_field(f("link")).alias("link"))


def media_kind(head: Column) -> Column:
    """File kind by its first bytes."""
    starts = lambda *hexes: F.coalesce(*[F.when(F.substring(F.hex(head), 1, len(x)) == x, True) for x in hexes], F.lit(False))
    at4, at8 = F.substring(F.hex(head), 9, 8), F.substring(F.hex(head), 17, 8)
    return F.when(starts("FFD8FF"), "jpg").when(starts("89504E47"), "png").when(starts("474946"), "gif").when(starts("52494646") & (at8 == "57454250"), "webp").when(starts("25504446"), "pdf").when(at4 == "66747970", "mp4").otherwise("bin")


def upload_name(node: Column, kind: Column) -> Column:
    """The name of a file that came without one."""
    return F.concat(F.lit("upload_"), node, F.lit("."), kind)


def src_media(spark: SparkSession, path: str) -> DataFrame:
    """path, size and kind of the files below a folder. Lengths come from the listing, and of the contents only the first sixteen bytes are read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"))

    def heads(batches):
        for batch in batches:
            out = []
            for place in batch.column("path").to_pylist():
                fs, name = files(place)
                with fs.open_input_stream(name) as f:
                    out.append(f.read(16))
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("size"), pa.array(out, pa.binary())], names=["path", "size", "head"])

    return map_arrow(found, heads, "path string, size long, head binary").select("path", "size", media_kind(F.col("head")).alias("kind"))


def media_part_plan(files: DataFrame, part: int = PART_BYTES, whole: int = WHOLE_BYTES) -> DataFrame:
    """Upload parts (id, seq, start, part_size) of files (id, size); small ones go whole."""
    step = F.when(F.col("size") <= whole, F.greatest("size", F.lit(1))).otherwise(F.lit(part))
    n = F.greatest(F.ceil(F.col("size") / step), F.lit(1))
    return files.withColumn("_step", step).select("id", "size", "_step", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("seq")).select("id", "seq", (F.col("seq") * F.col("_step")).alias("start"), F.least("_step", F.col("size") - F.col("seq") * F.col("_step")).alias("part_size"))


def numbered(rows: DataFrame, key: str, order: str) -> DataFrame:
    """rows with n, their number within key."""
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(order)))
