"""Queries on landing, parsing and write-side table operations. Landed JSON is derived from the tables, written, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..shipping import map_arrow
from ..sources import buckets as B
from ..sources import landing as D
from ..sources import pages as G
from ..sources import sinks as W
from .base import Registry, new_folder

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
add = R.add


def _land(t, df) -> str:
    path = new_folder(t.spark, "landed")
    df.write.json(path)
    return path


def _nodes(t):
    node = F.struct(F.col("node_token"), F.col("parent_token").alias("parent_node_token"), F.col("obj_token"), F.lit("docx").alias("obj_type"), F.col("title"), F.col("edit_ms").cast("string").alias("obj_edit_time"), F.col("has_child"))
    pages = t.nodes.groupBy(F.floor(F.col("pos") / 50).alias("page_no")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", node.alias("n")))), lambda x: x["n"]).alias("items"))
    return D.src_nodes(t.spark, _land(t, pages.select("page_no", F.struct("items", F.lit(True).alias("has_more")).alias("data")))).select("pos", "node_token", "parent_node_token", "title", "obj_edit_time", "has_child")


def _node_pages(t):
    """Pages of fifty as files of their own, of which the last third stands behind the one that says it is the last."""
    node = F.struct("node_token", F.col("parent_token").alias("parent_node_token"), "obj_token", F.lit("docx").alias("obj_type"), "title", F.col("edit_ms").cast("string").alias("obj_edit_time"), "has_child")
    pages = t.nodes.groupBy(F.floor(F.col("pos") / 50).alias("page_no")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", node.alias("n")))), lambda x: x["n"]).alias("items"))
    final = t.nodes.agg(F.floor(F.max("pos") / 75).alias("final"))
    ended = pages.crossJoin(F.broadcast(final)).select("page_no", F.struct("items", (F.col("page_no") != F.col("final")).alias("has_more")).alias("data"))
    path = new_folder(t.spark, "pages")
    ended.write.partitionBy("page_no").json(path)
    return G.src_node_pages(t.spark, path, ["page_no", "item", "node_token", "parent_node_token", "title", "has_child"], 10).where("page_no >= 1 and has_child = true")


def _batch_files(t):
    path = new_folder(t.spark, "batches")
    rows = t.orders.select(F.pmod(F.col("o_custkey"), F.lit(8)).alias("bucket"), "o_orderkey")
    G.write_batches(W.sink_chunked_batches(rows, "bucket", "o_orderkey", span=1000), "bucket", "o_orderkey", path)
    return G.read_batches(t.spark, path, "bucket long, o_orderkey long").select("batch", "o_orderkey")


def _records(t):
    rows = t.state.select("record_id", F.create_map(F.lit("status"), F.col("status"), F.lit("title"), F.col("title")).alias("fields"))
    return D.src_records(t.spark, _land(t, rows), "fields['status'] <> 'Done'", None, ["status", "title"])


def _blocks(t):
    item = F.struct("block_id", F.lit("").alias("parent_id"), "block_type", "content", "url")
    docs = t.source_blocks.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", item.alias("b")))), lambda x: x["b"]).alias("items"))
    return D.src_blocks(t.spark, _land(t, docs)).drop("parent_id")


def _logs(t):
    rows = t.outcomes.select(F.col("run_id").alias("correlation_id"), "stage", F.col("record_id").alias("record"), F.col("outcome").alias("event"), F.floor("seconds").cast("double").alias("seconds"))
    return D.src_log_lines(t.spark, _land(t, rows)).where("_corrupt_record is null").drop("_corrupt_record")


add(
    "src_nodes",
    _nodes,
    "nodes",
    """
    SELECT CAST(floor(pos / 50.0) AS BIGINT) * 1000000 + row_number() OVER (PARTITION BY floor(pos / 50.0) ORDER BY pos) - 1 AS pos, node_token, parent_token AS parent_node_token, title, CAST(edit_ms AS VARCHAR) AS obj_edit_time, has_child
    FROM nodes""",
)
add("src_node_pages", _node_pages, "nodes", """
WITH p AS (SELECT *, CAST(floor(pos / 50.0) AS BIGINT) AS page_no, CAST(row_number() OVER (PARTITION BY floor(pos / 50.0) ORDER BY pos) - 1 AS INTEGER) AS item FROM nodes)
SELECT page_no, item, node_token, parent_token AS parent_node_token, title, has_child FROM p WHERE page_no >= 1 AND has_child AND page_no <= (SELECT CAST(floor(max(pos) / 75.0) AS BIGINT) FROM nodes)""")
add("src_records", _records, "state", "SELECT record_id, status, title FROM state WHERE status <> 'Done'")
add("src_blocks", _blocks, "source_blocks", "SELECT doc_id, idx, block_id, block_type, content, url FROM source_blocks")
add(
    "src_log_lines",
    _logs,
    "outcomes",
    """
    SELECT run_id AS correlation_id, stage, record_id AS record, outcome AS event, CAST(floor(seconds) AS DOUBLE) AS seconds
    FROM outcomes""",
)
_raw = lambda k: F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.to_json(F.struct(F.concat(F.lit("https://x/"), k).alias("link"), F.lit("t").alias("text")))).when(k % 5 == 2, F.to_json(F.array(F.struct(F.concat(F.lit("https://y/"), k).alias("link"))))).when(k % 5 == 3, F.concat(F.lit('"plain '), k.cast("string"), F.lit('"'))).otherwise(F.lit("17"))
add(
    "parse_link_field",
    lambda t: t.documents.select("doc_id", D.parse_link_field(_raw(F.col("doc_id"))).alias("l")).select("doc_id", "l.link", "l.text"),
    "",
    """
    SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN 'https://x/' || doc_id WHEN 2 THEN 'https://y/' || doc_id WHEN 3 THEN 'plain ' || doc_id ELSE '' END AS link, CASE doc_id % 5 WHEN 1 THEN 't' WHEN 3 THEN 'plain ' || doc_id ELSE '' END AS text
    FROM documents""",
)
_fields = lambda: F.to_json(F.struct(F.concat(F.lit("title "), "doc_id").alias("title"), F.when(F.col("doc_id") % 3 == 0, "not-a-number").otherwise(F.col("doc_id").cast("string")).alias("stt"), (F.col("doc_id") / 4).cast("string").alias("pct"), F.struct(F.lit("u").alias("link")).alias("link")))
add(
    "parse_record_fields",
    lambda t: D.parse_record_fields(t.documents.select(F.concat(F.lit("r"), "doc_id").alias("record_id"), _fields().alias("fields"))).select("record_id", "title", "stt", "pct", "link.link"),
    "",
    """
    SELECT 'r' || doc_id AS record_id, 'title ' || doc_id AS title, CASE WHEN doc_id % 3 <> 0 THEN CAST(doc_id AS INTEGER) END AS stt, doc_id / 4 AS pct, 'u' AS link
    FROM documents""",
)
add(
    "sink_chunked_batches",
    lambda t: W.sink_chunked_batches(t.orders.select(F.pmod(F.col("o_custkey"), F.lit(8)).alias("bucket"), "o_orderkey"), "bucket", "o_orderkey", span=1000),
    "",
    """
    SELECT o_custkey % 8 AS bucket, o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_custkey % 8 ORDER BY o_orderkey) - 1) / 500.0) AS BIGINT) AS batch_id
    FROM orders""",
)
add("sink_batch_files", _batch_files, "", """
SELECT 'batch-' || (o_custkey % 8) || '-' || CAST(floor((row_number() OVER (PARTITION BY o_custkey % 8 ORDER BY o_orderkey) - 1) / 500.0) AS BIGINT) AS batch, o_orderkey FROM orders""")
_old = lambda t: t.items.where("idx % 2 = 0").select(F.col("text").alias("key"), F.lit("old").alias("value"), F.lit(0).cast("long").alias("at")).dropDuplicates(["key"])
_new = lambda t: t.items.where("idx % 3 = 0").select(F.col("text").alias("key"), F.concat(F.lit("v"), F.col("doc_id") * 100000 + F.col("idx")).alias("value"), (F.col("doc_id") * 100000 + F.col("idx")).alias("at"))
_UPSERT_SQL = """WITH n AS (SELECT text AS key, max(doc_id * 100000 + idx) AS "at" FROM items WHERE idx % 3 = 0 GROUP BY text)
SELECT key, 'v' || "at" AS value, "at" FROM n UNION ALL SELECT DISTINCT text, 'old', 0 FROM items WHERE idx % 2 = 0 AND text NOT IN (SELECT key FROM n)"""
add("sink_upsert", lambda t: W.sink_upsert(_old(t), _new(t), "key", "at"), "items", _UPSERT_SQL)


def _upsert_table(t):
    """The old rows and then the new ones go into a table of buckets; one batch comes twice."""
    table = new_folder(t.spark, "upserted")
    B.upsert(_old(t), table, "key", ["at", "value"], 16, batch=0)
    for _ in range(2):
        B.upsert(_new(t), table, "key", ["at", "value"], batch=1)
    return B.read_table(t.spark, table)


add("sink_upsert_table", _upsert_table, "items", _UPSERT_SQL)


def _insert_ignore(t):
    lines = t.lineitem.select("l_linenumber", F.concat(F.lit("k"), "l_orderkey").alias("run_id"), F.concat(F.lit("p"), F.col("l_partkey") % 10).alias("token"), F.col("l_linenumber").alias("at"))
    there = lines.where("l_linenumber <= 2").groupBy("run_id", "token").agg(F.max("at").alias("at"))
    return W.sink_insert_ignore(there, lines.where("l_linenumber > 2").drop("l_linenumber"), ["run_id", "token"], "at")


add("sink_insert_ignore", _insert_ignore, "", """
WITH l AS (SELECT 'k' || l_orderkey AS run_id, 'p' || (l_partkey % 10) AS token, l_linenumber AS "at" FROM lineitem), t AS (SELECT run_id, token, max("at") AS "at" FROM l WHERE "at" <= 2 GROUP BY ALL)
SELECT * FROM t UNION ALL SELECT run_id, token, min("at") FROM l WHERE "at" > 2 AND NOT EXISTS (SELECT 1 FROM t WHERE t.run_id = l.run_id AND t.token = l.token) GROUP BY run_id, token""")
_MAGIC = ["FFD8FFE0", "89504E470D0A", "474946383961", "524946460000000057454250", "255044462D", "0000001866747970", "00112233"]
_head = lambda: F.unhex(F.element_at(F.array(*[F.lit(m) for m in _MAGIC]), (F.col("doc_id") % 7 + 1).cast("int")))
add(
    "media_kind",
    lambda t: t.documents.select("doc_id", D.media_kind(F.concat(_head(), F.col("text").cast("binary"))).alias("kind")).withColumn("name", D.upload_name(F.concat(F.lit("n"), "doc_id"), F.col("kind"))),
    "",
    "SELECT doc_id, ['jpg', 'png', 'gif', 'webp', 'pdf', 'mp4', 'bin'][doc_id % 7 + 1] AS kind, 'upload_n' || doc_id || '.' || ['jpg', 'png', 'gif', 'webp', 'pdf', 'mp4', 'bin'][doc_id % 7 + 1] AS name FROM documents",
)


def _media_files(t):
    """Every page's html as a file, behind the first bytes of one kind or another; a task writes the files of its rows."""
    path = new_folder(t.spark, "media")
    rows = t.pages.select("page_id", F.concat(F.unhex(F.element_at(F.array(*[F.lit(m) for m in _MAGIC]), (F.col("page_id") % 7 + 1).cast("int"))), F.col("html").cast("binary")).alias("body"))

    def put(batches):
        fs, base = G.files(path)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for page, body in zip(batch.column("page_id").to_pylist(), batch.column("body").to_pylist(), strict=True):
                with fs.open_output_stream(f"{base}/page-{page}") as f:
                    f.write(body)
            yield batch.select(["page_id"])

    map_arrow(rows, put, "page_id long").write.format("noop").mode("overwrite").save()
    found = D.src_media(t.spark, path).withColumn("id", F.regexp_extract("path", "page-([0-9]+)$", 1).cast("long"))
    parts = D.media_part_plan(found.select("id", "size"), 1024, 4096)
    return found.join(parts, "id").select("id", "size", "kind", "seq", "start", "part_size")


add("src_media", _media_files, "", """
WITH f AS (SELECT page_id AS id, octet_length(encode(html)) + [4, 6, 6, 12, 5, 8, 4][page_id % 7 + 1] AS size, ['jpg', 'png', 'gif', 'webp', 'pdf', 'mp4', 'bin'][page_id % 7 + 1] AS kind FROM pages),
s AS (SELECT *, CASE WHEN size <= 4096 THEN greatest(size, 1) ELSE 1024 END AS step FROM f), n AS (SELECT *, unnest(range(0, greatest(CAST(ceil(size / step) AS BIGINT), 1))) AS seq FROM s)
SELECT id, size, kind, seq, seq * step AS start, least(step, size - seq * step) AS part_size FROM n""")
add("media_part_plan", lambda t: D.media_part_plan(t.documents.select(F.col("doc_id").alias("id"), (F.col("n_chars") * 9000).alias("size"))), "", """
WITH f AS (SELECT doc_id AS id, n_chars * 9000 AS size, CASE WHEN n_chars * 9000 <= 20971520 THEN greatest(n_chars * 9000, 1) ELSE 4194304 END AS step FROM documents), s AS (SELECT *, unnest(range(0, greatest(CAST(ceil(size / step) AS BIGINT), 1))) AS seq FROM f)
SELECT id, seq, seq * step AS start, least(step, size - seq * step) AS part_size FROM s""")
