"""Content blocks: text, hashes, diff and what a sync would write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Block types by body, types by what a clone does with them, styles of a run. Types without a text body hash by type alone.
FIELD_OF_TYPE = {2: "text", **{t: f"heading{t - 2}" for t in range(3, 12)}, 12: "bullet", 13: "ordered", 14: "code", 15: "quote", 17: "todo", 19: "callout", 34: "quote_container"}
PATCHABLE = [*range(2, 16), 17]
MEDIA = {27: "image", 23: "file", 31: "table", 24: "grid", 43: "board"}
UNSUPPORTED = [18, 22, 30, 40, 50, 53, 55]
STYLES = ["bold", "italic", "underline", "strikethrough", "inline_code", "background_color", "text_color", "link"]


def block_text_field(block_type: Column) -> Column:
    """Name of the body that holds a block's text, null if it has none."""
    return F.element_at(F.create_map(*[F.lit(x) for t, name in FIELD_OF_TYPE.items() for x in (t, name)]), block_type)


def block_text(elements: Column, plain: bool = False) -> Column:
    """Text of an array of elements (kind, content, url, token, title): runs and titles of mentioned documents; plain mode adds equations."""
    kinds = ["text_run", "equation"] if plain else ["text_run"]
    return F.array_join(F.transform(elements, lambda e: F.when(e["kind"].isin(kinds), F.coalesce(e["content"], F.lit(""))).when(e["kind"] == "mention_doc", F.coalesce(e["title"], F.lit(""))).otherwise("")), "")


def text_run(content: Column, url: Column) -> Column:
    """An element that is a run of text with a link."""
    return F.struct(F.lit("text_run").alias("kind"), content.alias("content"), url.alias("url"), F.lit("").alias("token"), F.lit("").alias("title"))


def block_hash(block_type: Column, elements: Column) -> Column:
    """md5 over type, body name and elements: content and url of each run, token, url and title of each mentioned
    document; other elements don't count. A block without a text body hashes its type only."""
    known = lambda e, *names: F.array(*[F.coalesce(e[n], F.lit("")) for n in names])
    parts = F.transform(elements, lambda e: F.when(e["kind"] == "text_run", known(e, "content", "url")).when(e["kind"] == "mention_doc", known(e, "token", "url", "title")).otherwise(F.array().cast("array<string>")))
    return _sealed(block_type, F.coalesce(F.array_join(F.flatten(parts), "\x00"), F.lit("")))


def _sealed(block_type: Column, inner: Column) -> Column:
    body = F.concat(block_text_field(block_type), F.lit("\x02"), inner, F.lit("\x03"))
    return F.md5(F.concat(block_type.cast("string"), F.lit("\x01"), F.coalesce(body, F.lit(""))).cast("binary"))


def run_hash(block_type: Column, content: Column, url: Column) -> Column:
    """block_hash of a block with one run, without an array."""
    return _sealed(block_type, F.concat(F.coalesce(content, F.lit("")), F.lit("\x00"), F.coalesce(url, F.lit(""))))


def hashed(blocks: DataFrame) -> DataFrame:
    """Hashes of blocks with an array of elements, or with one run (content, url) each."""
    kind = F.col("block_type")
    found = block_hash(kind, F.col("elements")) if "elements" in blocks.columns else run_hash(kind, F.col("content"), F.col("url"))
    return blocks.select("doc_id", "idx", "block_id", "block_type", found.alias("hash"))


def block_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Blocks aligned by place: keep, replace, append (source only) or delete (target only). Only ids and hashes are shuffled."""
    s = hashed(source).select("doc_id", "idx", F.col("block_id").alias("src_id"), F.col("hash").alias("src_hash"), F.col("block_type").alias("src_type"))
    t = hashed(target).select("doc_id", "idx", F.col("block_id").alias("dst_id"), F.col("hash").alias("dst_hash"))
    op = F.when(F.col("dst_hash").isNull(), "append").when(F.col("src_hash").isNull(), "delete").when(F.col("src_hash") == F.col("dst_hash"), "keep").otherwise("replace")
    return s.join(t, ["doc_id", "idx"], "full_outer").withColumn("op", op)


def sync_plan_counts(diff: DataFrame) -> DataFrame:
    ops = [F.count_if(F.col("op") == o).alias(f"n_{o}") for o in ("replace", "append", "delete", "keep")]
    changes = F.col("n_replace") + F.col("n_append") + F.col("n_delete")
    return diff.groupBy("doc_id").agg(*ops).withColumns({"total_changes": changes, "is_no_op": changes == 0, "saved_calls": F.col("n_keep")})


def sync_patch_rows(diff: DataFrame, source: DataFrame) -> DataFrame:
    """Bodies for replaced blocks whose type can be patched; others are passed over."""
    return diff.where(F.col("op").eqNullSafe("replace") & F.col("src_type").isin(PATCHABLE)).select("doc_id", "idx", "dst_id").join(source.select("doc_id", "idx", "content", "url"), ["doc_id", "idx"])


def sync_create_rows(diff: DataFrame, source: DataFrame) -> DataFrame:
    """Appended blocks without their ids."""
    return diff.where("op = 'append'").select("doc_id", "idx").join(source.select("doc_id", "idx", "block_type", "content", "url"), ["doc_id", "idx"])


def sync_status(counts: DataFrame, results: DataFrame) -> DataFrame:
    """NoChange, Synced, PartialFail or Failed. results: doc_id, n_ok, n_failed; deletes are planned, never run."""
    ok, failed = F.coalesce("n_ok", F.lit(0)), F.coalesce("n_failed", F.lit(0))
    status = F.when(F.col("is_no_op"), "NoChange").when(failed == 0, "Synced").when(ok > 0, "PartialFail").otherwise("Failed")
    return counts.join(results, "doc_id", "left").select("doc_id", "total_changes", status.alias("status"))


def mirror_outcome(statuses: DataFrame) -> DataFrame:
    """statuses: status, title, title_translated."""
    return statuses.withColumns({"outcome": F.when(F.col("status").isin("Synced", "NoChange", "PartialFail"), "OK").otherwise("FAIL"), "new_title": F.coalesce(F.nullif("title_translated", F.lit("")), "title")})


def clone_dispatch(blocks: DataFrame) -> DataFrame:
    """What cloning does with each block. Media without a token counts as skipped and as recreated."""
    t = F.col("block_type")
    media = F.coalesce(*[F.when(t == k, "image" if v == "board" else v) for k, v in MEDIA.items()])
    action = F.when(t.isNull() | t.isin(UNSUPPORTED), "skipped").when(media.isNotNull(), media).when(block_text_field(t).isNotNull(), "text").otherwise("generic")
    empty = action.isin("image", "file") & (F.coalesce("media_token", F.lit("")) == "")
    return blocks.withColumns({"action": action, "is_skipped": (action == "skipped") | empty, "is_recreated": action != "skipped"})


def clone_stats(dispatch: DataFrame, failures: DataFrame) -> DataFrame:
    """Totals of a document; it fails only if more blocks failed than were recreated. failures: doc_id, n_failed."""
    n = dispatch.groupBy("doc_id").agg(F.count("*").alias("n_total"), F.count_if("is_skipped").alias("n_skipped"), F.count_if("is_recreated").alias("n_recreated"))
    failed = F.coalesce("n_failed", F.lit(0))
    return n.join(failures, "doc_id", "left").withColumn("n_failed", failed).withColumn("outcome", F.when(F.col("n_failed") > F.col("n_recreated"), "FAIL").otherwise("OK"))


def clone_body(dispatch: DataFrame) -> DataFrame:
    """The new block: text with its elements, a table of rows x columns (1 by default), a grid of columns (2 by default), a file's name."""
    a = F.col("action")
    return dispatch.where("action <> 'skipped'").select(
        "doc_id", "idx", "block_type", F.when(a == "text", F.col("content")).alias("content"), F.when(a == "table", F.coalesce("rows", F.lit(1))).alias("rows"),
        F.when(a == "table", F.coalesce("cols", F.lit(1))).when(a == "grid", F.coalesce("cols", F.lit(2))).alias("cols"), F.when(a == "file", F.coalesce("file_name", F.lit("file"))).alias("file_name"),
    )


def media_tokens(blocks: DataFrame) -> DataFrame:
    kind = F.coalesce(*[F.when(F.col("block_type") == k, v) for k, v in MEDIA.items() if v in ("image", "file", "board")])
    return blocks.withColumn("kind", kind).where("kind is not null and coalesce(media_token, '') <> ''").select("doc_id", "idx", "media_token", "kind")


def media_cache_split(media: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(uses with their known target, distinct tokens to fetch)."""
    return media.join(cache, "media_token"), media.join(cache, "media_token", "left_anti").select("media_token").distinct()


def style_filter(style: Column) -> Column:
    return F.map_filter(style, lambda k, _: k.isin(STYLES))
