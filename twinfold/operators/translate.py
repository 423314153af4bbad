"""Preparing text for batch translation and taking the replies back."""

from __future__ import annotations

from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CJK, assess_quality, cache_key, clean_artifacts, has_cjk
from ..shipping import map_arrow, map_pandas
from ..staging import written
from .blocks import block_text_field
from .joins import partner, spread

MARK = "<<<item-{}>>>"


def quality_summary(pairs: DataFrame, pattern: str = CJK) -> DataFrame:
    """Rows by issue ("passed" and "failed" among them)."""
    q = pairs.select(assess_quality(F.col("input"), F.col("output"), pattern).alias("q"))
    return q.select(F.explode(F.concat("q.issues", F.array(F.when(F.col("q.passed"), "passed").otherwise("failed")))).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


def glossary_lookup(items: DataFrame, glossary: DataFrame, max_len: int = 20) -> DataFrame:
    """items with the glossary's translation of the whole trimmed text; the first section wins. The glossary is a hand-made list of a few hundred entries at most, checked here."""
    first = Window.partitionBy("src").orderBy("section_order", "entry_order")
    entries = glossary.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(partner(F.col("src")).alias("_key"), F.col("dst").alias("glossary_text"))
    side = F.broadcast(entries) if glossary.limit(100_001).count() <= 100_000 else entries
    trimmed = F.trim("text")
    # most texts are too long for an entry; where the glossary is too large to be sent to all, they are spread
    return items.withColumn("_key", spread(items, F.when(F.length(trimmed) <= max_len, trimmed))).join(side, "_key", "left").drop("_key")


def glossary_render(glossary: DataFrame, n: int = 10) -> DataFrame:
    """A line a section with its first n entries."""
    top = glossary.withColumn("_n", F.row_number().over(Window.partitionBy("section").orderBy("entry_order"))).where(F.col("_n") <= n)
    return top.groupBy("section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("entry_order", "src", "dst"))), lambda x: F.concat(x["src"], F.lit("→"), x["dst"])), " | ").alias("_body")).select("section", F.concat(F.lit("- "), "section", F.lit(": "), "_body").alias("line"))


def skipped_blocks(blocks: DataFrame, pattern: str = CJK) -> DataFrame:
    """Per document how many blocks translatable_blocks leaves out, by the first reason that holds: no text kind, no id, blank, nothing to translate."""
    text = F.coalesce("content", F.lit(""))
    reason = F.when(block_text_field(F.col("block_type")).isNull(), "not_text").when(F.coalesce("block_id", F.lit("")) == "", "no_id").when(F.trim(text) == "", "blank").when(~F.coalesce(has_cjk(F.col("content"), pattern), F.lit(False)), "nothing_to_translate")
    n = lambda r: F.count_if(F.col("_reason") == r).alias(f"n_{r}")
    return blocks.withColumn("_reason", reason).groupBy("doc_id").agg(F.count("*").alias("n_blocks"), n("not_text"), n("no_id"), n("blank"), n("nothing_to_translate"))


def translatable_blocks(blocks: DataFrame, pattern: str = CJK) -> DataFrame:
    """Text blocks with an id and text that needs translating."""
    return blocks.where(block_text_field(F.col("block_type")).isNotNull() & (F.coalesce("block_id", F.lit("")) != "") & (F.trim(F.coalesce("content", F.lit(""))) != "") & has_cjk(F.col("content"), pattern))


def route_items(items: DataFrame, glossary: DataFrame, cache: DataFrame, pattern: str = CJK) -> DataFrame:
    """items with route (skip, glossary, cache, pending), key and the text known so far. cache: key, translated."""
    keyed = glossary_lookup(items, glossary).withColumn("key", cache_key(F.col("text"))).join(cache, "key", "left")
    skip = (F.trim("text") == "") | ~has_cjk(F.col("text"), pattern)
    route = F.when(skip, "skip").when(F.col("glossary_text").isNotNull(), "glossary").when(F.col("translated").isNotNull(), "cache").otherwise("pending")
    return keyed.withColumn("route", route).withColumn("out", F.when(F.col("route") == "skip", F.col("text")).when(F.col("route") == "glossary", F.col("glossary_text")).when(F.col("route") == "cache", F.col("translated"))).drop("glossary_text", "translated")


def pending_once(routed: DataFrame) -> DataFrame:
    """Each different pending text once: repeated lines go to the costly step a single time."""
    return routed.where("route = 'pending'").groupBy("key").agg(F.min("text").alias("text"), F.count("*").alias("n_uses"))


def pack_batches(items: DataFrame, max_chars: int = 4000, max_items: int = 30) -> DataFrame:
    """(doc_id, idx, batch_no): greedy in order of idx within a document.

    Only places and lengths are shuffled. Sorted rows stream through with three numbers carried from row to row, so
    that neither many small documents nor a huge one cost more than their rows.
    """

    def pack(parts):
        doc, batch, chars, n = None, 0, 0, 0
        for part in parts:
            out = []
            for key, size in zip(part["doc_id"].tolist(), part["len"].tolist(), strict=True):
                if key != doc:
                    doc, batch, chars, n = key, 0, 0, 0
                elif chars + size > max_chars or n >= max_items:
                    batch, chars, n = batch + 1, 0, 0
                out.append(batch)
                chars, n = chars + size, n + 1
            yield pd.DataFrame({"doc_id": part["doc_id"], "idx": part["idx"], "batch_no": out})

    dealt = items.select("doc_id", F.col("idx").cast("long").alias("idx"), F.length("text").alias("len")).repartition("doc_id").sortWithinPartitions("doc_id", "idx")
    return map_pandas(dealt, pack, "doc_id long, idx long, batch_no long")


def batch_message(packed: DataFrame) -> DataFrame:
    """A message a batch: a numbered mark before each text. packed: doc_id, idx, batch_no, text."""
    numbered = packed.withColumn("_i", F.row_number().over(Window.partitionBy("doc_id", "batch_no").orderBy("idx")) - 1)
    head, tail = MARK.split("{}")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("_i", "text"))), lambda x: F.concat(F.lit(head), x["_i"].cast("string"), F.lit(tail + "\n"), x["text"]))
    return numbered.groupBy("doc_id", "batch_no").agg(F.array_join(lines, "\n").alias("message"), F.count("*").alias("n_items"))


def parse_batch_response(raw: Column, n: Column, clean: bool = True) -> Column:
    """array<struct<i, text>> of a reply, null unless its marks are exactly 0..n-1."""
    body = clean_artifacts(raw) if clean else raw
    found = F.transform(F.regexp_extract_all(body, F.lit("<<<item-(\\d+)>>>"), F.lit(1)), lambda x: x.cast("int"))
    parts = F.transform(F.slice(F.split(body, "<<<item-\\d+>>>", -1), 2, F.greatest(F.size(found), F.lit(1))), lambda x: F.regexp_replace(x, "(?U)^\\s+|\\s+$", ""))
    good = (F.size(found) == n) & (F.array_sort(found) == F.sequence(F.lit(0), n - 1))
    return F.when(good, F.zip_with(found, parts, lambda i, t: F.struct(i.alias("i"), t.alias("text"))))


def split_failed_batches(packed: DataFrame, failed: DataFrame) -> DataFrame:
    """Items of failed batches in two halves (2b and 2b + 1), single items as failed. failed: doc_id, batch_no."""
    w = Window.partitionBy("doc_id", "batch_no")
    i, n = F.row_number().over(w.orderBy("idx")) - 1, F.count("*").over(w)
    return packed.join(failed, ["doc_id", "batch_no"]).select("doc_id", "idx", "batch_no", i.alias("_i"), n.alias("_n")).select("doc_id", "idx", (F.col("batch_no") * 2 + (F.col("_i") >= F.floor(F.col("_n") / 2)).cast("int")).alias("half_no"), F.when(F.col("_n") == 1, "failed").otherwise("retry").alias("state"))


def translate_rounds(packed: DataFrame, fn) -> DataFrame:
    """doc_id, idx, state, text, n_rounds: batches go to fn (list of messages -> list of replies) and back until every item has its text or stands alone and failed.

    packed: doc_id, idx, batch_no, text. Batches whose reply doesn't parse are halved for the next round, single items
    end as failed. Each round asks for half as many items a batch, so there are as many as the largest batch can be
    halved, and each is written: nothing is asked twice. Items are gathered into batches once; a batch is a row that
    goes through its call and is halved where it is, so that later rounds shuffle nothing.
    """
    item = F.struct(F.col("idx").cast("long").alias("idx"), "text")
    batches = packed.groupBy("doc_id", F.col("batch_no").cast("long").alias("batch_no")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    head, tail = MARK.split("{}")
    lines = F.transform("items", lambda x, i: F.concat(F.lit(head), i.cast("string"), F.lit(tail + "\n"), x["text"]))
    size, done, n = F.size("items"), [], 0
    row = "doc_id long, batch_no long, items array<struct<idx: bigint, text: string>>"

    def ask(parts):
        for part in parts:
            raw = pa.array(fn(part.column("message").to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("batch_no"), part.column("items"), raw], ["doc_id", "batch_no", "items", "raw"])

    while True:
        n += 1
        replies = map_arrow(batches.select("doc_id", "batch_no", "items", F.array_join(lines, "\n").alias("message")), ask, f"{row}, raw string")
        found = replies.withColumn("parsed", F.array_sort(parse_batch_response(F.col("raw"), size)))
        # places and new texts of a batch that came back, the whole items of one that didn't
        back = F.when(F.col("parsed").isNotNull(), F.arrays_zip(F.col("items.idx").alias("idx"), F.col("parsed.text").alias("text")))
        told = written(found.select("doc_id", "batch_no", back.alias("back"), F.when(F.col("parsed").isNull(), F.col("items")).alias("items")), "replies")
        done.append(told.select("doc_id", F.inline("back")).select("doc_id", "idx", F.lit("done").alias("state"), "text", F.lit(n).alias("n_rounds")))
        failed = told.where("items is not null")
        done.append(failed.where(size == 1).select("doc_id", F.col("items")[0]["idx"].alias("idx"), F.lit("failed").alias("state"), F.lit(None).cast("string").alias("text"), F.lit(n).alias("n_rounds")))
        half = F.floor(size / 2).cast("int")
        halves = F.array(F.slice("items", 1, half), F.slice("items", half + 1, size - half))
        batches = failed.where(size > 1).select("doc_id", "batch_no", F.posexplode(halves).alias("_half", "items")).select("doc_id", (F.col("batch_no") * 2 + F.col("_half")).alias("batch_no"), "items")
        if batches.isEmpty():
            return reduce(DataFrame.unionByName, done)


def absorb_results(items: DataFrame, pattern: str = CJK) -> DataFrame:
    """Final state of answered items (input, output): accepted and cached, kept but not cached, or failed when empty."""
    q = items.withColumn("_q", assess_quality(F.col("input"), F.col("output"), pattern))
    empty = F.trim(F.coalesce("output", F.lit(""))) == ""
    return q.withColumns({"state": F.when(empty, "failed").when(F.col("_q.passed"), "accepted").otherwise("kept"), "error": F.when(empty, "empty_translation").otherwise(""), "to_cache": ~empty & F.col("_q.passed")}).drop("_q")


def translate_fallback(replies: DataFrame, pattern: str = CJK) -> DataFrame:
    """One text an item from its replies (item_id, attempt, input, output): the first that passes, else the last, else the input."""
    q = replies.withColumn("_p", assess_quality(F.col("input"), F.col("output"), pattern)["passed"] & F.col("output").isNotNull())
    return q.groupBy("item_id").agg(F.coalesce(F.min_by("output", F.when(F.col("_p"), F.col("attempt"))), F.max_by("output", F.when(F.col("output").isNotNull(), F.col("attempt"))), F.min("input")).alias("text"), F.bool_or("_p").alias("passed"))


def items_per_call(packed: DataFrame) -> DataFrame:
    """Per document: batches sent, and items in one on average. packed: doc_id, batch_no."""
    return packed.groupBy("doc_id", "batch_no").agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.count("*").alias("n_calls"), F.avg("n").alias("avg_items"))


def translate_stats(routed: DataFrame) -> DataFrame:
    """Per document: items that need translating, done, failed, cache share, outcome. routed: doc_id, route, state."""
    n = routed.groupBy("doc_id").agg(F.count_if(F.col("route") != "skip").alias("n_needed"), F.count_if((F.col("route") != "skip") & (F.col("state") != "failed")).alias("n_ok"), F.count_if((F.col("route") != "skip") & (F.col("state") == "failed")).alias("n_fail"), F.count_if(F.col("route") == "cache").alias("n_hits"))
    pct = lambda a, none: F.when(F.col("n_needed") == 0, none).otherwise(F.col(a) * 100.0 / F.col("n_needed"))
    ok = (F.col("n_needed") == 0) | (F.col("n_fail") < 0.2 * F.col("n_needed"))
    return n.withColumns({"cache_pct": pct("n_hits", 0.0), "translated_pct": pct("n_ok", 100.0), "outcome": F.when(ok, "OK").otherwise("FAIL")})


def translated_body(elements: Column, text: Column) -> Column:
    """One run with the new text and the style of the first styled run."""
    styled = F.filter(elements, lambda e: F.coalesce(F.size(e["style"]), F.lit(0)) > 0)
    return F.array(F.struct(F.lit("text_run").alias("kind"), text.alias("content"), F.try_element_at(styled, F.lit(1))["style"].alias("style")))


def map_translate(batches: DataFrame, fn) -> DataFrame:
    """Replies of a caller-supplied function (list of messages -> list of replies) to batches (doc_id, batch_no, message)."""

    def run(parts):
        for part in parts:
            yield part[["doc_id", "batch_no"]].assign(raw=fn(part["message"].tolist()))

    return map_pandas(batches, run, "doc_id long, batch_no long, raw string")
