"""Structured Streaming jobs. Each takes a streaming DataFrame; sources bound a batch by maxFilesPerTrigger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.links import url_rewrite
from ..sources.buckets import read_table, upsert


def stream_transform(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], good: str, bad: str, is_bad: str, checkpoint: str) -> StreamingQuery:
    """Micro-batches through a transform to Parquet; rows that is_bad marks go to an error table and don't stop the rest. Batches are named by their number, so a repeated one overwrites itself."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.where(is_bad).write.mode("overwrite").parquet(f"{bad}/batch={number}")
        transform(batch.where(f"not coalesce({is_bad}, true)")).write.mode("overwrite").parquet(f"{good}/batch={number}")

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_dedupe_ops(stream: DataFrame, key: str = "operation_id", ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """An operation once, as long as the watermark remembers it."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def stream_quota_windows(stream: DataFrame, length: str, slide: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark("ts", late).groupBy(F.window("ts", length, slide), "resource").agg(F.count("*").alias("n_calls")).select("resource", F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n_calls")


def stream_link_rewrite(stream: DataFrame, mapping: DataFrame, good: str, checkpoint: str) -> StreamingQuery:
    """Links of arriving blocks rewritten from the current token map."""
    return stream_transform(stream, lambda batch: url_rewrite(batch, mapping), good, f"{good}-bad", "url is null", checkpoint)


def stream_late_links(links: DataFrame, tokens: DataFrame, wait: str = "1 hour", source: str = "source.example", target: str = "target.example") -> DataFrame:
    """doc_id, idx, new_url and replaced of links (doc_id, idx, url, ts) whose token may be mapped (src, dst, ts) only later.

    A link and a token meet if the token came at most `wait` before or after the link. A link is rewritten as soon as
    both are there, and comes out as it was once the watermark says that no token for it can come. Of the times that a
    token is mapped within `wait` the first counts. What was mapped long ago is joined to links beforehand (`stream_link_rewrite`).
    """
    pattern = rf"(?is)https?://{source.replace('.', '[.]')}/(?:wiki|docx|base|sheets)/([A-Za-z0-9]+)(.*)$"
    asked = links.withWatermark("ts", wait).withColumns({"_src": F.regexp_extract("url", pattern, 1), "_rest": F.regexp_extract("url", pattern, 2)})
    known = tokens.withWatermark("ts", wait).dropDuplicatesWithinWatermark(["src"]).select("src", "dst", F.col("ts").alias("mapped_at"))
    near = F.expr(f"_src = src AND mapped_at BETWEEN ts - INTERVAL {wait} AND ts + INTERVAL {wait}")
    new = F.concat(F.lit(f"https://{target}/wiki/"), "dst", "_rest")
    return asked.join(known, near, "left").select("doc_id", "idx", F.coalesce(new, "url").alias("new_url"), F.col("dst").isNotNull().alias("replaced"))


def stream_cache_upsert(stream: DataFrame, cache: str, checkpoint: str, n_buckets: int = 64) -> StreamingQuery:
    """Accepted translations (key, translated, at) upserted into a bucketed table each micro-batch, the newest row of a key staying; read it with cached().

    A batch that runs twice changes nothing: the table remembers the number of the batch that made each version.
    """

    def sink(batch: DataFrame, number: int) -> None:
        upsert(batch, cache, "key", ["at", "translated"], n_buckets, batch=number)

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def cached(spark: SparkSession, cache: str) -> DataFrame:
    return read_table(spark, cache).select("key", "translated", "at")
