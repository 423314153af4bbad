"""Links in content: extraction and rewriting from a token map."""

from __future__ import annotations

from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import partner, spread

ALLOWED = ("source.example", "target.example")


def extract_links(blocks: DataFrame) -> DataFrame:
    return blocks.where("coalesce(url, '') <> ''").select("doc_id", "idx", "url")


@F.pandas_udf(T.StringType())
def _unquote(urls: pd.Series) -> pd.Series:
    return urls.map(lambda u: unquote(u) if u is not None else None)


def decoded(url: Column) -> Column:
    """Percent-decoding that keeps plus signs and broken sequences. Spark decodes what it can; only urls with a broken sequence go to Python."""
    return F.when(F.instr(url, "%") == 0, url).otherwise(F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), _unquote(url)))


def url_rewrite(links: DataFrame, mapping: DataFrame, source: str = "source.example", target: str = "target.example", with_escapes: bool = False) -> DataFrame:
    """links with new_url and replaced. Distinct urls are rewritten once and joined back.

    A url that is blank or names the target stays. Anywhere in the (decoded) url, a page path on the source domain with
    a mapped token becomes the target's wiki path, with what follows kept and what precedes dropped.
    with_escapes says whether urls may hold percent signs; without it no Python is in the plan.
    """
    pattern = rf"(?is)https?://{source.replace('.', '[.]')}/(?:wiki|docx|base|sheets)/([A-Za-z0-9]+)(.*)$"
    plain = decoded(F.col("url")) if with_escapes else F.col("url")
    # most links are blank or lead elsewhere; without a path on the source domain they have nothing to be joined to, and are spread
    named = F.contains(F.lower("url"), F.lit(source.lower()))
    named = named | F.contains("url", F.lit("%")) if with_escapes else named
    asked = ~F.contains("url", F.lit(target)) & (F.col("url") != "") & named
    urls = links.where(asked).select("url").distinct().withColumn("_plain", plain)
    hit = urls.select("url", F.regexp_extract("_plain", pattern, 1).alias("src"), F.regexp_extract("_plain", pattern, 2).alias("_rest")).where("src <> ''")
    new = hit.join(mapping, "src").select(partner(F.col("url")).alias("_key"), F.concat(F.lit(f"https://{target}/wiki/"), "dst", "_rest").alias("_new"))
    done = links.withColumn("_key", spread(links, F.when(asked, F.col("url")))).join(new, "_key", "left")
    return done.select("url", *[c for c in links.columns if c != "url"], F.coalesce("_new", "url").alias("new_url"), F.col("_new").isNotNull().alias("replaced"))


def fix_elements(blocks: DataFrame, mapping: DataFrame) -> DataFrame:
    """Blocks (doc_id, idx, elements) with the urls of runs and of mentioned documents rewritten, and how many were.

    Elements stay whole (kind, content, token, title, style) and in their order, which is kept by place. Blocks
    without elements keep their empty array.
    """
    linked = F.col("e.kind").isin("text_run", "mention_doc")
    parts = blocks.select("doc_id", "idx", F.posexplode_outer("elements").alias("pos", "e")).withColumn("url", F.when(linked, F.coalesce("e.url", F.lit(""))).otherwise(""))
    done = url_rewrite(parts, mapping).withColumn("e", F.when(F.col("replaced"), F.col("e").withField("url", F.col("new_url"))).otherwise(F.col("e")))
    placed = F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "e")))
    back = F.transform(F.array_sort(placed, lambda a, b: a["pos"] - b["pos"]), lambda x: x["e"])
    return done.groupBy("doc_id", "idx").agg(back.alias("elements"), F.count_if("replaced").alias("n_replaced"))


def backlink_stats(rewritten: DataFrame) -> DataFrame:
    n = rewritten.groupBy("doc_id").agg(F.count("*").alias("n_links"), F.count_if("replaced").alias("n_replaced"))
    return n.withColumn("status", F.when(F.col("n_replaced") == 0, "NoChange").otherwise("Fixed"))


def unmapped_links(links: DataFrame, mapping: DataFrame, source: str = "source.example") -> DataFrame:
    found = links.withColumn("src", F.regexp_extract("url", rf"(?i)https?://{source.replace('.', '[.]')}/(?:wiki|docx|base|sheets)/([A-Za-z0-9]+)", 1)).where("src <> ''")
    return found.join(mapping, "src", "left_anti")


def parse_source_url(urls: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    domain = F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#]+)", 1))
    token = F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]+/wiki/([A-Za-z0-9]+)", 1)
    ok = F.lit(False)
    for suffix in allowed:
        ok = ok | F.endswith(domain, F.lit(suffix))
    return urls.withColumns({"domain": domain, "token": token}).withColumn("valid", ok & (F.col("token") != ""))
