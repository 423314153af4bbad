"""Change detection between a source listing and the state table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOLERANCE_MS = 60_000


def epoch_ms_normalize(value: Column) -> Column:
    """Anything to epoch milliseconds: what is no positive number becomes 0, numbers below 1e11 are seconds."""
    number = value.try_cast("double")
    return F.when(number.isNull() | F.isnan(number) | (number <= 0), 0).when(number < 1e11, number * 1000).otherwise(number).cast("long")


def state_dedupe(records: DataFrame, token: str = "node_token", order: str = "pos") -> DataFrame:
    """One row a token, the last in input order; rows without a token go."""
    kept = records.where(F.coalesce(token, F.lit("")) != "").groupBy(F.col(token).alias("_token")).agg(F.max_by(F.struct("*"), F.col(order)).alias("_row"))
    return kept.select("_row.*")


def crawl_classify(nodes: DataFrame, state: DataFrame) -> DataFrame:
    """Each listed node with its event: new, renamed (goes before edited), edited (over a minute newer) or unchanged. Blank tokens are skipped."""
    old = state.select("node_token", "record_id", F.col("title").alias("old_title"), F.col("last_edit_ms").alias("old_ms"), "mirror_token")
    differs = (F.coalesce("old_title", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != "") & (F.col("old_title") != F.col("title"))
    newer = (F.col("edit_ms") != 0) & (F.col("edit_ms") - F.coalesce("old_ms", F.lit(0)) > TOLERANCE_MS)
    event = F.when(F.col("record_id").isNull(), "new").when(differs, "renamed").when(newer, "edited").otherwise("unchanged")
    return nodes.where("coalesce(node_token, '') <> ''").join(old, "node_token", "left").withColumn("event", event)


def crawl_deleted(nodes: DataFrame, state: DataFrame) -> DataFrame:
    """State records whose token isn't listed any more."""
    return state.where("coalesce(node_token, '') <> ''").join(nodes.select("node_token"), "node_token", "left_anti").select("record_id", "node_token")


def crawl_event_counts(plan: DataFrame, deleted: DataFrame) -> DataFrame:
    one = lambda e: F.count_if(F.col("event") == e).alias(f"n_{e}")
    return plan.agg(F.count("*").alias("n_walked"), one("new"), one("edited"), one("renamed"), one("unchanged")).crossJoin(F.broadcast(deleted.agg(F.count("*").alias("n_deleted"))))


def placeholder_rows(plan: DataFrame, prefix: str = "[Pending] ", empty: str = "[empty]", domain: str = "target.example") -> DataFrame:
    """What to create for new items; items that have a target already are skipped."""
    has = F.coalesce("mirror_token", F.lit("")) != ""
    title = F.when(F.coalesce("title", F.lit("")) == "", empty).otherwise(F.concat(F.lit(prefix), "title"))
    return plan.where("event = 'new'").select("node_token", title.alias("placeholder_title"), F.concat(F.lit(f"https://{domain}/wiki/"), "node_token").alias("url"), F.when(has, "skipped_existing").otherwise("create").alias("action"))


def crawl_new_rows(plan: DataFrame, results: DataFrame) -> DataFrame:
    """Rows to insert for new items. results: node_token, ok, new_token; no result leaves status and link empty."""
    done = F.col("ok") & (F.coalesce("new_token", F.lit("")) != "")
    return (
        plan.where("event = 'new'").join(results, "node_token", "left")
        .select("node_token", "title", F.col("edit_ms").alias("last_edit_ms"), F.when(done, "Placeholder").when(~F.col("ok"), "PlaceholderFailed").otherwise("").alias("status"), F.when(done, F.concat(F.lit("https://target.example/wiki/"), "new_token")).otherwise("").alias("link_mirror"))
    )


def crawl_update_rows(plan: DataFrame, deleted: DataFrame, seen_ms: int) -> DataFrame:
    """Sparse patches; cols_set names the columns a patch sets, so that clearing one differs from leaving it alone."""
    event, null = F.col("event"), F.lit(None).cast("string")
    known = plan.where("event <> 'new'").select(
        "record_id", "event", F.lit(seen_ms).cast("long").alias("last_seen_ms"),
        F.when(event.isin("renamed"), F.col("title")).otherwise(null).alias("title"),
        F.when(event == "edited", F.col("edit_ms")).alias("last_edit_ms"),
        F.when(event.isin("renamed", "edited"), event).alias("change_status"),
        F.when(event == "edited", "Pending").alias("status"), F.when(event == "edited", "Pending").alias("translate_status"), F.when(event == "edited", "").alias("link_clone"),
        F.when(event == "edited", "").alias("link_translated"), F.when(event == "edited", "").alias("error"), null.alias("source_status"),
        F.when(event == "edited", F.lit("last_seen_ms,last_edit_ms,change_status,status,translate_status,link_clone,link_translated,error")).when(event == "renamed", "last_seen_ms,title,change_status").otherwise("last_seen_ms").alias("cols_set"),
    )
    gone = deleted.select("record_id", F.lit("deleted").alias("event"), F.lit(seen_ms).cast("long").alias("last_seen_ms"), null.alias("title"), F.lit(None).cast("long").alias("last_edit_ms"), F.lit("deleted").alias("change_status"), null.alias("status"), null.alias("translate_status"), null.alias("link_clone"), null.alias("link_translated"), null.alias("error"), F.lit("Deleted").alias("source_status"), F.lit("last_seen_ms,change_status,source_status").alias("cols_set"))
    return known.unionByName(gone)


def crawl_apply(state: DataFrame, patches: DataFrame, inserts: DataFrame) -> DataFrame:
    """The next state: patched records and new ones."""
    changed = [c for c in ("title", "last_edit_ms", "change_status", "status", "translate_status", "link_clone", "link_translated", "error", "source_status") if c in state.columns]
    p = patches.select("record_id", F.split("cols_set", ",").alias("_set"), *[F.col(c).alias(f"_{c}") for c in changed])
    joined = state.join(p, "record_id", "left")
    patched = [F.when(F.array_contains("_set", F.lit(c)), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in state.columns]
    return joined.select(*patched).unionByName(inserts, allowMissingColumns=True)
