"""Record state, routing, audit trail and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: How a record ends in a run.
RESULTS = ("ok", "skip", "fail_transient", "fail_permanent", "source_deleted", "unsupported_type", "perm_denied", "uncaught")
OUTCOMES = ("OK", "SKIP", "FAIL", "RETRY", "INFO")
_LINE = r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ) \[([A-Z_]+)\] (OK|SKIP|FAIL|RETRY|INFO)(?: (.*))?$"


#: The fields of each stage by their role, and a stage's value in the overview.
STAGE_FIELDS = {
    "crawl": {"status": "Crawl Status", "completed_at": "Crawl At", "attempts": "Crawl Attempts", "error": "Crawl Error"},
    "placeholder": {"status": "Placeholder Status", "completed_at": "Placeholder Created At", "error": "Placeholder Error"},
    "clone": {"status": "Clone Status", "started_at": "Clone Started At", "completed_at": "Clone Completed At", "duration": "Clone Duration Seconds", "attempts": "Clone Attempts", "error": "Clone Error"},
    "translate": {
        "status": "Translate Status", "started_at": "Translate Started At", "completed_at": "Translate Completed At", "duration": "Translate Duration Seconds", "attempts": "Translate Attempts", "error": "Translate Error",
    },
    "mirror": {"status": "Mirror Wiki Status", "started_at": "Mirror Started At", "completed_at": "Mirror Completed At", "duration": "Mirror Duration Seconds", "attempts": "Mirror Attempts", "error": "Mirror Error"},
    "sync": {"status": "Mirror Wiki Status", "completed_at": "Mirror Last Synced At", "attempts": "Sync Attempts", "error": "Sync Error"},
    "backlinks": {"status": "Backlink Fix Status", "completed_at": "Backlink Fix At"},
    "tree_order": {"status": "Tree Order Status", "completed_at": "Tree Order Last Audit"},
}
PIPELINE_STAGES = {"crawl": "Crawling", "placeholder": "Placeholder", "clone": "Cloning", "translate": "Translating", "mirror": "Mirroring", "sync": "Syncing", "tree_order": "Reordering"}


def record_flags(state: DataFrame) -> DataFrame:
    s, t = F.col("status"), F.col("translate_status")
    link, target = F.coalesce("link_clone", F.lit("")) != "", F.coalesce("mirror_token", F.lit("")) != ""
    return state.select("record_id", ((s == "Done") & (t == "Done")).alias("is_done"), ((s == "Pending") | (t == "Pending")).alias("is_pending"), (~link).alias("needs_clone"), (link & ~t.isin("Done", "Skipped")).alias("needs_translate"), ((t == "Done") & link & ~target).alias("needs_mirror"))


def route_records(state: DataFrame) -> DataFrame:
    """The next stage of a record. All three flags are taken before cloning; a clone without a target place fails."""
    link, target = F.coalesce("link_clone", F.lit("")) != "", F.coalesce("mirror_token", F.lit("")) != ""
    clone = ~link & ~F.col("status").isin("Done", "Skipped")
    translate = link & ~F.col("translate_status").isin("Done", "Skipped")
    mirror = target & F.coalesce("mirror_status", F.lit("")).isin("", "Placeholder", "edited", "PartialFail", "Failed")
    stage = F.when(clone & ~target, "failed").when(clone, "clone").when(translate, "translate").when(mirror, "mirror").otherwise("skip")
    return state.select("record_id", clone.alias("does_clone"), translate.alias("does_translate"), mirror.alias("does_mirror"), stage.alias("next_stage"))


def resolve_doc_ids(state: DataFrame, nodes: DataFrame) -> DataFrame:
    """Source and target document of a record; an unlisted target falls back to its node token."""
    ids = nodes.select("node_token", "obj_token")
    src = ids.select("node_token", F.col("obj_token").alias("source_doc"))
    dst = ids.select(F.col("node_token").alias("mirror_token"), F.col("obj_token").alias("_dst"))
    return state.select("record_id", "node_token", "mirror_token").join(src, "node_token", "left").join(dst, "mirror_token", "left").select("record_id", "source_doc", F.coalesce("_dst", "mirror_token").alias("target_doc"))


def select_pending(state: DataFrame, limit: int, first: int = 0, last: int = 2**31 - 1, edited_only: bool = False) -> DataFrame:
    """Work list: the lowest numbers in a range, or edited records only."""
    rows = state.where(F.col("stt").between(first, last))
    return (rows.where("change_status = 'edited'") if edited_only else rows).orderBy("stt").limit(limit)


def reset_records(state: DataFrame, stt: int | None = None, status: str | None = None) -> DataFrame:
    hit = F.coalesce((F.col("stt") == stt) if stt is not None else (F.col("status") == status), F.lit(False))
    return state.withColumns({c: F.when(hit, "Pending").otherwise(F.col(c)) for c in ("status", "translate_status")})


def pipeline_counters(outcomes: DataFrame, result: str = "result") -> DataFrame:
    """By run how many records ended in each of RESULTS, the share of ok ones, and whether it is low enough for an alert."""
    n = outcomes.groupBy("run_id").agg(F.count_if(F.col(result).isin(*RESULTS)).alias("n_total"), *[F.count_if(F.col(result) == r).alias(f"n_{r}") for r in RESULTS])
    return n.withColumn("success_rate", F.when(F.col("n_total") == 0, 0.0).otherwise(F.col("n_ok") / F.col("n_total"))).withColumn("alert", F.col("success_rate") < 0.9)


def run_counters(outcomes: DataFrame) -> DataFrame:
    n = outcomes.groupBy("run_id", "stage").agg(F.count_if(F.col("outcome") == "OK").alias("n_done"), F.count_if(F.col("outcome") == "FAIL").alias("n_failed"), F.count_if(F.col("outcome") == "SKIP").alias("n_skipped"), F.count("*").alias("n_processed"))
    return n


def run_totals(outcomes: DataFrame, stages: tuple[str, ...] = ("clone", "translate", "mirror")) -> DataFrame:
    """One row a run: records it saw, and of these with a failed stage, with stages skipped alone, and processed ones; done and failed of each stage."""
    each = outcomes.groupBy("run_id", "record_id").agg(
        F.bool_or(F.col("outcome") == "FAIL").alias("_failed"), F.bool_and(F.col("outcome") == "SKIP").alias("_skipped"),
        *[F.count_if((F.col("stage") == s) & (F.col("outcome") == o)).alias(f"{s}_{n}") for s in stages for o, n in (("OK", "done"), ("FAIL", "failed"))],
    )
    sums = [F.sum(c).alias(c) for c in each.columns if c.endswith(("_done", "_failed")) and not c.startswith("_")]
    return each.groupBy("run_id").agg(
        F.count("*").alias("records_total"), F.count_if(~F.col("_failed") & ~F.col("_skipped")).alias("records_processed"), F.count_if("_skipped").alias("records_skipped"), F.count_if("_failed").alias("records_failed"), *sums
    )


def status_board(state: DataFrame, column: str = "status") -> DataFrame:
    return state.groupBy(F.col(column).alias("stage")).agg(F.count("*").alias("n"))


def stage_fields(spark: SparkSession) -> DataFrame:
    """The table of fields (stage, role, field), and the overview value of a stage that has one."""
    rows = [(stage, role, field, PIPELINE_STAGES.get(stage)) for stage, roles in STAGE_FIELDS.items() for role, field in roles.items()]
    return spark.createDataFrame(rows, "stage string, role string, field string, overview string")


def stage_field_starts(records: DataFrame, fields: DataFrame, at_ms: int, worker: str = "") -> DataFrame:
    """(record_id, stage, field, value) that a start sets. records: record_id, stage; fields: see stage_fields, a few dozen rows."""
    at = F.lit(str(at_ms))
    values = F.when(F.col("role") == "status", "Running").when(F.col("role") == "started_at", at)
    own = records.join(F.broadcast(fields), "stage").select("record_id", "stage", "field", values.alias("value")).where("value is not null")
    overview = F.create_map(*[F.lit(x) for pair in PIPELINE_STAGES.items() for x in pair])[F.col("stage")]
    always = [("Pipeline Stage", overview), ("Last Activity At", at), ("Current Worker", F.nullif(F.lit(worker), F.lit("")))]
    common = records.select("record_id", "stage", F.explode(F.array(*[F.struct(F.lit(n).alias("field"), v.alias("value")) for n, v in always])).alias("f")).select("record_id", "stage", "f.*").where("value is not null")
    return own.unionByName(common)


def stage_field_ends(results: DataFrame, fields: DataFrame, at_ms: int) -> DataFrame:
    """(record_id, stage, field, value) that an end sets. results: record_id, stage, outcome, seconds, error."""
    at, o = F.lit(str(at_ms)), F.col("outcome")
    done = stage_finish_patch(results.select("record_id", "stage", "outcome", "seconds", "error")).withColumn("failed", F.col("pipeline_stage") == "Failed")
    role = F.col("role")
    value = F.when(role == "status", F.col("status")).when(role == "completed_at", at).when(role == "duration", F.col("duration").cast("string")).when(role == "error", F.nullif("error", F.lit("")))
    own = done.join(F.broadcast(fields), "stage").select("record_id", "stage", "field", value.alias("value")).where("value is not null")
    always = [("Pipeline Stage", F.when(o == "FAIL", "Failed")), ("Last Activity At", at)]
    common = results.select("record_id", "stage", F.explode(F.array(*[F.struct(F.lit(n).alias("field"), v.alias("value")) for n, v in always])).alias("f")).select("record_id", "stage", "f.*").where("value is not null")
    return own.unionByName(common)


def stage_start_patch(records: DataFrame, at: str, worker: str) -> DataFrame:
    """records: record_id, stage."""
    return records.select("record_id", F.lit("Running").alias("status"), F.to_timestamp(F.lit(at)).alias("started_at"), F.upper("stage").alias("pipeline_stage"), F.lit(worker).alias("worker"))


def stage_finish_patch(results: DataFrame) -> DataFrame:
    """results: record_id, stage, outcome, seconds, error."""
    done = F.when(F.col("stage") == "placeholder", "Created").when(F.col("stage") == "tree", "Fixed").when(F.col("stage") == "mirror", "Synced").otherwise("Done")
    o = F.col("outcome")
    status = F.when(o == "OK", done).when((o == "FAIL") & (F.col("stage") == "tree"), "Error").when(o == "FAIL", "Failed").when(o == "SKIP", "Skipped").when(o == "RETRY", "Running").otherwise("Pending")
    return results.select("record_id", "stage", status.alias("status"), F.when(o == "FAIL", "Failed").otherwise(F.upper("stage")).alias("pipeline_stage"), F.bround("seconds", 2).alias("duration"), F.substring(F.coalesce("error", F.lit("")), 1, 200).alias("error"))


def audit_details(seconds: Column, metrics: Column, error: Column, outcome: Column) -> Column:
    """dt=..s, the first two metrics by the last word of their name, and the error cut at 60 if it isn't OK. metrics: array<struct<name, value>>."""
    shown = F.transform(F.slice(metrics, 1, 2), lambda m: F.concat(F.element_at(F.split(m["name"], "_"), -1), F.lit("="), m["value"]))
    return F.concat_ws(" ", F.format_string("dt=%.1fs", seconds), F.nullif(F.array_join(shown, " "), F.lit("")), F.when((outcome != "OK") & (F.coalesce(error, F.lit("")) != ""), F.concat(F.lit("err="), F.substring(error, 1, 60))))


def audit_line(ts: Column, stage: Column, outcome: Column, details: Column) -> Column:
    return F.rtrim(F.concat_ws(" ", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.concat(F.lit("["), stage, F.lit("]")), outcome, details))


def audit_parse(trails: DataFrame) -> DataFrame:
    """Events of trails (record_id, audit_trail); lines of another form or with an unknown outcome go."""
    lines = trails.select("record_id", F.posexplode(F.split("audit_trail", "\n")).alias("pos", "line")).where(F.col("line").rlike(_LINE))
    part = lambda i: F.regexp_extract("line", _LINE, i)
    return lines.select("record_id", "pos", F.to_timestamp(part(1), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), part(2).alias("stage"), part(3).alias("outcome"), part(4).alias("details"))


def audit_append(events: DataFrame, new: DataFrame, keep: int = 30) -> DataFrame:
    """The last events of each record in order of insertion; new ones go behind."""
    both = events.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    last = Window.partitionBy("record_id").orderBy(F.desc("_new"), F.desc("pos"))
    return both.withColumn("_n", F.row_number().over(last)).where(F.col("_n") <= keep).drop("_n", "_new")


def audit_serialize(events: DataFrame) -> DataFrame:
    line = audit_line(F.col("ts"), F.col("stage"), F.col("outcome"), F.col("details"))
    rows = events.select("record_id", F.struct("ts", "pos", line.alias("line")).alias("e"))
    return rows.groupBy("record_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda x: x["line"]), "\n").alias("audit_trail"))


def audit_last_event(events: DataFrame) -> DataFrame:
    """Latest event of each record and stage; the first of equal times."""
    w = Window.partitionBy("record_id", "stage").orderBy(F.desc("ts"), "pos")
    return events.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
