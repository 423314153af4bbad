"""Queries on listings, state, tree order, audit trail and queue."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as Y

from ..operators import changes as C
from ..operators import checks as K
from ..operators import queue as Q
from ..operators import state as S
from ..operators import tree as T
from .base import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
add = R.add

# --- change detection

add("epoch_ms_normalize", lambda t: t.documents.select("doc_id", C.epoch_ms_normalize(F.when(F.col("doc_id") % 5 == 0, F.lit("x")).when(F.col("doc_id") % 5 == 1, F.col("n_chars").cast("string")).when(F.col("doc_id") % 5 == 2, F.concat(F.lit("-"), F.col("n_chars").cast("string"))).when(F.col("doc_id") % 5 == 3, (F.col("n_chars") * 1000000000).cast("string"))).alias("ms")), "", """
WITH d AS (SELECT doc_id, try_cast(CASE doc_id % 5 WHEN 0 THEN 'x' WHEN 1 THEN CAST(n_chars AS VARCHAR) WHEN 2 THEN '-' || n_chars WHEN 3 THEN CAST(n_chars * 1000000000 AS VARCHAR) END AS DOUBLE) AS v FROM documents)
SELECT doc_id, CAST(CASE WHEN v IS NULL OR v <= 0 THEN 0 WHEN v < 1e11 THEN v * 1000 ELSE v END AS BIGINT) AS ms FROM d""")
add("state_dedupe", lambda t: C.state_dedupe(t.events.select(F.col("user_id").cast("string").alias("node_token"), F.col("event_id").alias("pos"), "event_type")), "", """
SELECT CAST(user_id AS VARCHAR) AS node_token, max(event_id) AS pos, max_by(event_type, event_id) AS event_type FROM events WHERE user_id IS NOT NULL GROUP BY user_id""")
_CLASSIFY = """, plan AS (SELECT n.node_token, n.title, n.edit_ms, n.pos, s.record_id, s.mirror_token, CASE WHEN s.record_id IS NULL THEN 'new' WHEN coalesce(s.title, '') <> '' AND coalesce(n.title, '') <> '' AND s.title <> n.title THEN 'renamed'
  WHEN n.edit_ms <> 0 AND n.edit_ms - coalesce(s.last_edit_ms, 0) > 60000 THEN 'edited' ELSE 'unchanged' END AS event FROM nodes n LEFT JOIN state s ON n.node_token = s.node_token),
gone AS (SELECT record_id, node_token FROM state WHERE node_token NOT IN (SELECT node_token FROM nodes))"""
_plan = lambda t: C.crawl_classify(t.nodes, t.state)
_gone = lambda t: C.crawl_deleted(t.nodes, t.state)


def _with(name, build, sql, needs="nodes state", head=_CLASSIFY):
    """Register a query whose SQL starts from further WITH clauses."""
    add(name, build, needs, "WITH " + head.lstrip(", ") + "\n" + sql)


_with("crawl_classify", lambda t: _plan(t).select("node_token", "record_id", "event"), "SELECT node_token, record_id, event FROM plan")
_with("crawl_deleted", _gone, "SELECT record_id, node_token FROM gone")
_with("crawl_event_counts", lambda t: C.crawl_event_counts(_plan(t), _gone(t)), "SELECT count(*) AS n_walked, count(*) FILTER (event = 'new') AS n_new, count(*) FILTER (event = 'edited') AS n_edited, count(*) FILTER (event = 'renamed') AS n_renamed, count(*) FILTER (event = 'unchanged') AS n_unchanged, (SELECT count(*) FROM gone) AS n_deleted FROM plan")
_with("placeholder_rows", lambda t: C.placeholder_rows(_plan(t)), "SELECT node_token, CASE WHEN coalesce(title, '') = '' THEN '[empty]' ELSE '[Pending] ' || title END AS placeholder_title, 'https://target.example/wiki/' || node_token AS url, CASE WHEN coalesce(mirror_token, '') <> '' THEN 'skipped_existing' ELSE 'create' END AS action FROM plan WHERE event = 'new'")
_results = lambda t: t.nodes.where("pos % 3 <> 0").select("node_token", (F.col("pos") % 3 == 1).alias("ok"), F.concat(F.lit("w"), "pos").alias("new_token"))
_with("crawl_new_rows", lambda t: C.crawl_new_rows(_plan(t), _results(t)), """SELECT node_token, title, edit_ms AS last_edit_ms, CASE pos % 3 WHEN 1 THEN 'Placeholder' WHEN 2 THEN 'PlaceholderFailed' ELSE '' END AS status, CASE WHEN pos % 3 = 1 THEN 'https://target.example/wiki/w' || pos ELSE '' END AS link_mirror FROM plan WHERE event = 'new'""")
_PATCH = _CLASSIFY + """, patches AS (SELECT record_id, event, CAST(1700000000000 AS BIGINT) AS last_seen_ms, CASE WHEN event = 'renamed' THEN title END AS title, CASE WHEN event = 'edited' THEN edit_ms END AS last_edit_ms,
  CASE WHEN event IN ('renamed', 'edited') THEN event END AS change_status, CASE WHEN event = 'edited' THEN 'Pending' END AS status, CASE WHEN event = 'edited' THEN 'Pending' END AS translate_status, CASE WHEN event = 'edited' THEN '' END AS link_clone, CASE WHEN event = 'edited' THEN '' END AS link_translated, CASE WHEN event = 'edited' THEN '' END AS error, CAST(NULL AS VARCHAR) AS source_status,
  CASE event WHEN 'edited' THEN 'last_seen_ms,last_edit_ms,change_status,status,translate_status,link_clone,link_translated,error' WHEN 'renamed' THEN 'last_seen_ms,title,change_status' ELSE 'last_seen_ms' END AS cols_set FROM plan WHERE event <> 'new'
  UNION ALL SELECT record_id, 'deleted', 1700000000000, NULL, NULL, 'deleted', NULL, NULL, NULL, NULL, NULL, 'Deleted', 'last_seen_ms,change_status,source_status' FROM gone)"""
_patches = lambda t: C.crawl_update_rows(_plan(t), _gone(t), 1_700_000_000_000)
_with("crawl_update_rows", _patches, "SELECT * FROM patches", head=_PATCH)
_with("crawl_apply", lambda t: C.crawl_apply(t.state, _patches(t), C.crawl_new_rows(_plan(t), _results(t)).select("node_token", "title", "last_edit_ms", "status")).select("record_id", "node_token", "title", "last_edit_ms", "change_status", "status", "translate_status", "link_clone"), """
SELECT s.record_id, s.node_token, CASE WHEN p.event = 'renamed' THEN p.title ELSE s.title END AS title, CASE WHEN p.event = 'edited' THEN p.last_edit_ms ELSE s.last_edit_ms END AS last_edit_ms,
  coalesce(p.change_status, s.change_status) AS change_status, coalesce(p.status, s.status) AS status, coalesce(p.translate_status, s.translate_status) AS translate_status, coalesce(p.link_clone, s.link_clone) AS link_clone FROM state s LEFT JOIN patches p USING (record_id)
UNION ALL SELECT NULL, node_token, title, edit_ms, NULL, CASE pos % 3 WHEN 1 THEN 'Placeholder' WHEN 2 THEN 'PlaceholderFailed' ELSE '' END, NULL, NULL FROM plan WHERE event = 'new'""", head=_PATCH)

# --- tree and order

add("tree_walk_dfs", lambda t: T.tree_walk_dfs(t.nodes, 3), "nodes", """RECURSIVE w AS (SELECT node_token, node_token AS root, has_child, 0 AS depth, [pos] AS path FROM nodes WHERE parent_token = ''
  UNION ALL SELECT c.node_token, w.root, c.has_child, w.depth + 1, list_append(w.path, c.pos) FROM w JOIN nodes c ON c.parent_token = w.node_token WHERE w.has_child AND w.depth < 3)
SELECT root, node_token, depth, row_number() OVER (PARTITION BY root ORDER BY path) AS dfs_rank FROM w""".replace("RECURSIVE w", "RECURSIVE WITH w"))
add(
    "children_index",
    lambda t: T.children_index(t.nodes).select("parent_token", F.array_join("children", ",").alias("children")),
    "nodes",
    "SELECT parent_token, string_agg(node_token, ',' ORDER BY pos) AS children FROM nodes GROUP BY parent_token",
)


def _legacy(t):
    """For every third nation a list of children (numbers, booleans and objects among them), for the others children by index."""
    child = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    by_nation = t.customer.groupBy("c_nationkey").agg(F.array_sort(F.collect_list("c_custkey")).alias("ids"), F.collect_list(F.struct(child.alias("child"), (-F.col("c_custkey")).cast("string").alias("at"))).alias("pairs"))
    odd = F.transform(F.col("ids"), lambda x: F.when(x % 7 == 3, x.cast("string")).when(x % 7 == 4, "true").when(x % 7 == 5, '{"x":1}').otherwise(F.concat(F.lit('"c'), x.cast("string"), F.lit('"'))))
    listed = F.concat(F.lit("["), F.array_join(odd, ","), F.lit("]"))
    quoted = F.transform("pairs", lambda p: F.concat(F.lit('"'), p["child"], F.lit('":'), F.when(F.col("c_nationkey") % 3 == 1, p["at"]).otherwise(F.concat(F.lit('"'), p["at"], F.lit('"')))))
    mapped = F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}"))
    body = F.concat(F.lit('{"P'), F.col("c_nationkey").cast("string"), F.lit('":'), F.when(F.col("c_nationkey") % 3 == 0, listed).otherwise(mapped), F.lit("}"))
    return T.children_index_legacy(by_nation.select(body.alias("body")))


add("children_index_legacy", _legacy, "", """
SELECT 'P' || c_nationkey AS parent, 'c' || c_custkey AS child, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_nationkey % 3 = 0 THEN c_custkey ELSE -c_custkey END) - 1 AS pos
FROM customer WHERE CASE c_nationkey % 3 WHEN 0 THEN c_custkey % 7 NOT IN (3, 4, 5) WHEN 1 THEN true ELSE false END""")
add("token_map", lambda t: T.token_map(t.state), "state", "SELECT node_token AS src, mirror_token AS dst FROM state WHERE mirror_token <> ''")
_ORDER = """, mapped AS (SELECT d.parent, d.pos, m.dst AS child FROM desired d JOIN child_map m ON d.child = m.src), both_sides AS (SELECT m.parent, m.pos, m.child, c.pos AS now FROM mapped m JOIN current c ON m.parent = c.parent AND m.child = c.child),
ranked AS (SELECT parent, child, row_number() OVER (PARTITION BY parent ORDER BY pos) AS r, row_number() OVER (PARTITION BY parent ORDER BY now) AS rn FROM both_sides),
moves AS (SELECT parent, child, r AS rank, coalesce(r >= min(CASE WHEN r <> rn THEN least(r, rn) END) OVER (PARTITION BY parent), false) AS moves FROM ranked),
w AS (SELECT parent, count(m.dst) AS n_desired, count(*) FILTER (m.dst IS NULL) AS n_missing_map FROM desired d LEFT JOIN child_map m ON d.child = m.src GROUP BY parent),
mc AS (SELECT parent, count(*) AS n_common, count(*) FILTER (moves) AS n_moves FROM moves GROUP BY parent), cc AS (SELECT parent, count(*) AS n_current FROM current GROUP BY parent),
p0 AS (SELECT w.*, coalesce(n_common, 0) AS n_common, coalesce(n_moves, 0) AS raw_moves, coalesce(n_current, 0) AS n_current FROM w LEFT JOIN mc USING (parent) LEFT JOIN cc USING (parent)),
p1 AS (SELECT *, CASE WHEN n_common > 50 THEN 'above_threshold' WHEN n_common = 0 THEN 'no_overlap' ELSE '' END AS skip_reason FROM p0),
plan AS (SELECT parent, n_desired, n_missing_map, n_common, CASE WHEN skip_reason = '' THEN raw_moves ELSE 0 END AS n_moves, n_current, n_current - n_common AS n_extra, skip_reason, skip_reason = '' AND raw_moves = 0 AS no_op FROM p1)"""
_ON = "desired current child_map"
_moves = lambda t: T.order_moves(t.desired, t.current, t.child_map)
_oplan = lambda t: T.order_plan(t.desired, t.current, t.child_map)
_mres = lambda t: t.nation.select(F.col("n_nationkey").alias("parent"), F.when(F.col("n_nationkey") % 4 == 1, 0).otherwise(3).cast("long").alias("n_ok"), F.when(F.col("n_nationkey") % 4 == 1, 2).otherwise(0).cast("long").alias("n_failed"))
_with("order_moves", _moves, "SELECT parent, child, rank, moves FROM moves", _ON, _ORDER)
_with("order_plan", _oplan, "SELECT * FROM plan", _ON, _ORDER)
_STATUS = _ORDER + ", st AS (SELECT p.parent, n_moves, CAST(CASE WHEN p.parent % 4 = 1 THEN 0 ELSE 3 END AS BIGINT) AS n_ok, CASE WHEN skip_reason <> '' THEN 'Skipped' WHEN no_op THEN 'OK' WHEN p.parent % 4 = 1 THEN 'Error' ELSE 'Fixed' END AS status FROM plan p)"
_ostat = lambda t: T.order_status(_oplan(t), _mres(t))
_with("order_status", _ostat, "SELECT * FROM st", _ON, _STATUS)
_with("order_run_summary", lambda t: T.order_run_summary(_ostat(t)), "SELECT count(*) AS n_parents, count(*) FILTER (status = 'OK') AS n_ok, count(*) FILTER (status = 'Fixed') AS n_fixed, count(*) FILTER (status = 'Mismatch') AS n_mismatch, count(*) FILTER (status = 'Skipped') AS n_skipped, count(*) FILTER (status = 'Error') AS n_error, CAST(sum(n_ok) AS BIGINT) AS n_moved FROM st", _ON, _STATUS)
_with("order_child_updates", lambda t: T.order_child_updates(_moves(t), t.customer.where("c_custkey % 2 = 0").select(F.concat(F.lit("r"), "c_custkey").alias("record_id"), F.concat(F.lit("D"), "c_custkey").alias("child")), _oplan(t)), "SELECT 'r' || substring(m.child, 2) AS record_id, m.parent, m.child, 'Fixed' AS tree_order_status FROM moves m JOIN plan p USING (parent) WHERE m.moves AND skip_reason = '' AND NOT no_op AND CAST(substring(m.child, 2) AS BIGINT) % 2 = 0", _ON, _ORDER)
add(
    "parent_slot_check",
    lambda t: T.parent_slot_check(t.customer.select(F.col("c_nationkey").alias("parent")), 55, 65),
    "",
    """
    SELECT c_nationkey AS parent, count(*) AS n, CASE WHEN count(*) >= 65 THEN 'error' WHEN count(*) >= 55 THEN 'warning' ELSE 'ok' END AS level
    FROM customer
    GROUP BY 1""",
)

# --- record state, routing, counters

add(
    "record_flags",
    lambda t: S.record_flags(t.state),
    "state",
    """
    SELECT record_id, status = 'Done' AND translate_status = 'Done' AS is_done, status = 'Pending' OR translate_status = 'Pending' AS is_pending, link_clone = '' AS needs_clone, link_clone <> '' AND translate_status NOT IN ('Done', 'Skipped') AS needs_translate, translate_status = 'Done' AND link_clone <> '' AND mirror_token = '' AS needs_mirror
    FROM state""",
)
add("route_records", lambda t: S.route_records(t.state), "state", """, f AS (SELECT record_id, mirror_token, link_clone = '' AND status NOT IN ('Done', 'Skipped') AS does_clone, link_clone <> '' AND translate_status NOT IN ('Done', 'Skipped') AS does_translate, mirror_token <> '' AND mirror_status IN ('', 'Placeholder', 'edited', 'PartialFail', 'Failed') AS does_mirror FROM state)
SELECT record_id, does_clone, does_translate, does_mirror, CASE WHEN does_clone AND mirror_token = '' THEN 'failed' WHEN does_clone THEN 'clone' WHEN does_translate THEN 'translate' WHEN does_mirror THEN 'mirror' ELSE 'skip' END AS next_stage FROM f""".replace(", f AS", "WITH f AS", 1))
add(
    "resolve_doc_ids",
    lambda t: S.resolve_doc_ids(t.state.withColumn("mirror_token", F.replace("mirror_token", F.lit("d"), F.lit("n"))), t.nodes),
    "state nodes",
    """
    SELECT s.record_id, a.obj_token AS source_doc, coalesce(b.obj_token, replace(s.mirror_token, 'd', 'n')) AS target_doc
    FROM state s
    LEFT JOIN nodes a ON a.node_token = s.node_token
    LEFT JOIN nodes b ON b.node_token = replace(s.mirror_token, 'd', 'n')""",
)
add(
    "select_pending",
    lambda t: S.select_pending(t.state, 50, 10, 900, True).select("record_id", "stt"),
    "state",
    """
    SELECT record_id, stt
    FROM state
    WHERE stt BETWEEN 10 AND 900 AND change_status = 'edited' ORDER BY stt LIMIT 50""",
)
add(
    "reset_records",
    lambda t: S.reset_records(t.state, status="Failed").select("record_id", "status", "translate_status"),
    "state",
    """
    SELECT record_id, CASE WHEN status = 'Failed' THEN 'Pending' ELSE status END AS status, CASE WHEN status = 'Failed' THEN 'Pending' ELSE translate_status END AS translate_status
    FROM state""",
)
_COUNTS = ", ".join(f"count(*) FILTER (result = '{r}') AS n_{r}" for r in S.RESULTS)
add("pipeline_counters", lambda t: S.pipeline_counters(t.outcomes), "outcomes", f"""
WITH c AS (SELECT run_id, count(*) FILTER (result <> 'odd') AS n_total, {_COUNTS} FROM outcomes GROUP BY run_id) SELECT *, n_ok / n_total AS success_rate, n_ok / n_total < 0.9 AS alert FROM c""")
add(
    "run_counters",
    lambda t: S.run_counters(t.outcomes),
    "outcomes",
    """
    SELECT run_id, stage, count(*) FILTER (outcome = 'OK') AS n_done, count(*) FILTER (outcome = 'FAIL') AS n_failed, count(*) FILTER (outcome = 'SKIP') AS n_skipped, count(*) AS n_processed
    FROM outcomes
    GROUP BY ALL""",
)
_ENDS = ", ".join(f"count(*) FILTER (stage = '{s}' AND outcome = '{o}') AS {s}_{n}" for s in ("clone", "translate", "mirror") for o, n in (("OK", "done"), ("FAIL", "failed")))
_SUMS = ", ".join(f"CAST(sum({s}_{n}) AS BIGINT) AS {s}_{n}" for s in ("clone", "translate", "mirror") for n in ("done", "failed"))
_shared = lambda t: t.outcomes.withColumn("record_id", F.concat(F.lit("rec"), F.substring("record_id", 4, 20).cast("long") % 40))
add("run_totals", lambda t: S.run_totals(_shared(t)), "outcomes", f"""
WITH e AS (SELECT run_id, CAST(substring(record_id, 4) AS BIGINT) % 40 AS r, bool_or(outcome = 'FAIL') AS failed, bool_and(outcome = 'SKIP') AS skipped, {_ENDS} FROM outcomes GROUP BY ALL)
SELECT run_id, count(*) AS records_total, count(*) FILTER (NOT failed AND NOT skipped) AS records_processed, count(*) FILTER (skipped) AS records_skipped, count(*) FILTER (failed) AS records_failed, {_SUMS} FROM e GROUP BY run_id""")
_FIELDS = ", ".join(f"('{stage}', '{role}', '{field}')" for stage, roles in S.STAGE_FIELDS.items() for role, field in roles.items())
_OVERVIEW = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.PIPELINE_STAGES.items())
add("stage_field_starts", lambda t: S.stage_field_starts(t.outcomes.select("record_id", "stage"), S.stage_fields(t.spark), 1_700_000_000_000, "w1"), "outcomes", f"""
WITH m(stage, role, field) AS (VALUES {_FIELDS})
SELECT record_id, stage, field, CASE role WHEN 'status' THEN 'Running' ELSE '1700000000000' END AS value FROM outcomes JOIN m USING (stage) WHERE role IN ('status', 'started_at')
UNION ALL SELECT record_id, stage, 'Pipeline Stage', CASE stage {_OVERVIEW} END FROM outcomes
UNION ALL SELECT record_id, stage, 'Last Activity At', '1700000000000' FROM outcomes
UNION ALL SELECT record_id, stage, 'Current Worker', 'w1' FROM outcomes""")
add("stage_field_ends", lambda t: S.stage_field_ends(t.outcomes.select("record_id", "stage", "outcome", F.floor("seconds").cast("double").alias("seconds"), F.when(F.col("outcome") == "FAIL", F.repeat(F.lit("broken "), 60)).alias("error")), S.stage_fields(t.spark), 1_700_000_000_000), "outcomes", f"""
WITH m(stage, role, field) AS (VALUES {_FIELDS}),
v AS (SELECT record_id, stage, field, CASE role
  WHEN 'status' THEN CASE outcome WHEN 'OK' THEN CASE stage WHEN 'mirror' THEN 'Synced' ELSE 'Done' END WHEN 'FAIL' THEN 'Failed' WHEN 'SKIP' THEN 'Skipped' WHEN 'RETRY' THEN 'Running' ELSE 'Pending' END
  WHEN 'completed_at' THEN '1700000000000' WHEN 'duration' THEN CAST(CAST(floor(seconds) AS BIGINT) AS VARCHAR) || '.0' WHEN 'error' THEN CASE WHEN outcome = 'FAIL' THEN substring(repeat('broken ', 60), 1, 200) END END AS value FROM outcomes JOIN m USING (stage))
SELECT * FROM v WHERE value IS NOT NULL
UNION ALL SELECT record_id, stage, 'Pipeline Stage', 'Failed' FROM outcomes WHERE outcome = 'FAIL'
UNION ALL SELECT record_id, stage, 'Last Activity At', '1700000000000' FROM outcomes""")
add("status_board", lambda t: S.status_board(t.state), "state", "SELECT status AS stage, count(*) AS n FROM state GROUP BY status")
add(
    "stage_start_patch",
    lambda t: S.stage_start_patch(t.outcomes.select("record_id", "stage"), "2026-05-10 07:30:00", "w1"),
    "outcomes",
    """
    SELECT record_id, 'Running' AS status, TIMESTAMP '2026-05-10 07:30:00' AS started_at, upper(stage) AS pipeline_stage, 'w1' AS worker
    FROM outcomes""",
)
add(
    "stage_finish_patch",
    lambda t: S.stage_finish_patch(t.outcomes.withColumn("error", F.when(F.col("outcome") == "FAIL", F.repeat(F.lit("broken "), 60)))).drop("duration"),
    "outcomes",
    """
    SELECT record_id, stage, CASE outcome WHEN 'OK' THEN CASE stage WHEN 'mirror' THEN 'Synced' ELSE 'Done' END WHEN 'FAIL' THEN 'Failed' WHEN 'SKIP' THEN 'Skipped' WHEN 'RETRY' THEN 'Running' ELSE 'Pending' END AS status, CASE WHEN outcome = 'FAIL' THEN 'Failed' ELSE upper(stage) END AS pipeline_stage, CASE WHEN outcome = 'FAIL' THEN substring(repeat('broken ', 60), 1, 200) ELSE '' END AS error
    FROM outcomes""",
)

# --- audit trail

_events = lambda t: t.events.select(F.concat(F.lit("u"), "user_id").alias("record_id"), F.col("event_id").cast("int").alias("pos"), F.date_trunc("second", "ts").alias("ts"), F.upper("event_type").alias("stage"), F.when(F.col("value") > 80, "FAIL").otherwise("OK").alias("outcome"), F.concat(F.lit("n="), "event_id").alias("details"))
_EV = "WITH ev AS (SELECT 'u' || user_id AS record_id, CAST(event_id AS INTEGER) AS pos, date_trunc('second', ts) AS ts, upper(event_type) AS stage, CASE WHEN value > 80 THEN 'FAIL' ELSE 'OK' END AS outcome, 'n=' || event_id AS details FROM events) "
_TRAIL = _EV.rstrip() + ", tr AS (SELECT record_id, string_agg(strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || ' [' || stage || '] ' || outcome || ' ' || details, chr(10) ORDER BY ts, pos) AS audit_trail FROM ev GROUP BY record_id) "
add(
    "audit_details",
    lambda t: t.outcomes.select("record_id", S.audit_details(F.lit(2.5), F.array(F.struct(F.lit("blocks_total").alias("name"), F.floor("seconds").cast("string").alias("value")), F.struct(F.lit("n_kept").alias("name"), F.lit("7").alias("value"))), F.lit("timeout"), F.col("outcome")).alias("details")),
    "outcomes",
    """
    SELECT record_id, 'dt=2.5s total=' || CAST(floor(seconds) AS BIGINT) || ' kept=7' || CASE WHEN outcome <> 'OK' THEN ' err=timeout' ELSE '' END AS details
    FROM outcomes""",
)
add("audit_serialize", lambda t: S.audit_serialize(_events(t)), "", _TRAIL + "SELECT record_id, audit_trail FROM tr")
add(
    "audit_parse",
    lambda t: S.audit_parse(S.audit_serialize(_events(t)).withColumn("audit_trail", F.concat(F.lit("bad line\n"), "audit_trail"))),
    "",
    _EV + "SELECT record_id, CAST(row_number() OVER (PARTITION BY record_id ORDER BY ts, pos) AS INTEGER) AS pos, ts, stage, outcome, details FROM ev",
)
add(
    "audit_append",
    lambda t: S.audit_append(_events(t).where("pos % 4 <> 0"), _events(t).where("pos % 4 = 0"), 30),
    "",
    _EV + "SELECT record_id, pos, ts, stage, outcome, details FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY pos % 4 = 0 DESC, pos DESC) AS n FROM ev) WHERE n <= 30",
)
add(
    "audit_last_event",
    lambda t: S.audit_last_event(_events(t)),
    "",
    _EV + "SELECT record_id, pos, ts, stage, outcome, details FROM (SELECT *, row_number() OVER (PARTITION BY record_id, stage ORDER BY ts DESC, pos) AS n FROM ev) WHERE n = 1",
)

# --- checkpoints and queue

add(
    "ckpt_resumable",
    lambda t: Q.ckpt_resumable(t.runs, 60_000.0, 40_000.0),
    "runs",
    """
    SELECT space_id, run_id, CASE WHEN 60000.0 - started_at > 40000.0 THEN 'invalidate' ELSE 'resume' END AS action
    FROM (SELECT *, row_number() OVER (PARTITION BY space_id ORDER BY started_at DESC, run_id DESC) AS n
    FROM runs
    WHERE status = 'running')
    WHERE n = 1""",
)
add(
    "ckpt_save",
    lambda t: Q.ckpt_save(t.walked, t.walk_more)[1],
    "walked walk_more",
    """
    SELECT run_id, count(*) AS walked_count
    FROM (SELECT run_id, token
    FROM walked UNION SELECT run_id, token
    FROM walk_more)
    GROUP BY run_id""",
)
add(
    "ckpt_remaining",
    lambda t: Q.ckpt_remaining(t.part.select(F.concat(F.lit("p"), "p_partkey").alias("node_token")), t.walked.where("run_id like 'k%1'")),
    "walked",
    """
    SELECT 'p' || p_partkey AS node_token
    FROM part
    WHERE 'p' || p_partkey NOT IN (SELECT token
    FROM walked
    WHERE run_id LIKE 'k%1')""",
)
add(
    "ckpt_transition",
    lambda t: Q.ckpt_transition(t.runs, t.runs.where("cast(substring(run_id, 2) as bigint) % 3 <> 0 and status = 'running'").select("run_id", F.when(F.substring("run_id", 2, 30).cast("long") % 3 == 1, "completed").otherwise("failed").alias("to")), 99_000.0),
    "runs",
    """, c AS (SELECT *, CAST(substring(run_id, 2) AS BIGINT) % 3 AS k FROM runs) SELECT run_id, space_id, started_at, CASE WHEN status = 'running' AND k = 1 THEN 'completed' WHEN status = 'running' AND k = 2 THEN 'failed' ELSE status END AS status, CASE WHEN status = 'running' AND k = 1 THEN CAST(99000.0 AS DOUBLE) END AS completed_at FROM c""".replace(", c AS", "WITH c AS", 1),
)
add(
    "ckpt_cleanup",
    lambda t: Q.ckpt_cleanup(t.runs, t.walked, 60_000.0, 20_000.0)[1],
    "runs walked",
    """
    SELECT run_id, token
    FROM walked
    WHERE run_id IN (SELECT run_id
    FROM runs
    WHERE status = 'running' OR 60000.0 - started_at <= 20000.0)""",
)
add(
    "queue_eligible",
    lambda t: Q.queue_eligible(t.ops, 1200.0, 200),
    "ops",
    """
    SELECT operation_id, scheduled_at, attempts + 1 AS attempts
    FROM ops
    WHERE (status = 'pending' AND scheduled_at <= 1200.0) OR (status = 'processing' AND 1200.0 - created_at > 300.0) ORDER BY scheduled_at, operation_id LIMIT 200""",
)
add(
    "queue_transition",
    lambda t: Q.queue_transition(t.ops, t.ops.where("status = 'processing'").select("operation_id", (F.col("attempts") % 3 == 0).alias("ok"), (F.col("attempts") % 3 == 1).alias("permanent"), F.lit("timed out").alias("error")), 2000.0),
    "ops",
    """
    SELECT operation_id, CASE WHEN attempts % 3 = 0 THEN 'done' WHEN attempts % 3 = 1 OR attempts >= max_attempts THEN 'failed' ELSE 'pending' END AS status, CASE WHEN attempts % 3 <> 0 AND NOT (attempts % 3 = 1 OR attempts >= max_attempts) THEN CAST(2060.0 AS DOUBLE) ELSE scheduled_at END AS scheduled_at, CASE WHEN attempts % 3 = 0 THEN CAST(2000.0 AS DOUBLE) END AS processed_at, CASE WHEN attempts % 3 = 0 THEN '' ELSE 'timed out' END AS last_error
    FROM ops
    WHERE status = 'processing'""",
)
add("queue_stats", lambda t: Q.queue_stats(t.ops), "ops", "SELECT status, count(*) AS n FROM ops GROUP BY status")
add(
    "queue_cleanup",
    lambda t: Q.queue_cleanup(t.ops, 1500.0, 800.0).select("operation_id", "status"),
    "ops",
    "SELECT operation_id, status FROM ops WHERE status <> 'done' OR 1500.0 - processed_at <= 800.0",
)

# --- schema and health

_EXPECTED = [("doc_id", "bigint"), ("text", "string"), ("lang", "bigint"), ("mirror", "string"), ("source", "modified_time"), ("nothing", "bigint")]


def _schema_diff(t):
    landed = t.documents.select(F.to_json(F.struct("*")).alias("body"))
    return K.schema_diff(t.spark.createDataFrame(_EXPECTED, "name string, kind string"), K.catalog_of_records(landed, "body"))


def _schema_apply(t):
    want = Y.StructType([Y.StructField(n, k) for n, k in (("doc_id", Y.LongType()), ("source", Y.StringType()), ("mirror", Y.IntegerType()))])
    return K.schema_apply(t.documents.select("doc_id", "lang"), want)


add("schema_diff", _schema_diff, "", """
WITH e(name, want) AS (VALUES ('doc_id', 'bigint'), ('text', 'string'), ('lang', 'bigint'), ('mirror', 'string'), ('source', 'modified_time'), ('nothing', 'bigint')),
a AS (SELECT 'doc_id' AS name, 'bigint' AS have, count(doc_id) AS n FROM documents UNION ALL SELECT 'n_chars', 'bigint', count(n_chars) FROM documents
  UNION ALL SELECT 'text', 'string', count("text") FROM documents UNION ALL SELECT 'lang', 'string', count(lang) FROM documents UNION ALL SELECT 'source', 'string', count(source) FROM documents),
j AS (SELECT coalesce(e.name, a.name) AS name, want, have, n, CASE WHEN have IS NULL THEN 'missing' WHEN want IS NULL THEN 'extra' WHEN want <> have AND want <> 'modified_time' THEN 'type_mismatch' END AS issue FROM e FULL JOIN (SELECT * FROM a WHERE n > 0) a ON e.name = a.name)
SELECT name, want, have, n, issue, issue <> 'extra' AS is_change FROM j WHERE issue IS NOT NULL""")
add("schema_apply", _schema_apply, "", "SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS INTEGER) AS mirror FROM documents")
add(
    "schema_invariants",
    lambda t: K.schema_invariants(t.customer.select(F.concat(F.lit("f"), F.floor(F.col("c_custkey") / 2)).alias("name"), (F.col("c_custkey") % 100 == 0).alias("is_primary"))),
    "",
    """
    WITH c AS (SELECT 'f' || CAST(floor(c_custkey / 2.0) AS BIGINT) AS name, c_custkey % 100 = 0 AS p
    FROM customer) SELECT 'duplicate_name' AS rule, name, count(*) AS n
    FROM c
    GROUP BY name HAVING count(*) > 1
    UNION ALL SELECT 'one_primary', '', count(*) FILTER (p)
    FROM c HAVING count(*) FILTER (p) <> 1""",
)
add("field_groups", lambda t: K.field_groups(t.part.select(F.col("p_name").alias("name"), F.col("p_brand").alias("group"), F.col("p_partkey").alias("pos"))).withColumn("fields", F.array_join("fields", "|")), "", """
SELECT p_brand AS "group", count(*) AS n_fields, min(p_partkey) AS "first", string_agg(p_name, '|' ORDER BY p_partkey) AS fields FROM part GROUP BY p_brand""")
add(
    "id_violations",
    lambda t: K.id_violations(K.validate_ids(t.pages.select("page_id", "url", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("domain"), F.col("page_id").cast("string").alias("token")), {"url": "url", "domain": "domain", "token": "token"})),
    "",
    r"""
    WITH v AS (SELECT regexp_full_match(url, 'https?://[^\s/]+/.*', 's') AS u, regexp_full_match(regexp_extract(url, '^https?://([^/]+)', 1), '[a-z0-9-]+(\.[a-z0-9-]+)+') AS d, length(CAST(page_id AS VARCHAR)) >= 3 AS k FROM pages)
    SELECT 'url' AS column, count(*) FILTER (u) AS n_ok, count(*) FILTER (NOT u) AS n_violations FROM v UNION ALL SELECT 'domain', count(*) FILTER (d), count(*) FILTER (NOT d) FROM v UNION ALL SELECT 'token', count(*) FILTER (k), count(*) FILTER (NOT k) FROM v""",
)
add(
    "validate_ids",
    lambda t: K.validate_ids(t.pages.select("page_id", "url", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("domain")), {"url": "url", "domain": "domain"}).select("page_id", "ok_url", "ok_domain"),
    "",
    r"""
    SELECT page_id, regexp_full_match(url, 'https?://[^\s/]+/.*', 's') AS ok_url, regexp_full_match(regexp_extract(url, '^https?://([^/]+)', 1), '[a-z0-9-]+(\.[a-z0-9-]+)+') AS ok_domain
    FROM pages""",
)
_checked = lambda t: K.table_checks(t.spark, {"documents": (t.documents, "doc_id"), "orders": (t.orders, "o_orderkey"), "lineitem": (t.lineitem, "l_orderkey"), "events": (t.events, "event_id")})
add("health_report", lambda t: K.health_report(_checked(t)), "", """
WITH c AS (SELECT 'documents' AS name, count(*) - count(doc_id) AS nulls, count(*) - count(DISTINCT doc_id) AS twice FROM documents UNION ALL SELECT 'orders', count(*) - count(o_orderkey), count(*) - count(DISTINCT o_orderkey) FROM orders
  UNION ALL SELECT 'lineitem', count(*) - count(l_orderkey), count(*) - count(DISTINCT l_orderkey) FROM lineitem UNION ALL SELECT 'events', count(*) - count(event_id), count(*) - count(DISTINCT event_id) FROM events),
l AS (SELECT CASE WHEN nulls > 0 THEN 'error' WHEN twice > 0 THEN 'warning' ELSE 'ok' END AS level FROM c)
SELECT count(*) AS n, count(*) FILTER (level = 'ok') AS n_ok, count(*) FILTER (level = 'info') AS n_info, count(*) FILTER (level = 'warning') AS n_warning, count(*) FILTER (level = 'error') AS n_error, count(*) FILTER (level = 'error') = 0 AS passed, count(*) FILTER (level = 'ok') || '/' || count(*) || ' ok' AS summary FROM l""")
