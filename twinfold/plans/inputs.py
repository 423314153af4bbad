"""Inputs of the queries, derived from the given tables by SQL that both engines run.

Each entry is written once; a name in braces stands for a base table or another entry. The engines differ only where
a text is split into rows.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from ..operators.calls import CODES, LIMITS, NETWORK

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_LINES = {
    "spark": "SELECT doc_id, lang, idx, line FROM (SELECT doc_id, lang, posexplode(split(text, '\\\\n')) AS (idx, line) FROM {documents})",
    "duck": "SELECT doc_id, lang, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS idx, unnest(string_split(text, chr(10))) AS line FROM documents",
}

#: Codes and messages that calls come with in turn: every API code, HTTP statuses, unknown ones, and every phrase.
_SEEN = [
    *[(c, "quota") for codes in CODES.values() for c in codes],
    *[(c, "timeout") for c in (429, 500, 503, 599, 600, 401, 403, 404, 499, 99991661, 1254043, -1)],
    *[(0, f"Call failed: {w.title()}.") for w in (*LIMITS, *NETWORK, "credit", "Too many requests", "Connection lost", "socket closed", "")],
]
_SIGNALS = ", ".join(f"({k}, CAST({code} AS BIGINT), '{message}')" for k, (code, message) in enumerate(_SEEN))

INPUTS = {
    "nodes": """SELECT doc_id AS pos, 'n' || doc_id AS node_token, CASE WHEN doc_id % 10 = 0 THEN '' ELSE 'n' || (doc_id - doc_id % 10) END AS parent_token,
        'o' || doc_id AS obj_token, substring(text, 1, 12) AS title, n_chars * 1000000 + doc_id * 100000000 AS edit_ms, doc_id % 10 = 0 AS has_child FROM {documents} WHERE doc_id % 13 <> 5""",
    "state": """SELECT 'r' || doc_id AS record_id, CAST(doc_id AS INTEGER) AS stt, 'n' || doc_id AS node_token, CASE WHEN doc_id % 7 = 3 THEN 'was ' || substring(text, 1, 7) ELSE substring(text, 1, 12) END AS title,
        CASE WHEN doc_id % 5 = 2 THEN n_chars * 1000000 + doc_id * 100000000 - 60001 WHEN doc_id % 5 = 3 THEN n_chars * 1000000 + doc_id * 100000000 - 60000 ELSE n_chars * 1000000 + doc_id * 100000000 END AS last_edit_ms,
        CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'd' || doc_id END AS mirror_token, CASE doc_id % 6 WHEN 0 THEN 'Done' WHEN 1 THEN 'Pending' WHEN 2 THEN 'Skipped' WHEN 3 THEN 'Placeholder' WHEN 4 THEN 'Failed' ELSE 'PartialFail' END AS status,
        CASE doc_id % 5 WHEN 0 THEN 'Done' WHEN 1 THEN 'Pending' WHEN 2 THEN 'Skipped' ELSE 'Failed' END AS translate_status, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'https://target.example/docx/c' || doc_id END AS link_clone,
        CASE doc_id % 4 WHEN 1 THEN 'edited' WHEN 2 THEN '' ELSE 'Placeholder' END AS mirror_status, CASE WHEN doc_id % 8 = 1 THEN 'edited' ELSE 'unchanged' END AS change_status, CASE WHEN doc_id % 9 = 0 THEN '' ELSE 'tr ' || substring(text, 1, 6) END AS title_translated
        FROM {documents} WHERE doc_id % 11 <> 4""",
    "lines": _LINES,
    "source_blocks": """SELECT doc_id, idx, 'b' || doc_id || '_' || idx AS block_id, CAST(CASE WHEN idx % 9 = 8 THEN 27 WHEN idx % 5 = 0 THEN 3 ELSE 2 END AS INTEGER) AS block_type, line AS content,
        CASE WHEN length(line) % 4 = 0 THEN 'https://source.example/wiki/T' || (length(line) % 37) || '?v=' || idx WHEN length(line) % 4 = 1 THEN 'https://other.example/wiki/T1' ELSE '' END AS url FROM {lines}""",
    "target_blocks": """SELECT doc_id, idx, 't' || doc_id || '_' || idx AS block_id, block_type, CASE WHEN (doc_id + idx) % 20 = 7 THEN 'edited ' || content ELSE content END AS content, url
        FROM {source_blocks} WHERE NOT (doc_id % 6 = 1 AND idx >= 4) UNION ALL SELECT doc_id, 100000 AS idx, 'x' || doc_id AS block_id, CAST(2 AS INTEGER) AS block_type, 'extra' AS content, '' AS url FROM {documents} WHERE doc_id % 10 = 3""",
    "token_map": "SELECT 'T' || k AS src, 'M' || k AS dst FROM (SELECT DISTINCT length(line) % 37 AS k FROM {lines}) AS t WHERE k % 3 <> 1",
    "desired": "SELECT c_nationkey AS parent, c_custkey AS pos, 'C' || c_custkey AS child FROM {customer}",
    "current": "SELECT c_nationkey AS parent, CASE WHEN c_nationkey % 3 = 0 THEN c_custkey WHEN c_custkey % 17 = 0 THEN -c_custkey ELSE c_custkey END AS pos, 'D' || c_custkey AS child FROM {customer} WHERE c_custkey % 19 <> 3 AND c_nationkey % 7 <> 5",
    "child_map": "SELECT 'C' || c_custkey AS src, 'D' || c_custkey AS dst FROM {customer} WHERE c_custkey % 23 <> 1",
    "calls": """SELECT event_id AS call_id, event_type AS resource, CAST(ts AS TIMESTAMP) AS ts, user_id, value, event_type <> 'error' AND value < 80 AS ok, CASE WHEN value >= 95 THEN 429 WHEN value >= 90 THEN 503 WHEN value >= 85 THEN 401 WHEN value >= 80 THEN 404 ELSE 200 END AS status_code,
        CAST(CASE WHEN value >= 95 THEN 99991400 WHEN value >= 90 THEN 1 ELSE 0 END AS BIGINT) AS code, CASE WHEN value >= 98 THEN 'Quota exceeded' WHEN value >= 95 THEN 'Too many requests' WHEN value >= 90 THEN 'Connection reset by peer' ELSE '' END AS message FROM {events}""",
    "signals": f"""SELECT c.call_id, c.user_id, c.ts, c.ok, c.status_code, v.code, v.message FROM {{calls}} c JOIN (SELECT * FROM (VALUES {_SIGNALS}) AS x(k, code, message)) v ON c.call_id % {len(_SEEN)} = v.k""",
    "pairs": """SELECT a.conv_id, a.turn, a.text AS input, CASE WHEN a.conv_id % 9 = 0 THEN '' WHEN a.conv_id % 9 = 1 THEN a.text ELSE b.text END AS output FROM {conversations} a JOIN {conversations} b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
    "items": "SELECT doc_id, idx, 'b' || doc_id || '_' || idx AS item_id, line AS text FROM {lines}",
    "short_lines": "SELECT trim(line) AS src, min(doc_id * 100000 + idx) AS entry_order, max(doc_id) AS most FROM {lines} WHERE length(trim(line)) BETWEEN 1 AND 20 GROUP BY trim(line)",
    "glossary": """SELECT CASE WHEN length(src) % 2 = 0 THEN 'a' ELSE 'b' END AS section, length(src) % 2 AS section_order, entry_order, src, 'G:' || src AS dst FROM {short_lines} WHERE most % 3 <> 0
        UNION ALL SELECT 'c' AS section, 2 AS section_order, entry_order, src, 'H:' || src AS dst FROM {short_lines} WHERE most % 4 = 0""",
    "ops": """SELECT 'q' || o_orderkey AS operation_id, o_orderpriority AS operation_type, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'processing' END AS status, CAST(o_orderkey % 6 AS INTEGER) AS attempts, 5 AS max_attempts,
        CAST(o_custkey AS DOUBLE) AS created_at, CAST(o_custkey + o_orderkey % 400 AS DOUBLE) AS scheduled_at, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey + 10 AS DOUBLE) END AS processed_at FROM {orders}""",
    "runs": """SELECT 'k' || o_orderkey AS run_id, 's' || o_custkey AS space_id, CAST(o_orderkey AS DOUBLE) AS started_at, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status FROM {orders}""",
    "walked": "SELECT DISTINCT 'k' || l_orderkey AS run_id, 'p' || l_partkey AS token FROM {lineitem} WHERE l_linenumber <= 3",
    "walk_more": "SELECT 'k' || l_orderkey AS run_id, 'p' || l_partkey AS token FROM {lineitem} WHERE l_linenumber BETWEEN 3 AND 4",
    "outcomes": "SELECT 'run' || (user_id % 7) AS run_id, 'rec' || event_id AS record_id, CASE event_id % 3 WHEN 0 THEN 'clone' WHEN 1 THEN 'translate' ELSE 'mirror' END AS stage, CASE WHEN value > 90 THEN 'FAIL' WHEN value > 70 THEN 'SKIP' WHEN value > 65 THEN 'RETRY' ELSE 'OK' END AS outcome, CASE event_id % 23 WHEN 0 THEN 'skip' WHEN 1 THEN 'fail_transient' WHEN 2 THEN 'fail_permanent' WHEN 3 THEN 'source_deleted' WHEN 4 THEN 'unsupported_type' WHEN 5 THEN 'perm_denied' WHEN 6 THEN 'uncaught' WHEN 7 THEN 'odd' ELSE 'ok' END AS result, value AS seconds FROM {events}",
}
#: Which other inputs an input is made from.
NEEDS = {n: [m for m in INPUTS if m != n and f"{{{m}}}" in (q if isinstance(q, str) else q["spark"])] for n, q in INPUTS.items()}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a derived input as a DataFrame."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    query = INPUTS[name] if isinstance(INPUTS[name], str) else INPUTS[name]["spark"]
    return spark.sql(query, **{t: frame(spark, sf_dir, t) for t in [*BASE, *INPUTS] if f"{{{t}}}" in query})


@lru_cache(maxsize=None)
def order_of(name: str) -> tuple[str, ...]:
    """The inputs that an input needs, deepest first, and itself."""
    found: list[str] = []
    for n in NEEDS[name]:
        found += [x for x in order_of(n) if x not in found]
    return (*found, name)


def oracle(names: str, query: str) -> str:
    """DuckDB SQL: the named inputs as WITH clauses before the query."""
    wanted: list[str] = []
    for n in names.split():
        wanted += [x for x in order_of(n) if x not in wanted]
    texts = {n: (INPUTS[n] if isinstance(INPUTS[n], str) else INPUTS[n]["duck"]) for n in wanted}
    for n, q in texts.items():
        for t in [*BASE, *INPUTS]:
            q = q.replace(f"{{{t}}}", t)
        texts[n] = q
    query = query.strip()
    head = "WITH RECURSIVE " if query.upper().startswith("RECURSIVE ") else "WITH "
    query = query[10:].lstrip() if head != "WITH " else query
    if query.upper().startswith("WITH "):
        query = ", " + query[5:]
    return head + ", ".join(f"{n} AS ({q})" for n, q in texts.items()) + "\n" + query
