"""Queries on call logs and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calls as A
from ..streaming import ordered as O
from ..streaming import streams as Z
from .base import Registry, new_folder

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
add = R.add



def _code_sql(code: str) -> str:
    sets = " ".join(f"WHEN {code} IN ({', '.join(map(str, v))}) THEN '{k}'" for k, v in A.CODES.items())
    return f"(CASE {sets} WHEN {code} = 429 THEN 'rate_limit' WHEN {code} BETWEEN 500 AND 599 THEN 'server' WHEN {code} IN (401, 403) THEN 'permission' WHEN {code} = 404 THEN 'not_found' ELSE 'unknown' END)"


def _message_sql() -> str:
    any_of = lambda words: "(" + " OR ".join(f"contains(lower(message), '{w}')" for w in words) + ")"
    limits = f"WHEN {any_of(A.LIMITS)} THEN CASE WHEN {any_of(('quota', 'credit'))} THEN 'quota' ELSE 'rate_limit' END"
    return f"CASE WHEN coalesce(code, 0) <> 0 THEN {_code_sql('code')} {limits} WHEN {any_of(A.NETWORK)} THEN 'network' ELSE {_code_sql('status_code')} END"


def _pause_sql(category: str, attempt: str) -> str:
    steps = " ".join(f"WHEN '{k}' THEN least({base} * pow(2, {attempt}), {cap})" for k, (base, cap) in A.BACKOFF.items())
    return f"CASE {category} WHEN 'auth' THEN 0.0 {steps} ELSE least({A.OTHER_BACKOFF[0]} * pow(2, {attempt}), {A.OTHER_BACKOFF[1]}) END"


_RETRIED = ", ".join(f"'{c}'" for c in A.RETRYABLE)


def _category(t):
    """Calls with a category each: every code and phrase that is known comes up."""
    return t.signals.withColumn("category", A.classify_message(F.col("code"), F.col("message"), F.col("status_code")))


def _retry_outcomes(t):
    return A.retry_outcomes(_category(t).select(F.col("user_id").alias("operation"), "ts", "call_id", "ok", "category"))


add(
    "classify_code",
    lambda t: t.signals.select("call_id", "code", A.classify_code(F.col("code")).alias("category"), A.classify_code(F.col("status_code")).alias("status_category")),
    "signals",
    f"SELECT call_id, code, {_code_sql('code')} AS category, {_code_sql('status_code')} AS status_category FROM signals",
)
add(
    "classify_message",
    lambda t: _category(t).select("call_id", "message", "category"),
    "signals",
    f"SELECT call_id, message, {_message_sql()} AS category FROM signals",
)
add(
    "retry_advice",
    lambda t: _category(t).select("call_id", A.retry_advice(F.col("category"), F.col("call_id") % 9).alias("a")).select("call_id", "a.retryable", "a.seconds"),
    "signals",
    f"""WITH c AS (SELECT *, {_message_sql()} AS category FROM signals)
    SELECT call_id, category IN ({_RETRIED}) AS retryable, CAST({_pause_sql("category", "(call_id % 9)")} AS DOUBLE) AS seconds FROM c""",
)
add("retry_outcomes", _retry_outcomes, "signals", f"""
WITH c AS (SELECT user_id AS operation, ok, {_message_sql()} AS category, row_number() OVER (PARTITION BY user_id ORDER BY ts, call_id) AS attempt FROM signals),
e AS (SELECT operation, coalesce(min(attempt) FILTER (ok OR category NOT IN ({_RETRIED}) OR attempt >= 5), max(attempt)) AS stop FROM c GROUP BY operation)
SELECT operation, count(*) AS n_attempts, bool_or(ok) AS succeeded, CAST(sum(CASE WHEN ok THEN 0.0 ELSE {_pause_sql("category", "(attempt - 1)")} END) AS DOUBLE) AS planned_wait
FROM c JOIN e USING (operation) WHERE attempt <= stop GROUP BY operation""")
_QUOTA = """
WITH c AS (SELECT call_id, resource, epoch_us(ts) AS us FROM calls), w AS (SELECT *, count(*) OVER (PARTITION BY resource ORDER BY us RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS n_short, count(*) OVER (PARTITION BY resource ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS n_long, min(us) OVER (PARTITION BY resource ORDER BY us RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS oldest FROM c)
SELECT call_id, resource, n_short, n_long, greatest(n_short / 3, n_long / 70) AS share, greatest(n_short / 3, n_long / 70) >= 0.8 AS near_limit, CASE WHEN n_short >= 3 THEN (oldest + 3600000000 - us) / 1e6 ELSE 0.0 END AS wait_s FROM w"""
add("quota_usage", lambda t: A.quota_usage(t.calls, 3600, 86400, 3, 70), "calls", _QUOTA)
add("failure_streaks", lambda t: A.failure_streaks(t.calls), "calls", """
WITH c AS (SELECT *, sum(CAST(ok AS INTEGER)) OVER (PARTITION BY resource ORDER BY ts, call_id) AS g FROM calls), r AS (SELECT resource, g, count(*) AS n FROM c WHERE NOT ok GROUP BY resource, g), l AS (SELECT resource, max(n) AS longest_streak, count(*) AS n_streaks FROM r GROUP BY resource)
SELECT resource, count(*) AS n_calls, avg(CASE WHEN ok THEN 0.0 ELSE 1.0 END) AS failure_rate, any_value(longest_streak) AS longest_streak, any_value(n_streaks) AS n_streaks FROM calls LEFT JOIN l USING (resource) GROUP BY resource""")
_OUTAGE = """RECURSIVE WITH s AS (SELECT resource, call_id, epoch_us(ts) AS us, ok, row_number() OVER (PARTITION BY resource ORDER BY ts, call_id) AS k FROM calls),
f AS (SELECT resource, CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS call_id, 'closed' AS state, 0 AS bad, 0 AS good, CAST(0 AS BIGINT) AS since, false AS suppressed FROM calls GROUP BY resource
UNION ALL SELECT resource, k, call_id,
  CASE WHEN hold THEN 'open' WHEN st = 'half_open' THEN CASE WHEN NOT ok THEN 'open' WHEN g + 1 >= 2 THEN 'closed' ELSE 'half_open' END WHEN NOT ok AND bad + 1 >= 3 THEN 'open' ELSE 'closed' END,
  CASE WHEN hold THEN bad WHEN st = 'half_open' THEN CASE WHEN ok AND g + 1 >= 2 THEN 0 ELSE bad END WHEN ok THEN 0 ELSE bad + 1 END,
  CASE WHEN hold THEN good WHEN st = 'half_open' AND ok THEN g + 1 ELSE g END,
  CASE WHEN hold THEN since WHEN st = 'half_open' AND NOT ok THEN us WHEN st = 'closed' AND NOT ok AND bad + 1 >= 3 THEN us ELSE since END, hold
  FROM (SELECT f.resource, s.k, s.call_id, s.us, s.ok, f.bad, f.good, f.since, f.state = 'open' AND s.us - f.since < 7200000000 AS hold, CASE WHEN f.state = 'open' THEN 'half_open' ELSE f.state END AS st, CASE WHEN f.state = 'open' THEN 0 ELSE f.good END AS g FROM f JOIN s ON s.resource = f.resource AND s.k = f.k + 1) x)"""
add("outage_state", lambda t: A.outage_state(t.calls, 3, 7200), "calls", f"{_OUTAGE} SELECT resource, call_id, state, suppressed FROM f WHERE k > 0")
add(
    "rate_limited_window",
    lambda t: A.rate_limited_window(t.calls),
    "calls",
    """
    SELECT call_id, resource, avg(CASE WHEN status_code = 429 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY resource ORDER BY ts, call_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS share
    FROM calls""",
)
add(
    "log_rollup",
    lambda t: A.log_rollup(t.outcomes.select(F.col("run_id").alias("correlation_id"), "stage", F.floor("seconds").alias("seconds"))),
    "outcomes",
    """
    SELECT run_id AS correlation_id, stage, count(*) AS n_events, CAST(sum(floor(seconds)) AS BIGINT) AS total_s, CAST(max(floor(seconds)) AS BIGINT) AS max_s
    FROM outcomes
    GROUP BY ALL""",
)


# --- streams: each drains what is there and gives back what it wrote


def _folder(t) -> str:
    """A new folder that driver and executors share."""
    return new_folder(t.spark, "stream")


def _fed(t, folder: str, parts, start) -> None:
    """Land one part after the other, each in as many files as it has partitions, and run the job on what is new: start(stream) goes on from its checkpoint."""
    for df in parts:
        df.write.mode("append").parquet(f"{folder}/in")
        start(t.spark.readStream.schema(df.schema).parquet(f"{folder}/in")).awaitTermination()


def _drain(t, folder: str, parts, build, mode: str = "append"):
    """Run a streaming transformation over the parts, writing each batch to its own folder; gives back what was written."""
    found = []

    def start(stream):
        def sink(batch, number):
            batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

        out = build(stream)
        found.append(out.schema)
        return out.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()

    _fed(t, folder, parts, start)
    return t.spark.read.schema(found[0]).parquet(f"{folder}/out/batch=*")


def _calls(t):
    return t.calls.select("call_id", "resource", "ts", "ok", "status_code")


def _halves(t):
    """The calls of the first weeks, then the others."""
    early = F.col("ts") < F.lit(_CUT).cast("timestamp")
    return _calls(t).where(early), _calls(t).where(~early)


_CUT = "2024-01-16"


def _transform(t):
    folder = _folder(t)
    _fed(t, folder, _halves(t), lambda s: Z.stream_transform(s, lambda b: b.withColumn("limited", F.col("status_code") == 429), f"{folder}/good", f"{folder}/bad", "status_code = 404", f"{folder}/log"))
    good, bad = (t.spark.read.parquet(f"{folder}/{x}") for x in ("good", "bad"))
    return good.select("call_id", "resource", "limited", F.lit(False).alias("turned_down")).union(bad.select("call_id", "resource", F.lit(None).cast("boolean"), F.lit(True)))


def _dedupe(t):
    """Operations of three calls each, a minute apart; the second part repeats half of the last ones, the third brings some that are days too late."""
    rows = _calls(t).select(F.floor(F.col("call_id") / 3).alias("operation_id"))
    timed = rows.withColumn("ts", F.timestamp_seconds(1704067200 + 60 * F.col("operation_id")))
    most = timed.agg(F.max("operation_id").alias("most"))
    again = timed.crossJoin(F.broadcast(most)).where("operation_id > most - 30 and operation_id % 2 = 0").drop("most")
    late = rows.select((-1 - F.col("operation_id")).alias("operation_id")).withColumn("ts", F.timestamp_seconds(1704067200 - 86400 * 30 + 60 * F.col("operation_id")))
    return _drain(t, _folder(t), (timed, again, late), Z.stream_dedupe_ops).select("operation_id")


def _windows(t):
    return _drain(t, _folder(t), _halves(t), lambda s: Z.stream_quota_windows(s, "6 hours", "3 hours", "1 day")).select("resource", "start", "end", "n_calls")


def _outage(t):
    with O.rocksdb(t.spark):
        return _drain(t, _folder(t), _halves(t), lambda s: O.stream_outage_state(s, 3, 7200))


def _usage(t):
    with O.rocksdb(t.spark):
        return _drain(t, _folder(t), _halves(t), lambda s: O.stream_quota_usage(s, 3600, 86400, 3, 70))


def _links(t):
    folder = _folder(t)
    rows = t.source_blocks.where("url <> ''").select("doc_id", "idx", "url")
    parts = [rows.where(f"idx % 2 = {i}") for i in (0, 1)]
    _fed(t, folder, parts, lambda s: Z.stream_link_rewrite(s, t.token_map, f"{folder}/good", f"{folder}/log"))
    return t.spark.read.parquet(f"{folder}/good").select("doc_id", "idx", "new_url", "replaced")


#: When links and tokens of the late-link query arrive; a link far in the future, and a token, let the watermark pass all others.
_LINK_AT, _TOKEN_AT = "1704067200 + doc_id % 300 * 60", "1704067200 + cast(substring(src, 2) AS bigint) * 600"


def _late_links(t):
    """Links first, then the tokens that came within an hour of them, before or after."""
    folder = _folder(t)
    rows = t.source_blocks.where("url <> ''").select("doc_id", "idx", "url", F.timestamp_seconds(F.expr(_LINK_AT)).alias("ts"))
    tokens = t.token_map.select("src", "dst", F.timestamp_seconds(F.expr(_TOKEN_AT)).alias("ts"))
    far = F.timestamp_seconds(F.lit(1904067200))
    last = rows.agg(F.max("doc_id").alias("doc_id")).select("doc_id", F.lit(-1).alias("idx"), F.lit("").alias("url"), far.alias("ts"))
    end = tokens.agg(F.max("src").alias("src"), F.max("dst").alias("dst")).select("src", "dst", far.alias("ts"))

    def start(links):
        other = t.spark.readStream.schema(tokens.schema).parquet(f"{folder}/tokens")
        out = Z.stream_late_links(links, other)
        return out.writeStream.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()

    tokens.where("false").write.parquet(f"{folder}/tokens")
    _fed(t, folder, [rows], start)
    tokens.write.mode("append").parquet(f"{folder}/tokens")
    _fed(t, folder, [rows.where("false")], start)
    end.write.mode("append").parquet(f"{folder}/tokens")
    _fed(t, folder, [last], start)
    return t.spark.read.parquet(f"{folder}/out/batch=*").select("doc_id", "idx", "new_url", "replaced")


def _upsert(t):
    """The first part holds each key as it was with half of the items, the second as it is with all of them."""
    folder = _folder(t)
    key = F.sha2(F.col("text").cast("binary"), 256).alias("key")
    parts = [rows.groupBy(key).agg(F.max("item_id").alias("translated"), F.count("*").alias("at")) for rows in (t.items.where("doc_id % 2 = 0"), t.items)]
    _fed(t, folder, parts, lambda s: Z.stream_cache_upsert(s, f"{folder}/cache", f"{folder}/log", 8))
    return Z.cached(t.spark, f"{folder}/cache")


add(
    "stream_transform",
    _transform,
    "calls",
    """
    SELECT call_id, resource, CASE WHEN status_code <> 404 THEN status_code = 429 END AS limited, status_code = 404 AS turned_down
    FROM calls""",
)
add("stream_dedupe_ops", _dedupe, "calls", "SELECT DISTINCT CAST(floor(call_id / 3.0) AS BIGINT) AS operation_id FROM calls")
add("stream_quota_windows", _windows, "calls", """
WITH s AS (SELECT resource, ts, unnest([0, 1]) AS back FROM calls), w AS (SELECT resource, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 3 HOUR * back AS "start" FROM s)
SELECT resource, "start", "start" + INTERVAL 6 HOUR AS "end", count(*) AS n_calls FROM w
WHERE "start" + INTERVAL 6 HOUR <= (SELECT max(ts) FROM calls) - INTERVAL 1 DAY GROUP BY ALL""")
#: The watermark after all calls, a day behind the latest, and the slices of an hour that are complete by then.
_DONE = "(SELECT (epoch_us(max(ts)) // 1000 - 86400000) * 1000 FROM calls)"
add("stream_outage_state", _outage, "calls", f"""
{_OUTAGE}, g AS (SELECT f.resource, f.call_id, s.us, f.state, f.suppressed, f.since FROM f JOIN s ON f.resource = s.resource AND f.k = s.k WHERE (s.us // 3600000000 + 1) * 3600000000 <= {_DONE})
SELECT resource, call_id, make_timestamp(us) AS ts, state, suppressed FROM g
UNION ALL SELECT resource, NULL, make_timestamp(since + 7200000000), 'half_open', false FROM g WHERE state = 'open' AND NOT suppressed AND since + 7200000000 <= {_DONE}""")
add("stream_quota_usage", _usage, "calls", f"{_QUOTA} WHERE (us // 3600000000 + 1) * 3600000000 <= {_DONE}")
add("stream_late_links", _late_links, "source_blocks token_map", rf"""
WITH l AS (SELECT doc_id, idx, url, {_LINK_AT.replace("cast", "CAST")} AS at FROM source_blocks WHERE url <> ''), m AS (SELECT src, dst, {_TOKEN_AT} AS at FROM token_map)
SELECT l.doc_id, l.idx, CASE WHEN m.dst IS NULL THEN l.url ELSE 'https://target.example/wiki/' || m.dst || regexp_extract(l.url, '/wiki/([A-Za-z0-9]+)(.*)$', 2) END AS new_url, m.dst IS NOT NULL AS replaced
FROM l LEFT JOIN m ON l.url LIKE 'https://source.example/%' AND m.src = regexp_extract(l.url, '/wiki/([A-Za-z0-9]+)', 1) AND m.at BETWEEN l.at - 3600 AND l.at + 3600""")
add("stream_link_rewrite", _links, "source_blocks token_map", r"""
SELECT l.doc_id, l.idx, CASE WHEN m.dst IS NULL THEN l.url ELSE 'https://target.example/wiki/' || m.dst || regexp_extract(l.url, '/wiki/([A-Za-z0-9]+)(.*)$', 2) END AS new_url, m.dst IS NOT NULL AS replaced
FROM source_blocks l LEFT JOIN token_map m ON l.url LIKE 'https://source.example/%' AND m.src = regexp_extract(l.url, '/wiki/([A-Za-z0-9]+)', 1) WHERE l.url <> ''""")
add("stream_cache_upsert", _upsert, "items", "SELECT sha256(text) AS key, max(item_id) AS translated, count(*) AS \"at\" FROM items GROUP BY 1")
