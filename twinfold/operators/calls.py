"""Analytics over call logs: error classes, retries, quotas, outages."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import map_pandas

#: API codes by category, words of quota and rate errors, words of network errors, seconds of backoff (base, cap) by category.
CODES = {
    "rate_limit": (99991400, 230001),
    "lock": (131009, 1254606, 1770001, 4000080),
    "auth": (99991663, 99991664, 99991665, 1061045),
    "not_found": (131005, 131008, 1770003, 1770006),
    "permission": (131006, 1770032, 1254030, 1254040),
    "schema": (1254045, 1254046, 1254050),
    "server": (131001, 230002, 800004135, 800014300),
}
LIMITS = ("quota", "out of credit", "insufficient_quota", "rate limit", "rate_limit")
NETWORK = (
    "timeout",
    "connection refused",
    "connection reset",
    "connection aborted",
    "broken pipe",
    "eof",
    "no route to host",
    "network is unreachable",
    "name resolution failed",
    "temporary failure in name resolution",
    "dns",
    "tls handshake",
    "remote disconnected",
    "read timed out",
)
BACKOFF = {"rate_limit": (2.0, 60.0), "network": (1.0, 8.0), "lock": (5.0, 60.0), "quota": (30.0, 600.0), "server": (2.0, 30.0), "unknown": (1.0, 60.0)}
OTHER_BACKOFF = (1.0, 60.0)
RETRYABLE = ("rate_limit", "network", "lock", "quota", "server", "auth", "unknown")


def classify_code(code: Column) -> Column:
    """By API code, else by HTTP status; unknown if it is neither or null."""
    known = [F.when(code.isin(list(v)), k) for k, v in CODES.items()]
    http = F.when(code == 429, "rate_limit").when(code.between(500, 599), "server").when(code.isin(401, 403), "permission").when(code == 404, "not_found")
    return F.coalesce(*known, http, F.lit("unknown"))


def classify_message(code: Column, message: Column, status: Column) -> Column:
    """By API code if there is one, else by words of the message, else by HTTP status."""
    text = F.lower(F.coalesce(message, F.lit("")))
    has = lambda *words: F.greatest(*[F.contains(text, F.lit(w)) for w in words], F.lit(False))
    by_text = F.when(has(*LIMITS), F.when(has("quota", "credit"), "quota").otherwise("rate_limit")).when(has(*NETWORK), "network")
    return F.when(F.coalesce(code, F.lit(0)) != 0, classify_code(code)).otherwise(F.coalesce(by_text, classify_code(status)))


def retry_advice(category: Column, attempt: Column) -> Column:
    """struct(retryable, seconds): exponential backoff with a cap; an authentication error is retried at once."""

    def pick(i: int) -> Column:
        return F.coalesce(*[F.when(category == k, F.lit(v[i])) for k, v in BACKOFF.items()], F.lit(OTHER_BACKOFF[i]))

    seconds = F.least(pick(0) * F.pow(F.lit(2.0), F.greatest(attempt, F.lit(0))), pick(1))
    return F.struct(category.isin(*RETRYABLE).alias("retryable"), F.when(category == "auth", F.lit(0.0)).otherwise(seconds).alias("seconds"))


def retry_outcomes(attempts: DataFrame, most: int = 5) -> DataFrame:
    """attempts: operation, ts, call_id, ok, category. An operation stops at success, a final error or the last allowed attempt."""
    numbered = attempts.withColumn("attempt", F.row_number().over(Window.partitionBy("operation").orderBy("ts", "call_id")))
    stops = F.col("ok") | ~F.col("category").isin(*RETRYABLE) | (F.col("attempt") >= most)
    ended = numbered.groupBy("operation").agg(F.min(F.when(stops, F.col("attempt"))).alias("_end"), F.max("attempt").alias("_last"))
    used = numbered.join(ended, "operation").where(F.col("attempt") <= F.coalesce("_end", "_last"))
    return used.groupBy("operation").agg(F.count("*").alias("n_attempts"), F.bool_or("ok").alias("succeeded"), F.sum(F.when(~F.col("ok"), retry_advice(F.col("category"), F.col("attempt") - 1)["seconds"]).otherwise(0.0)).alias("planned_wait"))


def quota_usage(calls: DataFrame, short_s: int, long_s: int, short_cap: int, long_cap: int, slice_s: int = 3600) -> DataFrame:
    """At each call the calls in two trailing closed windows of its resource, the share of the caps, and the wait at the short cap.

    A call enters both windows at its time and leaves each a microsecond after the window's length. Running sums of
    what entered and left are the counts, and the next call to leave the short window is the oldest in it; both cost a
    sort, however many calls a window holds. The points are dealt to slices of time of a resource, and what a slice
    takes over from those before or after it is found over the slices (a row each) and goes with its points. Calls
    without a time share a window of their own.
    """
    us, short_us, long_us = F.unix_micros("ts"), short_s * 1_000_000, long_s * 1_000_000
    point = lambda at, call, short, long, leaves: F.struct(at.alias("_at"), call.alias("call_id"), F.lit(short).alias("_short"), F.lit(long).alias("_long"), leaves.alias("_leaves"), F.lit(short > 0).alias("_own"))
    no_call, no_time = F.lit(None).cast("long"), F.lit(None).cast("long")
    enters = point(us, F.col("call_id"), 1, 1, no_time)
    leaves = [point(us + short_us + 1, no_call, -1, 0, us + short_us + 1), point(us + long_us + 1, no_call, 0, -1, no_time)]
    points = calls.select("resource", F.inline(F.when(us.isNull(), F.array(enters)).otherwise(F.array(enters, *leaves)))).withColumn("_slice", F.floor(F.col("_at") / F.lit(slice_s * 1_000_000)))
    slices = points.where("_slice is not null").groupBy("resource", "_slice").agg(F.sum("_short").alias("_short"), F.sum("_long").alias("_long"), F.min("_leaves").alias("_leaves"))
    over = Window.partitionBy("resource")
    before, after = (over.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("_slice"), F.desc("_slice")))
    taken = slices.select("resource", "_slice", F.sum("_short").over(before).alias("_short_before"), F.sum("_long").over(before).alias("_long_before"), F.min("_leaves").over(after).alias("_leaves_after"))
    whole = Window.partitionBy("resource", "_slice")
    up = whole.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    down = whole.orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, -1)
    count = lambda c: F.sum(c).over(up) + F.coalesce(F.max(f"{c}_before").over(whole), F.lit(0))
    next_left = F.coalesce(F.min("_leaves").over(down), F.min("_leaves_after").over(whole))
    out = points.unionByName(taken, allowMissingColumns=True).withColumns({"n_short": count("_short"), "n_long": count("_long"), "_next": next_left}).where("_own")
    pct = F.greatest(F.col("n_short") / short_cap, F.col("n_long") / long_cap)
    wait = F.when(F.col("n_short") >= short_cap, (F.col("_next") - 1 - F.col("_at")) / 1e6).otherwise(0.0)
    return out.select("call_id", "resource", "n_short", "n_long", pct.alias("share"), (pct >= 0.8).alias("near_limit"), wait.alias("wait_s"))


def numbered(calls: DataFrame, slice_s: int = 86_400) -> DataFrame:
    """calls with _rn, the place of each in its resource by ts and call_id.

    Rows are numbered within slices of time, and the slices' counts (a row each) are summed in order, so that no
    window holds a whole resource.
    """
    rows = calls.withColumn("_slice", F.floor(F.unix_micros("ts") / F.lit(slice_s * 1_000_000)))
    in_order = Window.partitionBy("resource").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("resource", "_slice").agg(F.count("*").alias("_n")).select("resource", "_slice", F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("resource", "_slice").orderBy("ts", "call_id"))
    return rows.withColumn("_own", own).join(before, ["resource", "_slice"]).withColumn("_rn", F.col("_before") + F.col("_own")).drop("_slice", "_own", "_before")


def overlapped(rows: DataFrame, n: int, block: int = 10_000) -> DataFrame:
    """Numbered rows dealt into blocks (_block) that take the n rows before them along; _mine marks a block's own rows."""
    own = F.floor((F.col("_rn") - 1) / block)
    blocks = F.when(F.col("_rn") > (own + 1) * block - n, F.array(own, own + 1)).otherwise(F.array(own))
    return rows.withColumn("_block", F.explode(blocks)).withColumn("_mine", F.col("_block") == own)


def failure_streaks(calls: DataFrame, slice_s: int = 86_400) -> DataFrame:
    """Longest run of failures and failure rate by resource. A run is named by the successes before it, counted by slices of time and then over them."""
    rows = calls.withColumn("_slice", F.floor(F.unix_micros("ts") / F.lit(slice_s * 1_000_000)))
    in_slice = Window.partitionBy("resource", "_slice").orderBy("ts", "call_id")
    in_order = Window.partitionBy("resource").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("resource", "_slice").agg(F.sum(F.col("ok").cast("long")).alias("_n")).select("resource", "_slice", F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_before"))
    parts = rows.withColumn("_g", F.sum(F.col("ok").cast("long")).over(in_slice)).where("not ok").groupBy("resource", "_slice", "_g").agg(F.count("*").alias("n"))
    runs = parts.join(before, ["resource", "_slice"]).groupBy("resource", (F.col("_before") + F.col("_g")).alias("_run")).agg(F.sum("n").alias("n"))
    longest = runs.groupBy("resource").agg(F.max("n").alias("longest_streak"), F.count("*").alias("n_streaks"))
    return calls.groupBy("resource").agg(F.count("*").alias("n_calls"), F.avg((~F.col("ok")).cast("double")).alias("failure_rate")).join(longest, "resource", "left")


def outage_fold(ts: list[int], ok: list[bool], opened: dict, after: int = 5, rest_us: int = 30_000_000, closes: int = 2) -> list[tuple[str, bool]]:
    """(state, suppressed) of each call in order; opened carries state, failures, successes and since between calls and batches."""
    out = []
    for t, good in zip(ts, ok, strict=True):
        if opened["state"] == "open":
            if t - opened["since"] < rest_us:
                out.append(("open", True))
                continue
            opened.update(state="half_open", good=0)
        if opened["state"] == "half_open":
            if good:
                opened["good"] += 1
                if opened["good"] >= closes:
                    opened.update(state="closed", bad=0)
            else:
                opened.update(state="open", since=t)
        elif good:
            opened["bad"] = 0
        else:
            opened["bad"] += 1
            if opened["bad"] >= after:
                opened.update(state="open", since=t)
        out.append((opened["state"], False))
    return out


def outage_state(calls: DataFrame, after: int = 5, rest_s: int = 30, closes: int = 2, slice_s: int = 86_400) -> DataFrame:
    """State of each resource after each call.

    After so many successes in a row as close an outage, the first of them no sooner after the call before it than the
    rest, the state is closed whatever came before. There a resource's log is cut; the pieces are folded apart, each
    streamed in order with the state carried from row to row, so that memory stays bounded however long a piece is.
    Cuts are looked for within slices of time, where a cut that is missed between two slices only makes a piece longer,
    and are counted within a slice and then over the slices (a row each).
    """
    rest_us = rest_s * 1_000_000
    us = F.unix_micros("ts")
    rows = calls.select("resource", "call_id", us.alias("us"), "ok", F.floor(us / F.lit(slice_s * 1_000_000)).alias("_slice"))
    near = Window.partitionBy("resource", "_slice").orderBy("us", "call_id")
    won = F.coalesce(F.min(F.col("ok").cast("int")).over(near.rowsBetween(1 - closes, 0)), F.lit(0)) == 1
    full = F.count("*").over(near.rowsBetween(1 - closes, 0)) == closes
    rested = F.lag("us", closes - 1).over(near) - F.lag("us", closes).over(near) >= rest_us
    cut = rows.withColumn("_cut", (won & full & F.coalesce(rested, F.lit(False))).cast("long"))
    inner = cut.withColumn("_within", F.coalesce(F.sum("_cut").over(near.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    in_order = Window.partitionBy("resource").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy("resource", "_slice").agg(F.sum("_cut").alias("_n")).select("resource", "_slice", F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_before"))
    pieces = inner.join(before, ["resource", "_slice"]).withColumn("piece", F.col("_before") + F.col("_within"))

    def fold(parts):
        key, now = None, {}
        for part in parts:
            got = []
            for resource, piece, us, ok in zip(part["resource"], part["piece"], part["us"], part["ok"], strict=True):
                if (resource, piece) != key:
                    key, now = (resource, piece), {"state": "closed", "bad": 0, "good": 0, "since": 0}
                got += outage_fold([us], [ok], now, after, rest_us, closes)
            yield pd.DataFrame({"resource": part["resource"], "call_id": part["call_id"], "state": [s for s, _ in got], "suppressed": [x for _, x in got]})

    dealt = pieces.select("resource", "piece", "call_id", "us", "ok").repartition("resource", "piece").sortWithinPartitions("resource", "piece", "us", "call_id")
    return map_pandas(dealt, fold, "resource string, call_id long, state string, suppressed boolean")


def rate_limited_window(calls: DataFrame, n: int = 20) -> DataFrame:
    """Share of rate-limited calls among the last n of a resource; a busy resource is many blocks, each with the n rows before it."""
    w = Window.partitionBy("resource", "_block").orderBy("_rn").rowsBetween(1 - n, 0)
    rows = overlapped(numbered(calls.select("call_id", "resource", "ts", "status_code")), n)
    return rows.withColumn("share", F.avg((F.col("status_code") == 429).cast("double")).over(w)).where("_mine").select("call_id", "resource", "share")


def log_rollup(log: DataFrame) -> DataFrame:
    """log: correlation_id, stage, seconds."""
    return log.groupBy("correlation_id", "stage").agg(F.count("*").alias("n_events"), F.sum("seconds").alias("total_s"), F.max("seconds").alias("max_s"))
