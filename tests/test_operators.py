"""Boundary cases on literal rows."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinfold.functions import text as X
from twinfold.operators import blocks as B
from twinfold.operators import calls as A
from twinfold.operators import changes as C
from twinfold.operators import checks as K
from twinfold.operators import links as L
from twinfold.operators import state as S
from twinfold.operators import translate as R
from twinfold.operators import tree as O
from twinfold.sources import landing as D
from twinfold.sources import sinks as W

BLOCK = "doc_id long, idx int, block_id string, block_type int, content string, url string"


def blocks(spark, texts, doc=1):
    return spark.createDataFrame([(doc, i, f"b{i}", 2, t, "") for i, t in enumerate(texts)], BLOCK)


def test_change_events(spark):
    nodes = spark.createDataFrame([("a", "A", 60_000), ("b", "B", 60_001), ("c", "C2", 99_999_999), ("d", "D", 5), ("", "x", 1)], "node_token string, title string, edit_ms long")
    state = spark.createDataFrame([("1", "a", "A", 0, ""), ("2", "b", "B", 0, ""), ("3", "c", "C", 0, ""), ("4", "gone", "G", 0, "")], "record_id string, node_token string, title string, last_edit_ms long, mirror_token string")
    got = {r["node_token"]: r["event"] for r in C.crawl_classify(nodes, state).collect()}
    assert got == {"a": "unchanged", "b": "edited", "c": "renamed", "d": "new"}
    assert [r["record_id"] for r in C.crawl_deleted(nodes, state).collect()] == ["4"]


def md5(*parts):
    return hashlib.md5("".join(parts).encode()).hexdigest()


def test_block_hash_layout(spark):
    element = lambda kind, content="", url="", token="", title="": F.struct(*[F.lit(v).alias(n) for n, v in zip(("kind", "content", "url", "token", "title"), (kind, content, url, token, title), strict=True)])
    cases = {
        "run": (2, [element("text_run", "Hello")], md5("2\x01text\x02Hello\x00\x03")),
        "two": (12, [element("text_run", "a", "u"), element("text_run", "b")], md5("12\x01bullet\x02a\x00u\x00b\x00\x03")),
        "doc": (2, [element("mention_doc", "x", "u", "k", "t"), element("equation", "e"), element("mention_user", "m")], md5("2\x01text\x02k\x00u\x00t\x03")),
        "none": (27, [element("text_run", "a")], md5("27\x01")),
    }
    for kind, elements, want in cases.values():
        assert spark.range(1).select(B.block_hash(F.lit(kind), F.array(*elements)).alias("h")).first()["h"] == want
    assert cases["run"][2] == "fd898344549b8502328dbb45fa7ee223"


CODES = {
    99991400: "rate_limit", 230001: "rate_limit", 131009: "lock", 1254606: "lock", 1770001: "lock", 4000080: "lock", 99991663: "auth", 99991664: "auth", 99991665: "auth", 1061045: "auth",
    131005: "not_found", 131008: "not_found", 1770003: "not_found", 1770006: "not_found", 131006: "permission", 1770032: "permission", 1254030: "permission", 1254040: "permission",
    1254045: "schema", 1254046: "schema", 1254050: "schema", 131001: "server", 230002: "server", 800004135: "server", 800014300: "server",
    429: "rate_limit", 500: "server", 599: "server", 401: "permission", 403: "permission", 404: "not_found", 600: "unknown", 99991661: "unknown", 0: "unknown", None: "unknown",
}


def test_every_code(spark):
    rows = spark.createDataFrame([(c,) for c in CODES], "code long").select("code", A.classify_code(F.col("code")).alias("c")).collect()
    assert {r["code"]: r["c"] for r in rows} == CODES


@pytest.mark.parametrize(("code", "message", "status", "want"), [
    (None, "Insufficient_Quota", None, "quota"), (0, "out of credit", 404, "quota"), (0, "Rate Limit hit", None, "rate_limit"), (0, "rate_limit: quota", None, "quota"), (0, "credit card", None, "unknown"),
    (0, "Connection reset by peer", None, "network"), (0, "connection lost", None, "unknown"), (0, "unexpected EOF", None, "network"), (0, "TLS handshake failed", 500, "network"), (0, "too many requests", 429, "rate_limit"),
    (1254045, "timeout", 500, "schema"), (7, "quota", 429, "unknown"), (None, None, 403, "permission"), (None, "", None, "unknown"),
])
def test_messages(spark, code, message, status, want):
    row = spark.createDataFrame([(code, message, status)], "code long, message string, status long")
    assert row.select(A.classify_message(F.col("code"), F.col("message"), F.col("status")).alias("c")).first()["c"] == want


@pytest.mark.parametrize(("category", "waits", "retried"), [
    ("rate_limit", [2, 4, 8, 16, 32, 60], True), ("network", [1, 2, 4, 8, 8, 8], True), ("lock", [5, 10, 20, 40, 60, 60], True), ("quota", [30, 60, 120, 240, 480, 600], True), ("server", [2, 4, 8, 16, 30, 30], True),
    ("auth", [0] * 6, True), ("unknown", [1, 2, 4, 8, 16, 32], True), ("schema", [1, 2, 4, 8, 16, 32], False), ("permission", [1, 2, 4, 8, 16, 32], False), ("not_found", [1, 2, 4, 8, 16, 32], False),
])
def test_backoff(spark, category, waits, retried):
    rows = spark.range(6).select("id", A.retry_advice(F.lit(category), F.col("id")).alias("a")).orderBy("id").collect()
    assert [r["a"]["seconds"] for r in rows] == waits and {r["a"]["retryable"] for r in rows} == {retried}


def test_legacy_children(spark):
    body = '{"a": ["x", 42, true, {"y": 1}, "42", null], "b": {"p": 2, "q": -1, "r": "0", "s": 1.5}, "c": "no", "d": []}'
    got = O.children_index_legacy(spark.createDataFrame([(body,), ("[1]",), ("bad",), (None,)], "body string")).orderBy("parent", "pos").collect()
    assert [(r["parent"], r["child"], r["pos"]) for r in got] == [("a", "x", 0), ("a", "42", 1), ("b", "q", 0), ("b", "s", 1), ("b", "p", 2)]


def test_fixed_elements_stay_whole(spark):
    kind = "array<struct<kind:string,content:string,url:string,token:string,title:string,style:map<string,string>>>"
    run = ("text_run", "hi", "https://source.example/wiki/A", "", "", {"bold": "true"})
    rows = [(1, 0, [run, ("mention_user", "u", "https://source.example/wiki/A", None, None, None), ("mention_doc", None, "https://source.example/wiki/A", "k", "t", None)]), (1, 1, []), (1, 2, [("equation", "e", None, None, None, None)])]
    got = L.fix_elements(spark.createDataFrame(rows, f"doc_id long, idx int, elements {kind}"), spark.createDataFrame([("A", "M")], "src string, dst string")).orderBy("idx").collect()
    new = "https://target.example/wiki/M"
    assert [tuple(e) for e in got[0]["elements"]] == [(*run[:2], new, *run[3:]), rows[0][2][1], (*rows[0][2][2][:2], new, "k", "t", None)] and got[0]["n_replaced"] == 2
    assert [(list(map(tuple, r["elements"])), r["n_replaced"]) for r in got[1:]] == [([], 0), (rows[2][2], 0)]


def test_the_first_of_the_delta_is_inserted(spark):
    table, delta = (spark.createDataFrame(r, "k string, v string, at long") for r in ([("a", "old", 0)], [("b", "late", 5), ("b", "early", 2), ("a", "new", 1)]))
    assert sorted(tuple(r) for r in W.sink_insert_ignore(table, delta, ["k"], "at").collect()) == [("a", "old", 0), ("b", "early", 2)]


def test_cut_logs_fold_as_whole_ones(spark):
    """Random logs: pieces folded apart give the states of one fold of the whole log, whatever the blocks."""
    import random

    random.seed(4)
    rows, now = [], 0
    for i in range(3000):
        now += random.choice([1, 1, 1, 5, 40])
        rows.append(("r", i, now, random.random() < (0.9 if i // 100 % 2 else 0.3)))
    calls = spark.createDataFrame(rows, "resource string, call_id long, s long, ok boolean").withColumn("ts", F.timestamp_seconds("s"))
    want = A.outage_fold([s * 1_000_000 for _, _, s, _ in rows], [ok for *_, ok in rows], {"state": "closed", "bad": 0, "good": 0, "since": 0})
    for slice_s in (86_400, 100, 7):
        got = {r["call_id"]: (r["state"], r["suppressed"]) for r in A.outage_state(calls, slice_s=slice_s).collect()}
        assert [got[i] for i in range(3000)] == want
    few = A.overlapped(A.numbered(calls, 60), 20, 64)
    assert few.where("_mine").count() == 3000 and few.groupBy("_block").count().agg(F.max("count")).first()[0] <= 84


@pytest.mark.parametrize("source, target, want", [([], [], {}), (["a", "b"], ["a"], {"keep": 1, "append": 1}), (["a"], ["a", "b"], {"keep": 1, "delete": 1}), ([str(i) for i in range(100)], [str(i) if i % 20 else "edited" for i in range(100)], {"keep": 95, "replace": 5})])
def test_block_diff(spark, source, target, want):
    got = {r["op"]: r["count"] for r in B.block_diff(blocks(spark, source), blocks(spark, target)).groupBy("op").count().collect()}
    assert got == want


@pytest.mark.parametrize("now, want", [("d3 d2 d1", "d1 d2 d3"), ("d1 d3 d2", "d2 d3"), ("x d1 d2 d3", ""), ("d2 x d1", "d1 d2")])
def test_order_moves(spark, now, want):
    desired = spark.createDataFrame([("p", i, f"s{i + 1}") for i in range(3)], "parent string, pos long, child string")
    current = spark.createDataFrame([("p", i, c) for i, c in enumerate(now.split())], "parent string, pos long, child string")
    mapping = spark.createDataFrame([(f"s{i}", f"d{i}") for i in (1, 2, 3)], "src string, dst string")
    rows = O.order_moves(desired, current, mapping).where("moves").orderBy("rank").collect()
    assert " ".join(r["child"] for r in rows) == want


def test_url_rewrite(spark):
    cases = {
        "https://source.example/wiki/A": "https://target.example/wiki/M",
        "https://source.example/wiki/A#part": "https://target.example/wiki/M#part",
        "see https://source.example/docx/A?x=1&y=2": "https://target.example/wiki/M?x=1&y=2",
        "https%3A%2F%2Fsource.example%2Fwiki%2FA": "https://target.example/wiki/M",
        "https://source.example/wiki/A?q=a+b%zz": "https://target.example/wiki/M?q=a+b%zz",
        "https://source.example/wiki/UNKNOWN": "https://source.example/wiki/UNKNOWN",
        "https://target.example/wiki/A": "https://target.example/wiki/A",
        "": "",
    }
    links = spark.createDataFrame([(u,) for u in cases], "url string")
    got = L.url_rewrite(links, spark.createDataFrame([("A", "M")], "src string, dst string"), with_escapes=True)
    assert {r["url"]: r["new_url"] for r in got.collect()} == cases


@pytest.mark.parametrize("given, want", [("```\nHi\n```", "Hi"), ('"Hi"', "Hi"), ("Translation: Hi", "Hi"), ("é", "é"), ("", ""), (None, ""), ("plain", "plain")])
def test_clean_artifacts(spark, given, want):
    row = spark.createDataFrame([(given,)], "t string").select(X.clean_artifacts(F.col("t")).alias("t")).first()
    assert row["t"] == want


@pytest.mark.parametrize("given, output, passed, issues", [("飞书文档 AI", "Tài liệu AI", True, []), ("飞书文档 AI", "Tài liệu 文 AI", False, ["cjk_leak"]), ("飞书文档", "", False, ["empty_output", "looks_untranslated"]), ("飞书文档", "飞书文档", False, ["cjk_leak", "looks_untranslated"]), ("文档", "khong duoc viec nay nguoi", True, ["unaccented"]), ("x" * 40, "abc", True, ["suspicious_ratio"])])
def test_quality(spark, given, output, passed, issues):
    q = spark.createDataFrame([(given, output)], "a string, b string").select(X.assess_quality(F.col("a"), F.col("b")).alias("q")).first()["q"]
    assert (q["passed"], q["issues"]) == (passed, issues)


def test_packing(spark):
    items = spark.createDataFrame([(1, i, "x" * n) for i, n in enumerate((26, 5, 10, 6, 30, 1))], "doc_id long, idx int, text string")
    assert [r["batch_no"] for r in R.pack_batches(items, 20, 30).orderBy("idx").collect()] == [0, 1, 1, 2, 3, 4]


@pytest.mark.parametrize("raw, n, want", [("<<<item-0>>>\na\n<<<item-1>>>\nb\nc", 2, ["a", "b\nc"]), ("<<<item-0>>>\na", 2, None), ("<<<item-0>>>\na\n<<<item-2>>>\nb", 2, None), ("```\n<<<item-0>>>\na\n```", 1, ["a"])])
def test_reply_parser(spark, raw, n, want):
    got = spark.createDataFrame([(raw,)], "r string").select(R.parse_batch_response(F.col("r"), F.lit(n)).alias("p")).first()["p"]
    assert (got and [x["text"] for x in got]) == want


def test_outage_reopens_after_a_failed_probe():
    second = 1_000_000
    ts = [i * second for i in range(6)] + [40 * second, 41 * second, 80 * second, 81 * second]
    got = A.outage_fold(ts, [False] * 7 + [True] * 3, {"state": "closed", "bad": 0, "good": 0, "since": 0})
    assert [s for s, _ in got] == ["closed"] * 4 + ["open"] * 4 + ["half_open", "closed"]
    assert [x for _, x in got] == [False] * 5 + [True, False, True, False, False]


def test_schema_apply_is_idempotent(spark):
    want = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])
    once = K.schema_apply(spark.range(2), want)
    assert once.columns == ["id", "note"] and K.schema_apply(once, want).schema == once.schema


@pytest.mark.parametrize("raw, want", [(None, ("", "")), ('{"link":"u","text":"t"}', ("u", "t")), ('[{"link":"u"}]', ("u", "")), ('"s"', ("s", "s")), ("17", ("", ""))])
def test_link_field(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "r string").select(D.parse_link_field(F.col("r")).alias("l")).first()["l"]
    assert tuple(got) == want


def test_one_run_hashes_as_its_array_does(spark):
    rows = spark.createDataFrame([(2, "a", "u"), (2, None, None), (27, "a", "u"), (99, "", ""), (3, "x\x00y", "")], "block_type int, content string, url string")
    kind, run = F.col("block_type"), (F.col("content"), F.col("url"))
    assert rows.where(B.run_hash(kind, *run) != B.block_hash(kind, F.array(B.text_run(*run)))).isEmpty() and rows.where(B.run_hash(kind, *run).isNull()).isEmpty()


def test_one_row_a_token_needs_no_sort_of_whole_trails(spark, capsys):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("", 9, "n"), (None, 9, "n"), ("b", 1, None)], "node_token string, pos long, title string")
    got = C.state_dedupe(rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.where("node_token = 'a' and pos = 3 or node_token = 'b'").collect()))
    got.explain("simple")
    plan = capsys.readouterr().out
    assert "partial_max_by" in plan and "Window" not in plan
    events = spark.createDataFrame([("r", i, i % 3) for i in range(100)], "record_id string, pos long, n int")
    kept = S.audit_append(events.where("pos < 90"), events.where("pos >= 90"), 30)
    assert sorted(r["pos"] for r in kept.collect()) == list(range(70, 100))
    kept.explain("simple")
    plan = capsys.readouterr().out
    # each task keeps thirty rows a record before they are shuffled
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_rounds_end_with_every_item(spark):
    packed = spark.createDataFrame([(1, i, i // 5, f"text {i}") for i in range(13)] + [(2, 0, 0, "bad"), (3, 0, 0, "a"), (3, 1, 0, "bad"), (3, 2, 0, "c")], "doc_id long, idx long, batch_no long, text string")

    def reply(messages):
        return [m.upper().replace("ITEM", "item") if "bad" not in m else "lost" for m in messages]

    got = {(r["doc_id"], r["idx"]): (r["state"], r["text"], r["n_rounds"]) for r in R.translate_rounds(packed, reply).collect()}
    assert len(got) == 17 and all(got[1, i] == ("done", f"TEXT {i}", 1) for i in range(13))
    assert got[2, 0] == ("failed", None, 1) and got[3, 0] == ("done", "A", 2) and got[3, 1] == ("failed", None, 3) and got[3, 2] == ("done", "C", 3)


def test_walks_of_wide_and_repeated_nodes(spark):
    rows = [("r", "", True, 0)] + [(f"c{i}", "r", True, 1000 - i) for i in range(50)] + [(f"g{i}", f"c{i % 50}", False, i) for i in range(200)] + [("x", "g3", False, 1), ("k1", "k2", True, 5), ("k2", "k1", True, 6), ("c7", "r", True, 2000)]
    nodes = spark.createDataFrame(rows, "node_token string, parent_token string, has_child boolean, pos long")
    want, rank = [], 0

    def walk(token, more, depth):
        nonlocal rank
        rank += 1
        want.append(("r", token, depth, rank))
        for child in sorted((r for r in rows if r[1] == token), key=lambda r: r[3]) if more else ():
            walk(child[0], child[2], depth + 1)

    walk("r", True, 0)
    for span in (100_000, 3):
        assert sorted(map(tuple, O.tree_walk_dfs(nodes, span=span).collect())) == sorted(want)
    assert O.tree_walk_dfs(nodes.limit(0)).collect() == []


def test_quotas_of_dense_logs(spark, capsys):
    """Counts equal brute force, whatever the slices, and no window is counted anew from each call."""
    import random

    random.seed(5)
    rows = [(i, random.choice(["a", "a", "b", None]), None if i % 50 == 0 else random.randrange(0, 400_000_000, 250_000)) for i in range(1500)]
    rows += [(1500 + i, "a", 100_000_000 + i // 3) for i in range(600)]
    calls = spark.createDataFrame(rows, "call_id long, resource string, us long").withColumn("ts", F.timestamp_micros("us"))
    want = {}
    for i, r, t in rows:
        same = [u for _, q, u in rows if q == r]
        near = lambda s: [u for u in same if (u is None) == (t is None) and (t is None or t - s * 1_000_000 <= u <= t)]  # noqa: B023, E731
        short, long = near(7), near(60)
        share = max(len(short) / 9, len(long) / 80)
        wait = 0.0 if len(short) < 9 else None if t is None else (min(short) + 7_000_000 - t) / 1e6
        want[i] = (r, len(short), len(long), share, share >= 0.8, wait)
    for slice_s in (3600, 20, 1):
        usage = A.quota_usage(calls, 7, 60, 9, 80, slice_s=slice_s)
        assert {r[0]: tuple(r)[1:] for r in usage.collect()} == want
    usage.explain("simple")
    assert "RangeFrame, -" not in capsys.readouterr().out


@pytest.fixture
def no_broadcast(spark):
    """Joins by shuffles, as where the other side is too large to be sent to all; partitions stay as they were dealt."""
    held = {"spark.sql.optimizer.disableHints": "true", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def largest_share(df):
    """Of the rows of a result, in its largest partition."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_texts_too_long_for_the_glossary_are_spread(spark, no_broadcast):
    items = spark.range(4000).select("id", F.when(F.col("id") % 100 == 0, " short ").otherwise(F.concat(F.lit("a text of more than twenty letters "), "id")).alias("text"))
    glossary = spark.createDataFrame([("short", "s", 0, 1), ("other", "o", 0, 2)], "src string, dst string, section_order int, entry_order int")
    got = R.glossary_lookup(items, glossary)
    assert got.columns == ["id", "text", "glossary_text"] and got.count() == 4000
    assert got.where("glossary_text = 's'").count() == 40 and got.where("glossary_text is not null and id % 100 <> 0").isEmpty()
    assert largest_share(got) < 0.3


def test_links_that_lead_elsewhere_are_spread(spark, no_broadcast):
    wiki = "https://source.example/wiki/"
    urls = ["", "", "", "https://other.example/wiki/T1", f"HTTPS://Source.Example/wiki/A?n={{}}", f"{wiki}none", None, f"https://target.example/?to={wiki}A", f"x {wiki}A#p"]
    links = spark.createDataFrame([(i, urls[i % 9].format(i) if urls[i % 9] else urls[i % 9]) for i in range(3600)], "doc_id int, url string").withColumn("style", F.create_map(F.lit("bold"), F.lit("true")))
    got = L.url_rewrite(links, spark.createDataFrame([("A", "M"), ("T1", "N")], "src string, dst string"))
    assert got.columns == ["url", "doc_id", "style", "new_url", "replaced"] and largest_share(got) < 0.4
    new = {4: "https://target.example/wiki/M?n={}", 8: "https://target.example/wiki/M#p"}
    for r in got.collect():
        i = r["doc_id"] % 9
        assert (r["new_url"], r["replaced"]) == (new[i].format(r["doc_id"]) if i in new else r["url"], i in new)


def test_rounds_shuffle_texts_once(spark):
    """Marks in any order, every split, null texts and documents without an id; no shuffle after the first gathering."""
    packed = spark.createDataFrame([(d, i, i // 6, None if (d, i) == (2, 4) else f"{'bad' if i == d else 'text'} {i}") for d in (1, 2, None) for i in range(13) if d or i < 3], "doc_id long, idx int, batch_no int, text string")

    def reply(messages):
        import re

        return ["".join(reversed(re.findall("<<<item-[^<]*", m.replace("text", "TEXT")))) if "bad" not in m else None for m in messages]

    rounds = R.translate_rounds(packed, reply)
    got = {(r["doc_id"], r["idx"]): (r["state"], r["text"]) for r in rounds.collect()}
    assert len(got) == rounds.count() == 29 and rounds.columns == ["doc_id", "idx", "state", "text", "n_rounds"]
    for (d, i), found in got.items():
        assert found == (("failed", None) if i == d or (d, i) == (2, 4) else ("done", f"TEXT {i}"))
    assert "Exchange" not in rounds._jdf.queryExecution().toString()


def test_long_texts_are_routed_by_joins_of_either_kind(spark, no_broadcast):
    """A large glossary is joined by a shuffle: routes and pending texts are those of a broadcast one."""
    items = spark.createDataFrame([(i, i % 3, f"é {i % 7} and a text of more than twenty letters" if i % 4 else "é") for i in range(60)], "doc_id long, idx int, text string")
    glossary = spark.createDataFrame([("é", "e", 0, 1)], "src string, dst string, section_order int, entry_order int")
    routed = R.route_items(items, glossary, spark.createDataFrame([], "key string, translated string"), "é")
    assert {r["route"]: r["count"] for r in routed.groupBy("route").count().collect()} == {"glossary": 15, "pending": 45}
    once = R.pending_once(routed)
    assert once.count() == 7 and once.agg(F.sum("n_uses")).first()[0] == 45
    # no task of the glossary's join gets the texts that are too long for it
    assert largest_share(R.glossary_lookup(items, glossary)) < 0.6
