"""Streams fed in several runs, and tables of buckets: order, timers, late partners, versions."""

import random

import pytest
from pyspark.sql import functions as F

from twinfold.operators import calls as A
from twinfold.sources import buckets as B
from twinfold.streaming import ordered as O
from twinfold.streaming import streams as Z

CALL = "resource string, call_id long, s double, ok boolean"


def run(spark, folder, parts, build):
    """Feed the parts one after the other, each to a new run of the query on its old checkpoint; the rows of each run."""
    out = []
    for df in parts:
        df.write.mode("append").parquet(f"{folder}/in")
        rows = build(spark.readStream.schema(df.schema).parquet(f"{folder}/in"))
        out.append([])
        rows.writeStream.foreachBatch(lambda b, n: out[-1].extend(map(tuple, b.collect()))).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    return out


def calls(spark, rows):
    return spark.createDataFrame(rows, CALL).select("resource", "call_id", F.timestamp_micros(((F.col("s") + 1_000_000) * 1_000_000).cast("long")).alias("ts"), "ok")


def test_outages_turn_half_open_by_themselves(spark, tmp_path):
    first = [("a", i, float(i), False) for i in range(5)] + [("b", 9, 1.0, True)]
    # a call in the rest, and one that comes with the watermark far behind the end of the rest
    parts = [first, [("a", 5, 20.5, True)], [("b", 10, 300.0, True)], [("a", 6, 400.0, True), ("a", 7, 401.0, True), ("b", 11, 2000.0, True)]]
    with O.rocksdb(spark):
        got = run(spark, tmp_path, [calls(spark, p) for p in parts], lambda s: O.stream_outage_state(s, 5, 30, late="10 seconds", slice_s=10).select("resource", "call_id", F.unix_micros("ts") / 1e6 - 1e6, "state", "suppressed"))
    flat = [r for part in got for r in part]
    assert sorted(r for r in flat if r[0] == "a" and r[1] is None) == [("a", None, 34.0, "half_open", False)]
    assert ("a", None, 34.0, "half_open", False) in got[2]  # no call of its own told of it
    assert [r[1:] for r in sorted((r for r in flat if r[0] == "a" and r[1] is not None), key=lambda r: r[2])] == [
        *[(i, float(i), "closed", False) for i in range(4)], (4, 4.0, "open", False), (5, 20.5, "open", True), (6, 400.0, "half_open", False), (7, 401.0, "closed", False)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_streams_equal_batches_whatever_order_calls_arrive_in(spark, tmp_path, seed):
    rng, rows, now = random.Random(seed), [], 0.0
    for i in range(400):
        now += rng.choice([0, 0.5, 1, 5, 40])
        rows.append((rng.choice("ab"), i, now, rng.random() < (0.9 if i // 50 % 2 else 0.3)))
    # calls come up to 50 seconds too late, and so out of order, also between runs; a last one lets all others through
    arrived = sorted(rows, key=lambda r: r[2] + rng.random() * 50)
    parts = [calls(spark, p) for p in (arrived[:150], arrived[150:270], arrived[270:])] + [calls(spark, [("c", 999, now + 10_000, True)])]
    every = calls(spark, rows)
    with O.rocksdb(spark):
        got = [r for part in run(spark, f"{tmp_path}/outages", parts, lambda s: O.stream_outage_state(s, 3, 30, late="60 seconds", slice_s=7)) for r in part]
    want = sorted((r["resource"], r["call_id"], r["state"], r["suppressed"]) for r in A.outage_state(every, 3, 30).collect())
    assert sorted((r, i, state, held) for r, i, _, state, held in got if i is not None) == want
    opened = sum(1 for _, _, state, held in want if state == "open" and not held)
    assert sum(i is None for _, i, *_ in got) == opened > 3
    with O.rocksdb(spark):
        usage = [r for part in run(spark, f"{tmp_path}/usage", parts, lambda s: O.stream_quota_usage(s, 20, 100, 3, 9, late="60 seconds", slice_s=7)) for r in part]
    assert sorted(usage) == sorted(map(tuple, A.quota_usage(every, 20, 100, 3, 9).select("call_id", "resource", "n_short", "n_long", "share", "near_limit", "wait_s").collect()))


def test_the_provider_of_state_is_set_only_inside(spark):
    before = spark.conf.get(O._PROVIDER, None)
    with pytest.raises(KeyError), O.rocksdb(spark):
        assert "RocksDB" in spark.conf.get(O._PROVIDER)
        raise KeyError
    assert spark.conf.get(O._PROVIDER, None) == before


def test_links_wait_for_their_tokens(spark, tmp_path):
    url = "https://source.example/wiki/"
    link = lambda rows: spark.createDataFrame(rows, "doc_id long, idx int, url string, s long").select("doc_id", "idx", "url", F.timestamp_seconds("s").alias("ts"))
    token = lambda rows: spark.createDataFrame(rows, "src string, dst string, s long").select("src", "dst", F.timestamp_seconds("s").alias("ts"))
    late = [("A", "M", 1500), ("A", "N", 1501), ("B", "O", 9000)]
    feeds = [(link([(1, 0, f"{url}A?v=1", 1000), (1, 1, f"{url}B", 1000), (1, 2, "https://elsewhere.example/wiki/A", 1000), (2, 0, None, 1000)]), token([])), (link([]), token(late)), (link([(3, 0, f"{url}A#x", 20000)]), token([("C", "P", 20000)]))]
    got = []
    for links, tokens in feeds:
        tokens.write.mode("append").parquet(f"{tmp_path}/tokens")
        got += run(spark, tmp_path, [links], lambda s: Z.stream_late_links(s, spark.readStream.schema(tokens.schema).parquet(f"{tmp_path}/tokens")))
    assert got[0] == [] and got[1] == [(1, 0, "https://target.example/wiki/M?v=1", True)]  # as soon as the token is there, the first of two
    assert sorted(got[2]) == [(1, 1, f"{url}B", False), (1, 2, "https://elsewhere.example/wiki/A", False), (2, 0, None, False)]


# --- buckets


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, at long")


def files(spark, table):
    return {f.split("/v0000")[1] for f in B.read_table(spark, table).inputFiles()}


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = f"file://{tmp_path}/t"
    assert B.upsert(rows_of(spark, [(f"k{i}", "old", 0) for i in range(200)]), table, "key", ["at", "value"], 16) == 0
    before = files(spark, table)
    changed = rows_of(spark, [("k7", "new", 1), ("k7", "newer", 2), ("k8", "older", -1)])
    touched = {r[0] for r in changed.select(B.bucket_of("key", 16)).distinct().collect()}
    assert B.upsert(changed, table, "key", ["at", "value"], 99) == 1
    after = files(spark, table)
    assert {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched} == before & after and len(before - after) == len(touched)
    got = {r["key"]: r["value"] for r in B.read_table(spark, table).collect()}
    assert len(got) == 200 and got["k7"] == "newer" and got["k8"] == "old"
    assert {r["value"] for r in B.read_table(spark, table, 0).collect()} == {"old"}  # readers of the old version still have it
    assert B.vacuum(spark, table, 2) == [] and B.vacuum(spark, table, 1) and B.versions(spark, table) == [1]
    assert files(spark, table) == after and B.read_table(spark, table).count() == 200


def test_a_batch_that_runs_twice_changes_nothing(spark, tmp_path):
    table, batch = f"file://{tmp_path}/t", rows_of(spark, [("a", "1", 1), (None, "2", 1)])
    assert [B.upsert(batch, table, "key", ["at", "value"], 4, batch=n) for n in (0, 0, 1, 0)] == [0, 0, 1, 1]
    first = files(spark, table)
    assert B.upsert(batch, table, "key", ["at", "value"], batch=1) == 1 and files(spark, table) == first
    assert sorted(map(str, B.read_table(spark, table).collect())) == sorted(map(str, batch.collect()))
    B.upsert(batch.limit(0), table, "key", ["at", "value"], batch=2)
    assert files(spark, table) == first


def test_of_two_writers_one_has_to_repeat(spark, tmp_path, monkeypatch):
    table = f"file://{tmp_path}/t"
    B.upsert(rows_of(spark, [("a", "1", 1)]), table, "key", ["at", "value"], 4)
    old = B.manifest(spark, table)
    B.upsert(rows_of(spark, [("b", "1", 1)]), table, "key", ["at", "value"])
    monkeypatch.setattr(B, "manifest", lambda *_: old)
    with pytest.raises(B.Conflict):
        B.upsert(rows_of(spark, [("c", "1", 1)]), table, "key", ["at", "value"])
    monkeypatch.undo()
    assert sorted(r["key"] for r in B.read_table(spark, table).collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        B.read_table(spark, f"file://{tmp_path}/none")


def test_the_cache_holds_the_newest_of_each_key(spark, tmp_path):
    folder, rows = f"file://{tmp_path}", [[("a", "1", 1), ("b", "1", 1)], [("a", "2", 2), ("a", "3", 3)], [("b", "0", 0)]]
    for batch in rows:
        spark.createDataFrame(batch, "key string, translated string, at long").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema("key string, translated string, at long").parquet(f"{folder}/in")
        Z.stream_cache_upsert(stream, f"{folder}/cache", f"{folder}/log", 4).awaitTermination()
    assert sorted(tuple(r) for r in Z.cached(spark, f"{folder}/cache").collect()) == [("a", "3", 3), ("b", "1", 1)]
    assert B.manifest(spark, f"{folder}/cache")["batch"] == 2


def test_folders_on_the_way_can_be_removed(spark):
    from twinfold import staging

    before = staging.made()
    rows = staging.written(spark.range(3).toDF("x"), "rows")
    (folder,) = staging.made()[len(before) :]
    fs, place = staging.hadoop(spark, folder)
    assert fs.exists(place) and rows.count() == 3
    staging.clean(spark, [folder])
    assert not fs.exists(place) and staging.made() == before
