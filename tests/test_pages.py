"""Landed pages as a source and a stream, numbered batches as a sink."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from twinfold.sources import pages as P
from twinfold.sources import sinks as W


def land(folder, first, last, final=None, n=3):
    for p in range(first, last + 1):
        place = folder / f"page_no={p}"
        place.mkdir(parents=True)
        items = [{"node_token": f"n{p}-{i}", "parent_node_token": "" if i else "up", "has_child": i == 0, "title": None} for i in range(n)]
        (place / "part-0.json").write_text(json.dumps({"data": {"items": items, "has_more": p != final}}))


def test_the_listing_ends_with_its_last_page(spark, tmp_path):
    land(tmp_path, 0, 30, final=24)
    rows = P.src_node_pages(spark, f"file://{tmp_path}", pages_per_task=4)
    got = rows.orderBy("page_no", "item").collect()
    assert [(r["page_no"], r["item"], r["node_token"]) for r in got] == [(p, i, f"n{p}-{i}") for p in range(25) for i in range(3)]
    assert rows.rdd.getNumPartitions() == 7 and got[0]["title"] is None and got[0]["obj_type"] is None


def test_filters_and_columns_reach_the_source(spark, tmp_path, capsys):
    land(tmp_path, 0, 30)
    rows = P.src_node_pages(spark, f"file://{tmp_path}", columns=["page_no", "node_token", "parent_node_token"], pages_per_task=5)
    assert rows.columns == ["page_no", "node_token", "parent_node_token"]
    few = rows.where("page_no > 3 and page_no <= 12 and parent_node_token = 'up' and length(node_token) > 0")
    assert [r["node_token"] for r in few.orderBy("page_no").collect()] == [f"n{p}-0" for p in range(4, 13)] and few.rdd.getNumPartitions() == 2
    few.explain("formatted")
    shown = capsys.readouterr().out
    pushed = next(line for line in shown.splitlines() if "PushedFilters" in line)
    assert "page_no" in pushed and "parent_node_token" in pushed
    assert rows.where("page_no in (3, 40)").count() == 3 and rows.where("page_no = 40").count() == 0


def test_a_reader_hands_back_what_it_cannot_test():
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNull, LessThan

    reader = P.PageReader({"path": "x", "last": "20"}, P.NODES)
    left = list(reader.pushFilters([GreaterThan(("page_no",), 3), LessThan(("page_no",), 9), IsNull(("title",)), EqualTo(("title",), "a"), EqualTo(("title",), "b")]))
    assert (reader.low, reader.high, reader.same) == (4, 8, {"title": "a"}) and left == [IsNull(("title",)), EqualTo(("title",), "b")]


def test_a_stream_follows_pages_to_the_last(spark, tmp_path):
    pages, got = tmp_path / "pages", []
    for first, last, want in ((0, 4, [*range(5)]), (6, 7, []), (5, 5, [5, 6, 7]), (8, 12, [8, 9]), (13, 14, [])):
        land(pages, first, last, final=9)
        before = len(got)
        stream = P.stream_node_pages(spark, f"file://{pages}", pages_per_task=2, max_pages=3)
        query = stream.writeStream.foreachBatch(lambda b, n: got.extend((r["page_no"], r["item"]) for r in b.collect())).option("checkpointLocation", f"{tmp_path}/log").start()
        query.processAllAvailable()
        query.stop()
        assert sorted(got[before:]) == [(p, i) for p in want for i in range(3)]


# --- batches


def test_batches_are_written_whole_and_in_order(spark, tmp_path):
    rows = spark.range(1300).select((F.col("id") % 2).alias("k"), "id")
    batched = W.sink_chunked_batches(rows, "k", "id", size=100, span=50)
    P.write_batches(batched, "k", "id", f"file://{tmp_path}/out")
    got = P.read_batches(spark, f"file://{tmp_path}/out", "k long, id long, batch_id long")
    assert got.count() == 1300 and got.select("id").distinct().count() == 1300
    assert {r["count"] for r in got.groupBy("batch").count().collect()} == {100, 50} and got.where("batch <> concat('batch-', k, '-', batch_id)").isEmpty()
    name = next(f for f in (tmp_path / "out").rglob("batch-1-2.json"))
    assert [json.loads(line)["id"] for line in name.read_text().splitlines()] == [*range(401, 600, 2)]


def test_a_task_that_fails_once_leaves_each_batch_once(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    part = lambda *names: pa.RecordBatch.from_pydict({"batch": list(names), "body": [json.dumps({"x": n}) for n in names]})

    def broken():
        yield part("batch-a-0", "batch-a-0", "batch-a-1")
        raise OSError("executor lost")

    writer = P.BatchWriter(path)
    with pytest.raises(OSError):
        writer.write(broken())
    twice = [writer.write(iter([part("batch-a-0", "batch-a-0", "batch-a-1"), part("batch-a-1")])) for _ in range(2)]  # the second is speculation that lost
    other = writer.write(iter([part("batch-b-0")]))
    assert P.committed(path) == []  # nothing counts before the commit
    writer.commit([twice[0], other, None])
    got = sorted((r["batch"], r["x"]) for r in P.read_batches(spark, path, "x string").collect())
    assert got == [(n, n) for n in ("batch-a-0", "batch-a-0", "batch-a-1", "batch-a-1", "batch-b-0")]
    writer.abort([twice[1]])
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("attempt-")]) == 3


def test_nothing_is_written_for_no_rows(spark, tmp_path):
    rows = spark.range(0).select(F.col("id").alias("k"), "id", F.col("id").alias("batch_id"))
    P.write_batches(rows, "k", "id", f"file://{tmp_path}/out")
    assert P.read_batches(spark, f"file://{tmp_path}/out", "k long").collect() == []


def test_schemes():
    assert P.files("/tmp")[1] == P.files("file:///tmp")[1] == "/tmp"
