"""Hard negatives of anchors by a secondary sort: scores stream in by anchor, best first, and fall into open windows."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .common import materialise, table

#: Rows of a block of candidates, and of a block of anchors: a pair of blocks is scored by one matrix product.
ROWS, ANCHORS = 4096, 1024
#: Blocks of anchors up to so many bytes together are broadcast, beyond that they are joined by shuffle.
BROADCAST_BYTES = 64 << 20
_BLOCK = "n int, width int, ids binary, labels binary, cells binary, windows binary"
_TOP = np.iinfo(np.int64).max


def _matrix(lists: pa.Array) -> np.ndarray:
    """The lists as rows of whole numbers; shorter ones end in zeros."""
    sizes = np.asarray(lists.value_lengths())
    out = np.zeros((len(lists), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.asarray(lists.flatten())
    return out


def _packed(ids: np.ndarray, labels: np.ndarray, cells: np.ndarray, windows: np.ndarray) -> list:
    return [len(ids), cells.shape[1], ids.tobytes(), labels.tobytes(), cells.tobytes(), windows.tobytes()]


def _unpacked(row: dict, k: str = "") -> tuple[np.ndarray, ...]:
    whole = lambda name: np.frombuffer(row[k + name], dtype=np.int64)
    return whole("ids"), whole("labels"), whole("cells").reshape(row[k + "n"], row[k + "width"])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond 64 bits they stay at the ends of a long."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = width * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -_TOP, _TOP).astype(np.int64)


def first(values: np.ndarray, mask: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k first of each row where mask holds: larger values first, ties by smaller column."""
    n = values.shape[1]
    if int(np.abs(values.astype(float)).max(initial=0)) * max(n, 1) < 2**62:
        key = np.where(mask, values * n + np.arange(n)[::-1], -_TOP)
        at = np.argpartition(-key, min(k, n) - 1, axis=1)[:, :k] if n > k else np.broadcast_to(np.arange(n), key.shape)
    else:
        at = np.array([np.lexsort((np.arange(n), -v, ~m))[:k] for v, m in zip(values, mask, strict=True)]).reshape(len(values), -1)
    rows = np.repeat(np.arange(len(values)), at.shape[1])
    at = at.ravel()
    real = mask[rows, at] if len(at) else np.zeros(0, dtype=bool)
    return rows[real], at[real]


def _blocks(rows: DataFrame) -> DataFrame:
    """rows (id, label, vec) packed into blocks of at most ROWS, each in the order of ids."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, labels = (np.asarray(part.column(i)).astype(np.int64) for i in (0, 1))
                order = np.argsort(ids, kind="stable")
                made = _packed(ids[order], labels[order], _matrix(part.column(2))[order], np.zeros(0, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(made, [pa.int32(), pa.int32()] + [pa.binary()] * 4, strict=True)], names=["n", "width", "ids", "labels", "cells", "windows"])

    return map_arrow(rows.select("id", "label", "vec"), run, _BLOCK)


def _anchor_blocks(anchors: DataFrame, n_blocks: int, k: int) -> DataFrame:
    """anchors (no, id, label, vec, own: scores of its positives) packed into n_blocks blocks by the hash of no; ids are their no."""

    def pack(part: pa.Table) -> pa.Table:
        whole = part.combine_chunks()
        column = lambda c: whole.column(c).combine_chunks() if whole.num_rows else whole.column(c)
        windows = np.full((whole.num_rows, k), -_TOP, dtype=np.int64)
        own = column("own")
        sizes = np.asarray(own.value_lengths())
        windows[np.arange(k) < sizes[:, None]] = np.asarray(own.flatten())
        both = np.column_stack([np.asarray(column("no")), np.asarray(column("id"))]).astype(np.int64)
        made = _packed(both, np.asarray(column("label")).astype(np.int64), _matrix(column("vec")), windows)
        return pa.table([pa.array([int(column("block")[0].as_py())], pa.int32()), *[pa.array([x], t) for x, t in zip(made, [pa.int32(), pa.int32()] + [pa.binary()] * 4, strict=True)]], names=["block", "n", "width", "ids", "labels", "cells", "windows"])

    placed = anchors.withColumn("block", F.pmod(F.xxhash64("no"), F.lit(n_blocks)).cast("int"))
    return placed.groupBy("block").applyInArrow(pack, f"block int, {_BLOCK}")


def _candidates(rows: DataFrame, anchors: DataFrame, n_blocks: int, small: bool, positives: bool, k: int, low: int) -> DataFrame:
    """(no, anchor, id, score) that a block of rows holds for an anchor: the k first of the anchor's label, or of each of its windows the k first of other labels.

    What is first among all rows is first in its block, so nothing is lost."""
    left = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    right = anchors.select("block", *[F.col(c).alias(f"a_{c}") for c in ("n", "width", "ids", "labels", "cells", "windows")])
    joined = left.join(F.broadcast(right) if small else right, "block")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                (ids, labels, cells), (keys, a_labels, a_cells) = _unpacked(row), _unpacked(row, "a_")
                keys = keys.reshape(-1, 2)
                found = scores(a_cells, cells)
                same = a_labels[:, None] == labels[None, :]
                if positives:
                    hits = [first(found, same & (keys[:, 1][:, None] != ids[None, :]), k)]
                else:
                    hits = []
                    for top in np.frombuffer(row["a_windows"], dtype=np.int64).reshape(len(keys), -1).T:
                        floor = np.array([-(-int(x) * low // 100) if x > -_TOP else 0 for x in top])  # the least whole score in the window
                        hits.append(first(found, ~same & (top > -_TOP)[:, None] & (found >= floor[:, None]) & (found <= top[:, None]), k))
                at = np.unique(np.concatenate([a * len(ids) + b for a, b in hits])) if len(ids) else np.zeros(0, dtype=np.int64)
                a, b = (at // len(ids), at % len(ids)) if len(ids) else (at, at)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys[a, 0], keys[a, 1], ids[b], found[a, b])], names=["no", "anchor", "id", "score"])

    return map_arrow(joined, run, "no long, anchor long, id long, score long")


def _streamed(scored: DataFrame, run, schema: str) -> DataFrame:
    """The secondary sort: rows (no, ..., score, kind, id) dealt by anchor, each anchor's best first, positives before negatives of the same score, then by id."""
    return map_arrow(scored.repartition("no").sortWithinPartitions("no", F.desc("score"), "kind", "id"), run, schema)


def mine(rows: DataFrame, is_anchor: str, n_positives: int = 5, n_negatives: int = 5, low: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: id, label (whole numbers), vec (array of whole numbers), and what is_anchor (an SQL condition on id and label)
    reads. An anchor's positives are the n_positives rows of its label, other than those of its own id, of the largest
    inner product with it. A positive's negatives are the first n_negatives rows of other labels whose score is at most
    the positive's and at least low hundredths of it. Ties go to the smaller id.

    Anchors in blocks meet rows in blocks, twice: for the positives, then, when their scores are known, for the negatives
    inside the windows. A block gives at most n_positives, or n_negatives a window, for an anchor, so what is shuffled
    doesn't grow with the scores. The shuffle sorts by (anchor, descending score, id); an iterator opens a window at each
    positive and emits negatives as they pass, holding no anchor's rows.

    Rows with a null id, label, vec or component take no part. A shorter vec counts as ended by zeros. Repeated rows count
    one each, but an anchor whose row is repeated is one anchor. Scores beyond a long stay at its ends. An empty table,
    or one without anchors, gives no rows. Labels and scores of any size and sign are taken; below zero no window is open.
    """
    spark = rows.sparkSession
    whole = rows.where("id is not null and label is not null and vec is not null and not exists(vec, x -> x is null)")
    packed = materialise(_blocks(whole), "vector-blocks")
    chosen = whole.where(is_anchor).select(F.col("id").cast("long"), F.col("label").cast("long"), F.col("vec").cast("array<long>")).distinct()
    anchors = materialise(chosen.withColumn("no", F.monotonically_increasing_id()), "anchors")
    n, cells = anchors.agg(F.count("*"), F.coalesce(F.sum(F.size("vec")), F.lit(0))).first()
    n_blocks, small = max(1, math.ceil(n / ANCHORS)), 8 * (cells + (2 + n_positives) * n) <= BROADCAST_BYTES
    none = F.array().cast("array<long>")

    def best(batches):
        key, seen = None, 0
        for batch in batches:
            keep = []
            for i, no in enumerate(batch.column("no").to_pylist()):
                key, seen = (no, 1) if no != key else (no, seen + 1)
                if seen <= n_positives:
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int32()))

    candidates = _candidates(packed, _anchor_blocks(anchors.withColumn("own", none), n_blocks, n_positives), n_blocks, small, True, n_positives, low)
    positives = materialise(_streamed(candidates.withColumn("kind", F.lit(0)), best, "no long, anchor long, id long, score long, kind int"), "positives")
    tops = positives.groupBy("no").agg(F.collect_list("score").alias("own"))
    windowed = anchors.join(tops, "no", "left").withColumn("own", F.coalesce("own", none))
    negatives = _candidates(packed, _anchor_blocks(windowed, n_blocks, n_positives), n_blocks, small, False, n_negatives, low)
    scored = positives.union(negatives.withColumn("kind", F.lit(1)))

    def pass_by(batches):
        key, windows = None, []  # of each positive: id, score, negatives so far
        for batch in batches:
            out = []
            for no, anchor, id_, score, kind in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if no != key:
                    key, windows = no, []
                if kind == 0:
                    windows.append([id_, score, 0])
                    continue
                for w in windows:
                    if w[2] < n_negatives and low * w[1] <= 100 * score <= 100 * w[1]:
                        w[2] += 1
                        out.append((anchor, w[0], w[2], id_, w[1], score))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.int32()] + [pa.int64()] * 3, strict=True)], names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return _streamed(scored, pass_by, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where("label is not null and embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    return mine(rows.select(F.col("vec_id").alias("id"), label.alias("label"), whole.alias("vec")), "id % 100 = 0")


OP13_SQL = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM given a JOIN given b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor, id, score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
)
SELECT p.anchor AS anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
