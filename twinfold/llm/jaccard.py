"""N-gram Jaccard join with count-vector R-trees."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import map_pandas
from .common import free_names, materialise, quoted, small_side, table

GROUPS = 256
FOLDED = 32
_FULL = 65_535
#: Lower ends of the size classes, each a fourth above the last.
_BORDERS = list(accumulate(range(140), lambda b, _: max(b + 1, b * 5 // 4), initial=1))
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _MIX[1]
    x = (x ^ x >> np.uint64(29)) * _MIX[2]
    return x ^ x >> np.uint64(32)


def shingles(text: str | None, width: int, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; a shorter text with words is one shingle as a whole, one without has none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.array([], dtype=np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    h = np.array([hashes[w] for w in words], dtype=np.uint64)
    n = len(h) - width + 1
    out = h[:n].copy()
    for i in range(1, width):
        out = _mixed(out * _MIX[0] + h[i : i + n])
    return np.unique(out)


def counts(hashed: np.ndarray) -> np.ndarray:
    """The point of a set: how many of its shingles fall into each of GROUPS groups, in two bytes each; _FULL stands for any larger count."""
    return np.minimum(np.bincount((hashed & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS), _FULL).astype("<u2")


def _points(column) -> np.ndarray:
    """Stored points as rows; a full count bounds nothing."""
    rows = np.frombuffer(b"".join(column), dtype="<u2").reshape(-1, GROUPS).astype(np.int32)
    return np.where(rows == _FULL, 1 << 22, rows) if (rows == _FULL).any() else rows


def _folded(points: np.ndarray) -> np.ndarray:
    """Counts of FOLDED larger groups: their summed minima bound those of the points, at an eighth of the work."""
    return points.reshape(len(points), -1, FOLDED).sum(1)


def _cells(n: int, p: int, q: int):
    """(cell family, number of cells, empty ones allowed) in which a set of n shingles may meet a partner.

    Partners with p/q of the union in common differ in at most d = (a + b)(q - p)/(q + p) shingles. The family of a
    pair is the size class of its smaller set, with the d of the largest sizes that such a pair can have; a set takes
    part in its own class and in those of the smaller partners it may have. Classes are a fourth wide, so that cells
    hold about three shingles even for the smallest sets of a class, and few of them are empty. With d = 0 only equal
    sets are partners, and those are one point already.
    """
    for family in range(bisect_right(_BORDERS, -(-n * p // q)), bisect_right(_BORDERS, n) + 1):
        most = _BORDERS[family] - 1
        if d := (most + most * q // p) * (q - p) // (q + p):
            slack = 3 + d // 10
            yield family, d + 1 + slack, slack


def keys(hashed: np.ndarray, p: int, q: int) -> np.ndarray:
    """Hashes of the filled cells. Two partners differ in at most d shingles, so of d + 1 + slack cells at least
    1 + slack are equal in both, and unless both have more than slack empty cells one of those is filled. Sets with
    more (rare: cells hold five shingles or so) all get one further key, so that they meet each other too."""
    out = []
    for family, m, slack in _cells(len(hashed), p, q):
        cell = ((hashed >> np.uint64(8)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        filled, starts = np.unique(cell[order], return_index=True)
        sums = np.add.reduceat(_mixed(hashed[order] + _MIX[0]), starts)
        out.append(_mixed(sums + np.array([family + 1], dtype=np.uint64) * _MIX[0] + filled.astype(np.uint64) * _MIX[1]))
        if m - len(filled) > slack:
            out.append(_mixed(np.array([family + 1], dtype=np.uint64) * _MIX[2] + _MIX[1]))
    return np.concatenate(out) if out else np.array([], dtype=np.uint64)


class RTree:
    """Count vectors packed into boxes of several levels: FAN points a leaf, FAN boxes a box, up to one root.

    Points are put in order by halving at the median of their sizes while these differ by a tenth, then of their widest
    coordinate, until FAN are left. The overlap of a query with any point of a box is at most the sum over coordinates
    of the smaller of the query's count and the box's upper corner; a box is left if that can't reach what the sizes
    ask for, if its sizes are out of reach, or if all its points are in the query's own component already. Each bound
    is taken over folded counts first. All queries go down the levels together.
    """

    FAN = 8
    AT_ONCE = 4096

    def __init__(self, points: np.ndarray, sizes: np.ndarray, parts: np.ndarray):
        folded = _folded(points)
        self.rows = self._order(folded, sizes)
        self.levels = [(points[self.rows], folded[self.rows], sizes[self.rows], sizes[self.rows], parts[self.rows], parts[self.rows])]
        while len(self.levels) == 1 or len(self.levels[-1][0]) > 1:
            low = self.levels[-1]
            starts = np.arange(0, len(low[0]), self.FAN)
            self.levels.append(tuple(f.reduceat(x, starts, axis=0) for f, x in zip((np.maximum, np.maximum, np.minimum, np.maximum, np.minimum, np.maximum), low, strict=True)))
        self.tested = 0

    def _order(self, folded: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        todo, done = [np.arange(len(sizes))], []
        while todo:
            rows = todo.pop()
            if len(rows) <= self.FAN:
                done.append(rows)
                continue
            own, n = folded[rows], sizes[rows]
            by = n if 10 * n.max() > 11 * n.min() else own[:, np.argmax(own.max(0) - own.min(0))]
            rows = rows[np.argsort(by, kind="stable")]
            half = -(-len(rows) // 2 // self.FAN) * self.FAN  # full leaves, so that no box reaches across a cut
            todo += [rows[half:], rows[:half]]
        return np.concatenate(done)

    def near(self, points: np.ndarray, sizes: np.ndarray, parts: np.ndarray | None, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) of all pairs whose bound allows p/q of the union in common; with parts, of different components only."""
        folded = _folded(points)
        i, at = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, upper_folded, least, most, low, high = self.levels[depth]
            self.tested += len(i) if depth else 0
            fits = (q * sizes[i] >= p * least[at]) & (q * most[at] >= p * sizes[i])
            if parts is not None:
                fits &= (low[at] != parts[i]) | (high[at] != parts[i])
            i, at = i[fits], at[fits]
            for mine, theirs in ((folded, upper_folded), (points, upper)):
                fits = [(p + q) * np.minimum(mine[i[k : k + self.AT_ONCE]], theirs[at[k : k + self.AT_ONCE]]).sum(1) >= p * (sizes[i[k : k + self.AT_ONCE]] + least[at[k : k + self.AT_ONCE]]) for k in range(0, len(i), self.AT_ONCE)]
                fits = np.concatenate(fits) if fits else np.zeros(0, dtype=bool)
                i, at = i[fits], at[fits]
            if depth:  # on to the children
                i, at = np.repeat(i, self.FAN), (at[:, None] * self.FAN + np.arange(self.FAN)).ravel()
                there = at < len(self.levels[depth - 1][0])
                i, at = i[there], at[there]
        return i, self.rows[at]


def _features(rows: DataFrame, width: int, p: int, q: int) -> DataFrame:
    def run(parts):
        hashes = _WordHashes()
        for part in parts:
            got = []
            for text in part["text"]:
                h = shingles(text, width, hashes)
                a, b = divmod(xxhash.xxh3_128_intdigest(h.tobytes()), 1 << 64)
                got.append((len(h), a - (1 << 63), b - (1 << 63), counts(h).tobytes(), keys(h, p, q).view(np.int64)))
            yield pd.concat([part.drop(columns="text"), pd.DataFrame(got, columns=["n", "a", "b", "point", "keys"], index=part.index)], axis=1)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_pandas(rows.select("row", "doc_id", "k1", "k2", "text"), run, f"row long, doc_id {kind}, k1 long, k2 long, n long, a long, b long, point binary, keys array<long>")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    def run(parts):
        hashes = _WordHashes()
        for part in parts:
            yield pd.DataFrame({"node": part["node"], "shingles": [shingles(t, width, hashes).view(np.int64) for t in part["text"]]})

    return map_pandas(texts.select("node", "text"), run, "node long, shingles array<long>")


def fine_counts(hashed: np.ndarray) -> np.ndarray:
    """The point of a set in as many groups as it takes to hold under eight shingles each, in one byte each; 255 stands for any larger count."""
    groups = max(GROUPS, 1 << (len(hashed) // 8).bit_length())
    return np.minimum(np.bincount((hashed & np.uint64(groups - 1)).astype(np.int64), minlength=groups), 255).astype(np.uint8)


def fine_overlap(x: bytes, y: bytes) -> int:
    """Summed minima of two fine points, the one of more groups folded onto those of the other."""
    groups = min(len(x), len(y))
    a, b = (np.frombuffer(v, dtype=np.uint8).astype(np.int64) for v in (x, y))
    a, b = (np.where(v == 255, 1 << 40, v).reshape(-1, groups).sum(0) for v in (a, b))
    return int(np.minimum(a, b).sum())


def _fine_points(sets: DataFrame) -> DataFrame:
    def run(parts):
        for part in parts:
            got = [np.asarray(x).view(np.uint64) for x in part["shingles"]]
            yield pd.DataFrame({"node": part["node"], "n": [len(h) for h in got], "fine": [fine_counts(h).tobytes() for h in got]})

    return materialise(map_pandas(sets.select("node", "shingles"), run, "node long, n long, fine binary"), "fine-points")


def _refined(pairs: DataFrame, fine: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs that points of a size fit for their sets still allow. Long texts fill GROUPS groups evenly, so that the
    points of any two look alike; a fine point is a thirtieth of the set that the exact test would move for each pair."""

    def run(parts):
        for part in parts:
            fits = [(p + q) * fine_overlap(x, y) >= p * t for x, y, t in zip(part["f_x"], part["f_y"], part["n_x"] + part["n_y"], strict=True)]
            yield part.loc[np.array(fits, dtype=bool), ["x", "y"]]

    side = lambda s: fine.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("fine").alias(f"f_{s}"))
    return map_pandas(pairs.join(side("x"), "x").join(side("y"), "y"), run, "x long, y long")


def _linked(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """The pairs that exact intersection confirms."""
    side = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"s_{s}"))
    common = F.size(F.array_intersect("s_x", "s_y"))
    return pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", common.alias("c"), (F.size("s_x") + F.size("s_y")).alias("t")).where(q * F.col("c") >= p * (F.col("t") - F.col("c"))).select("x", "y")


def components(links: DataFrame) -> DataFrame:
    """(node, part): the least node each linked node reaches. Rounds of least neighbour and shortcut, as many as the logarithm of the longest path; each is written, none is collected."""
    both = materialise(links.select("x", "y").union(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    parts = materialise(both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("part")), "parts")
    while True:
        around = both.join(parts, both.y == parts.node).groupBy("x").agg(F.min("part").alias("m"))
        stepped = parts.join(around, parts.node == around.x).select("node", F.col("part").alias("old"), F.least("part", "m").alias("part"))
        far = parts.select(F.col("node").alias("part"), F.col("part").alias("further"))
        parts_next = materialise(stepped.join(far, "part", "left").select("node", "old", F.least("part", F.coalesce("further", "part")).alias("part")), "parts")
        changed = not parts_next.where("old <> part").isEmpty()
        parts = parts_next.select("node", "part")
        if not changed:
            return parts


def _by_group(batches, columns: list[str], solve):
    """Runs solve on the rows of each group (rows with equal columns, which come one after the other), however batches cut them."""
    rest = None
    for batch in chain(batches, [None]):
        if batch is not None:
            rest = batch if rest is None or not len(rest) else pd.concat([rest, batch], ignore_index=True)
        if rest is None or not len(rest):
            continue
        keys = [rest[c].to_numpy() for c in columns]
        new = np.zeros(len(rest) - 1, dtype=bool)
        for k in keys:
            new |= k[1:] != k[:-1]
        ends = np.flatnonzero(new) + 1
        if batch is None:
            ends = np.append(ends, len(rest))
        if len(ends):
            points = _points(rest["point"].iloc[: ends[-1]])
            values = {c: rest[c].to_numpy() for c in rest.columns if c not in ("point", "key")}
            found = [solve(points[i:j], {c: v[i:j] for c, v in values.items()}) for i, j in zip([0, *ends[:-1]], ends, strict=True) if j - i > 1]
            rest = rest.iloc[ends[-1] :].reset_index(drop=True)
            found = [x for x in found if len(x)]
            if found:
                yield pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["x", "y"])


def _regions(nodes: DataFrame, block: int) -> DataFrame:
    """(key, size, block, node, n): the nodes that share a key, a region of space each.

    Of keys with the very same nodes (a passage that the same documents share fills many cells) one is enough. A
    crowded region is dealt by size into blocks of about `block` nodes, from counts by size, so that no task and no
    window holds it whole.
    """
    shown = nodes.select("node", "n", F.explode("keys").alias("key"))
    several = shown.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("s1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s2")).where("size > 1")
    once = materialise(several.groupBy("s1", "s2", "size").agg(F.min("key").alias("key")).select("key", "size"), "region-keys")
    # keys of very many nodes are few (their number is checked) and are picked out where they are, not sent to one task
    crowds, others = small_side(once.where(F.col("size") >= 10_000)), small_side(once.where(F.col("size") < 10_000))
    members = materialise(shown.join(crowds, "key").unionByName(shown.join(others, "key")).select("key", "size", "node", "n"), "members")
    by_size = members.where(F.col("size") > block).groupBy("key", "n").agg(F.count("*").alias("c"))
    in_order = Window.partitionBy("key").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    places = by_size.select("key", "n", F.floor(F.coalesce(F.sum("c").over(in_order), F.lit(0)) / block).alias("base"), F.ceil(F.col("c") / block).alias("ways"))
    crowded = members.where(F.col("size") > block).join(small_side(materialise(places, "region-sizes")), ["key", "n"])
    dealt = crowded.select("key", "size", (F.col("base") + F.pmod(F.xxhash64("node"), F.col("ways"))).cast("long").alias("block"), "node", "n")
    return materialise(members.where(F.col("size") <= block).select("key", "size", F.lit(0).cast("long").alias("block"), "node", "n").unionByName(dealt), "regions")


def _seeded(regions: DataFrame, nodes: DataFrame, p: int, q: int, boxes=None) -> DataFrame:
    """Pairs of the R-tree of each block of a region, fewer than it has nodes: the least node not reached yet asks the
    tree for all that the bound allows, until every node was reached."""

    def solve(points, v):
        order = np.argsort(v["node"], kind="stable")
        points, sizes, node = points[order], v["n"][order], v["node"][order]
        tree, reached, out = RTree(points, sizes, np.zeros(len(node), dtype=np.int64)), np.zeros(len(node), dtype=bool), []
        for i in range(len(node)):
            if not reached[i]:
                _, near = tree.near(points[i : i + 1], sizes[i : i + 1], None, p, q)
                near = near[~reached[near] & (near != i)]
                reached[near] = reached[i] = True
                out.append(np.column_stack([np.full(len(near), node[i]), node[near]]))
        if boxes is not None:
            boxes.add(tree.tested)
        return np.concatenate(out)

    dealt = regions.join(nodes.select("node", "point"), "node").select("key", "block", "node", "n", "point").repartition("key", "block").sortWithinPartitions("key", "block")
    return map_pandas(dealt, lambda batches: _by_group(batches, ["key", "block"], solve), "x long, y long").distinct()


def _forest(regions: DataFrame, nodes: DataFrame, parts: DataFrame, p: int, q: int, boxes=None) -> DataFrame:
    """Pairs across components that the bound allows, from regions whose nodes are in several components.

    Blocks of a region meet two by two where their sizes can be partners', so a task holds two blocks at most, however
    crowded the region. Nodes of the region's least component aren't asked about: pairs inside it need no test, and
    the others ask about it.
    """
    placed = regions.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    mixed = placed.groupBy("key").agg(F.min("part").alias("main"), F.max("part").alias("other")).where("main < other").select("key", "main")
    rows = materialise(placed.join(mixed, "key"), "forest-members")
    held = rows.groupBy("key", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    meets = (F.col("a.block") <= F.col("b.block")) & (F.col("a.most") * q >= F.col("b.least") * p) & (F.col("b.most") * q >= F.col("a.least") * p)
    pairs = held.alias("a").join(held.alias("b"), "key").where(meets).select("key", F.col("a.block").alias("one"), F.col("b.block").alias("two"))
    sides = pairs.select("key", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    dealt = rows.join(sides, ["key", "block"]).join(nodes.select("node", "point"), "node").select("key", "one", "two", "block", "main", "node", "n", "part", "point")

    def solve(points, v):
        out = []
        one, two = v["block"] == v["one"], v["block"] == v["two"]
        for held_, asking in ((one, two), (two, one)) if (one != two).any() else ((one, one),):
            asks = np.flatnonzero(asking & (v["part"] != v["main"]))
            held_ = np.flatnonzero(held_)
            if not len(asks) or not len(held_):
                continue
            tree = RTree(points[held_], v["n"][held_], v["part"][held_])
            for at in range(0, len(asks), 512):
                some = asks[at : at + 512]
                i, j = tree.near(points[some], v["n"][some], v["part"][some], p, q)
                x, y = v["node"][some[i]], v["node"][held_[j]]
                out.append(np.unique(np.column_stack([np.minimum(x, y), np.maximum(x, y)]), axis=0))
            if boxes is not None:
                boxes.add(tree.tested)
        return np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)

    ordered = dealt.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    return map_pandas(ordered, lambda batches: _by_group(batches, ["key", "one", "two"], solve), "x long, y long").distinct()


def classes(docs: DataFrame, width: int = 5, p: int = 80, q: int = 100, doc_id: str = "doc_id", text: str = "text", block: int = 4096, boxes=None) -> DataFrame:
    """One row a document: doc_id, k1 and k2 (128-bit key of doc_id and text), n_shingles, component_id, part (a number of the component, null without words).

    Documents link when they share p/q of the union of their word shingles; component_id is the least doc_id reachable.
    1. Equal sets become one node (their 128-bit hash), however many copies there are.
    2. Shingles are hashed into groups; a node's counts by group are its point. Nodes that agree on a whole cell of
       shingles share a region (see keys()), and partners share one at least.
    3. The points of each region are indexed in an R-tree, which yields fewer pairs than the region has nodes; finer
       points bound them again, exact intersection confirms, and the links give components.
    4. Regions whose nodes are in several components are asked again, for all pairs across components that the bound
       allows. These are bounded and confirmed too, and components merge. All pairs of a region are then linked, in one
       component, or ruled out by a bound or the exact test.
    Null text counts as empty; documents without words link with nothing and are their own component. Null ids don't
    count as least unless a component has no other. Repeated rows have equal sets, ties of ids are one id. Texts of any
    length are taken whole. An empty table gives an empty result. Only these columns come back, so extra columns can't
    clash. boxes: an accumulator for the number of tree boxes tested.
    """
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("k1"), F.xxhash64(F.lit("second"), F.col(doc_id), F.col(text)).alias("k2"), F.col(text).alias("text"))
    rows = materialise(_features(keyed.withColumn("row", F.monotonically_increasing_id()), width, p, q), "shingle-keys")
    filled = rows.where("n > 0")
    sets_seen = filled.groupBy("a", "b").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"))
    sets_seen = materialise(sets_seen, "sets")
    copies = materialise(filled.select("row", "a", "b").join(sets_seen.select("a", "b", "node"), ["a", "b"]).where("row <> node").select("row"), "copies")
    nodes = filled.join(small_side(copies), "row", "left_anti").select(F.col("row").alias("node"), "k1", "k2", "n", "point", "keys")
    regions = _regions(nodes, block)
    tried = materialise(_seeded(regions, nodes, p, q, boxes), "tried")
    wanted = regions.where("size > 2").select("node").union(tried.select("x")).union(tried.select("y")).distinct()
    wanted = materialise(wanted.join(nodes.select("node", "k1", "k2"), "node"), "wanted")
    sets = materialise(_sets(keyed.join(small_side(wanted), ["k1", "k2"]).dropDuplicates(["node"]), width), "shingle-sets")
    fine = _fine_points(sets)
    confirmed = lambda pairs, name: materialise(_linked(materialise(_refined(pairs, fine, p, q), "fine-pairs"), sets, p, q), name)
    links = confirmed(tried, "seed-links")
    parts = components(links)
    links = links.union(confirmed(materialise(_forest(regions.where("size > 2"), nodes, parts, p, q, boxes), "forest-pairs"), "forest-links"))
    parts = components(links)
    least = parts.join(sets_seen, "node").groupBy("part").agg(F.min("least_id").alias("component_id"))
    found = sets_seen.join(parts.join(least, "part").select("node", "part", "component_id"), "node", "left").select("a", "b", F.coalesce("component_id", "least_id").alias("component_id"), F.coalesce("part", "node").alias("part"))
    joined = filled.join(found, ["a", "b"]).select("doc_id", "k1", "k2", F.col("n").alias("n_shingles"), "component_id", "part")
    return joined.union(rows.where("n = 0").select("doc_id", "k1", "k2", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("part")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without near copies: of each component one document stays, that of its least doc_id (a null only where it has no other).

    Rows alike in doc_id and text count as one document, and so do those without words; all documents without words
    stay. Columns as in docs, whatever their names. Only the keys of what goes, and rows that stand more than once,
    are joined or shuffled: most documents pass straight through.
    """
    found = materialise(classes(docs, doc_id=doc_id, text=text, **options), "classes")
    first = found.where("part is not null and doc_id <=> component_id").groupBy("part").agg(F.min(F.struct("k1", "k2")).alias("k")).select("k.k1", "k.k2")
    kept = first.union(found.where("part is null").select("k1", "k2").distinct()).withColumn("stays", F.lit(True))
    judged = materialise(found.groupBy("k1", "k2").agg(F.count("*").alias("times")).join(kept, ["k1", "k2"], "left"), "judged")
    k1, k2 = free_names(docs, "k1", "k2")
    named = lambda df: small_side(materialise(df.select(F.col("k1").alias(k1), F.col("k2").alias(k2)), "keys"))
    keyed = docs.withColumns({k1: F.xxhash64(F.col(doc_id), F.col(text)), k2: F.xxhash64(F.lit("second"), F.col(doc_id), F.col(text))})
    once = keyed.join(named(judged.where("stays is null or times > 1")), [k1, k2], "left_anti")
    again = keyed.join(named(judged.where("stays and times > 1")), [k1, k2], "left_semi").dropDuplicates([k1, k2])
    return once.select(*map(quoted, docs.columns)).union(again.select(*map(quoted, docs.columns)))


def op9_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"), width=3, p=90, q=100).select("doc_id", "n_shingles", "component_id")
