"""Tree order: walks, child indexes and reorder plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import written


def summed_before(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str, span: int) -> DataFrame:
    """rows with out, the sum of value over the rows of the same keys that come before; order begins with a number.

    Sums run within spans of that number, and the spans' totals (a row each) are summed in order, so that a key of very
    many rows is many windows.
    """
    spans = rows.withColumn("_span", F.floor(F.col(order[0]) / span))
    earlier = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    totals = spans.groupBy(*keys, "_span").agg(F.sum(value).alias("_total")).select(*keys, "_span", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_sum_before"))
    within = Window.partitionBy(*keys, "_span").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = spans.withColumn("_sum_own", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return own.join(totals, [*keys, "_span"]).withColumn(out, F.col("_sum_before") + F.col("_sum_own")).drop("_span", "_sum_before", "_sum_own")


def tree_walk_dfs(nodes: DataFrame, max_depth: int = 10, span: int = 100_000) -> DataFrame:
    """root, node_token, depth and dfs_rank within its root's tree, pre-order, children in listing order; max_depth is still walked. Cycles end there too.

    Levels are joined one after the other and written once. A subtree's size is the number of nodes that have its top on
    their way; a node stands behind its parent and the subtrees of its earlier siblings, so its rank is the sum of these
    over its way. No task sees a whole tree, however many nodes a root or a parent has.
    """
    child = nodes.select(F.col("node_token").alias("c"), "parent_token", F.col("has_child").alias("more"), F.col("pos").alias("at"))
    level = nodes.where("parent_token = ''").select("node_token", F.col("node_token").alias("root"), "has_child", "pos", F.array().cast("array<bigint>").alias("way"))
    levels: list[DataFrame] = []
    for depth in range(max_depth + 1):
        # what is walked along is an occurrence of a node: one that is listed twice has two
        level = written(level.withColumn("way", F.concat("way", F.array(F.monotonically_increasing_id()))), f"level-{depth}")
        if level.isEmpty():
            break
        levels.append(level)
        level = level.where("has_child").join(child, F.col("node_token") == F.col("parent_token")).select(F.col("c").alias("node_token"), "root", F.col("more").alias("has_child"), F.col("at").alias("pos"), "way")
    if not levels:
        return level.select("root", "node_token", F.lit(0).alias("depth"), F.lit(1).cast("bigint").alias("dfs_rank"))
    walked = reduce(DataFrame.union, levels).select("root", "node_token", "pos", "way", (F.size("way") - 1).alias("depth"))
    steps = walked.select(F.posexplode("way").alias("depth", "id"))
    sizes = steps.groupBy("depth", "id").agg(F.count("*").alias("size"))
    placed = walked.select("depth", F.element_at("way", -1).alias("id"), F.try_element_at("way", F.lit(-2)).alias("parent"), "pos", "node_token").where("depth > 0").join(sizes, ["depth", "id"])
    behind = summed_before(placed, ["depth", "parent"], ["pos", "node_token", "id"], "size", "before", span).select("depth", "id", (F.col("before") + 1).alias("behind"))
    ways = walked.select(F.col("depth").alias("own"), F.element_at("way", -1).alias("me"), F.posexplode("way").alias("depth", "id")).where("depth > 0")
    ranks = ways.join(behind, ["depth", "id"]).groupBy("own", "me").agg(F.sum("behind").alias("steps"))
    found = walked.withColumn("me", F.element_at("way", -1)).join(ranks.withColumnRenamed("own", "depth"), ["depth", "me"], "left")
    return found.select("root", "node_token", "depth", (1 + F.coalesce("steps", F.lit(0))).alias("dfs_rank"))


def children_index(nodes: DataFrame) -> DataFrame:
    """Ordered children of each parent; the empty token is the top level."""
    return nodes.groupBy("parent_token").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "node_token"))), lambda x: x["node_token"]).alias("children"))


def children_index_legacy(rows: DataFrame, column: str = "body") -> DataFrame:
    """(parent, child, pos) from JSON text {parent: [child] | {child: index}}; children that aren't strings and indexes that aren't numbers are left out."""
    top = rows.select(F.explode(F.try_variant_get(F.try_parse_json(column), "$", "map<string,variant>")).alias("parent", "value")).withColumn("kind", F.schema_of_variant("value"))
    listed = top.where("kind like 'ARRAY%'").select("parent", F.posexplode(F.col("value").cast("array<variant>")).alias("at", "v"))
    listed = listed.where(F.schema_of_variant("v") == "STRING").select("parent", F.col("v").cast("string").alias("child"), F.col("at").cast("double").alias("at"))
    mapped = top.where("kind like 'OBJECT%'").select("parent", F.explode(F.col("value").cast("map<string,variant>")).alias("child", "v"))
    mapped = mapped.where(F.schema_of_variant("v").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)")).select("parent", "child", F.when(F.schema_of_variant("v") == "BOOLEAN", F.col("v").cast("string").cast("boolean").cast("double")).otherwise(F.col("v").cast("string").cast("double")).alias("at"))
    order = Window.partitionBy("parent").orderBy("at", "child")
    return listed.union(mapped).withColumn("pos", F.row_number().over(order) - 1).select("parent", "child", "pos")


def token_map(state: DataFrame) -> DataFrame:
    return state.where("coalesce(node_token, '') <> '' and coalesce(mirror_token, '') <> ''").select(F.col("node_token").alias("src"), F.col("mirror_token").alias("dst"))


def order_moves(desired: DataFrame, current: DataFrame, mapping: DataFrame, span: int = 100_000) -> DataFrame:
    """One row a wanted child that exists: parent, child, its rank among those, and whether it belongs to the common prefix of both orders.

    Ranks are counted within spans of places and then over the spans, so that a parent of very many children is many windows.
    """
    mapped = desired.join(mapping, desired.child == mapping.src).select("parent", "pos", F.col("dst").alias("child"))
    both = mapped.join(current.select("parent", F.col("pos").alias("now"), "child"), ["parent", "child"]).withColumn("_one", F.lit(1))
    ranked = summed_before(summed_before(both, ["parent"], ["pos", "child"], "_one", "_before", span), ["parent"], ["now", "child"], "_one", "_now_before", span)
    ranked = ranked.select("parent", "child", (F.col("_before") + 1).cast("int").alias("rank"), (F.col("_now_before") + 1).cast("int").alias("rank_now"))
    off = ranked.where("rank <> rank_now").groupBy("parent").agg(F.min(F.least("rank", "rank_now")).alias("first_off"))
    return ranked.join(off, "parent", "left").select("parent", "child", "rank", F.coalesce(F.col("rank") >= F.col("first_off"), F.lit(False)).alias("moves"))


def order_plan(desired: DataFrame, current: DataFrame, mapping: DataFrame, limit: int = 50) -> DataFrame:
    """One row a parent: children wanted, missing in the target, extra there, moves, and why it is skipped. A limit of 0 is off."""
    wanted = desired.join(mapping.withColumnRenamed("src", "child"), "child", "left").groupBy("parent").agg(F.count("dst").alias("n_desired"), F.count_if(F.col("dst").isNull()).alias("n_missing_map"))
    moves = order_moves(desired, current, mapping).groupBy("parent").agg(F.count("*").alias("n_common"), F.count_if("moves").alias("n_moves"))
    now = current.groupBy("parent").agg(F.count("*").alias("n_current"))
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    reason = F.when((F.lit(limit) > 0) & (F.col("n_common") > limit), "above_threshold").when(F.col("n_common") == 0, "no_overlap").otherwise("")
    return (
        wanted.join(moves, "parent", "left").join(now, "parent", "left").select("parent", "n_desired", "n_missing_map", n("n_common"), n("n_moves"), n("n_current"))
        .withColumns({"n_extra": F.col("n_current") - F.col("n_common"), "skip_reason": reason})
        .withColumn("n_moves", F.when(F.col("skip_reason") == "", F.col("n_moves")).otherwise(0)).withColumn("no_op", (F.col("skip_reason") == "") & (F.col("n_moves") == 0))
    )


def order_status(plan: DataFrame, results: DataFrame, audit_only: bool = False) -> DataFrame:
    """Status of a parent: skipped, in order, audited only, fixed, or all its moves failed. results: parent, n_ok, n_failed."""
    failed = (F.coalesce("n_ok", F.lit(0)) == 0) & (F.coalesce("n_failed", F.lit(0)) > 0)
    status = F.when(F.col("skip_reason") != "", "Skipped").when(F.col("no_op"), "OK").when(F.lit(audit_only), "Mismatch").when(failed, "Error").otherwise("Fixed")
    return plan.join(results, "parent", "left").select("parent", "n_moves", F.coalesce("n_ok", F.lit(0)).alias("n_ok"), status.alias("status"))


def order_run_summary(statuses: DataFrame) -> DataFrame:
    return statuses.agg(F.count("*").alias("n_parents"), *[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in ("OK", "Fixed", "Mismatch", "Skipped", "Error")], F.coalesce(F.sum("n_ok"), F.lit(0)).alias("n_moved"))


def order_child_updates(moves: DataFrame, records: DataFrame, plan: DataFrame) -> DataFrame:
    """Patches for moved children that have a record."""
    acted = plan.where("skip_reason = '' and not no_op").select("parent")
    return moves.where("moves").join(acted, "parent", "left_semi").join(records, "child").select("record_id", "parent", "child", F.lit("Fixed").alias("tree_order_status"))


def parent_slot_check(edges: DataFrame, warn: int = 9000, error: int = 11000) -> DataFrame:
    n = F.col("n")
    return edges.groupBy("parent").agg(F.count("*").alias("n")).withColumn("level", F.when(n >= error, "error").when(n >= warn, "warning").otherwise("ok"))
