"""Write-side table operations: batches, upsert, insert-or-ignore."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sink_chunked_batches(rows: DataFrame, key: str, order: str, size: int = 500, span: int = 1_000_000) -> DataFrame:
    """rows with batch_id, batches of at most `size` within each value of key, in the order of a number.

    Rows are numbered within spans of that number, and the spans' counts (a row each) are summed in order, so that a
    key which holds a third of all rows is many windows.
    """
    spans = rows.withColumn("_span", F.floor(F.col(order) / span))
    before = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    counts = spans.groupBy(key, "_span").agg(F.count("*").alias("_n")).select(key, "_span", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(key, "_span").orderBy(order)) - 1
    return spans.withColumn("_own", own).join(counts, [key, "_span"]).withColumn("batch_id", F.floor((F.col("_before") + F.col("_own")) / size)).drop("_span", "_own", "_before")


def sink_upsert(table: DataFrame, delta: DataFrame, key: str, order: str) -> DataFrame:
    """Insert or replace by key; the last of the delta wins, then the table."""
    both = table.withColumn("_new", F.lit(0)).unionByName(delta.withColumn("_new", F.lit(1)))
    last = Window.partitionBy(key).orderBy(F.desc("_new"), F.desc(order))
    return both.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "_new")


def sink_insert_ignore(table: DataFrame, delta: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Insert what isn't there yet by key; what is there stays. Of several delta rows of a key the first by order counts."""
    first = Window.partitionBy(*keys).orderBy(order)
    new = delta.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return table.unionByName(new.join(table.select(*keys), keys, "left_anti").select(*table.columns))
