"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, quoted, table


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Share out the sum of all sizes among the sources.

    sizes: one row a source with __source (string, nulls allowed), __skey (the same, never null) and __source_size.
    Sources in code-point order (null last) get the weights in turn. No source gets more than cap times its own
    size; what is over goes to the others by weight until none is above. That fixed point is a water level: with
    sources in order of size/weight, the full ones are a prefix, so two running sums over this small table
    (a row a source) give it without iteration. Integer sums keep the result the same in every run.
    """
    step = lcm(*weights)
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    per_weight = F.element_at(F.array(*[F.lit(step // w) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    fill = Window.orderBy("__fill", "__skey")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    wide = lambda c: c.cast("decimal(19,0)")  # noqa: E731  products of two longs need 38 digits
    full = wide(cap * F.col("__source_size")) * wide(F.col("__all_w") - F.col("__w_before")) <= wide(F.col("__weight").cast("long")) * wide(F.col("__all") - F.col("__cap_before"))
    return (
        sizes.withColumn("__rank", F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last())) - 1)
        .withColumns({"__weight": turn, "__fill": F.col("__source_size") * per_weight})
        .withColumns({"__all": F.sum("__source_size").over(everything), "__all_w": F.sum("__weight").over(everything)})
        .withColumns({"__cap_before": F.coalesce(F.sum(cap * F.col("__source_size")).over(before), F.lit(0)), "__w_before": F.coalesce(F.sum("__weight").over(before), F.lit(0))})
        .withColumn("__open", F.max(F.when(full, 0).otherwise(1)).over(fill.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumns({
            "__left": F.col("__all") - F.sum(F.when(F.col("__open") == 0, cap * F.col("__source_size")).otherwise(0)).over(everything),
            "__left_w": F.sum(F.when(F.col("__open") == 1, F.col("__weight")).otherwise(0)).over(everything),
        })
        .withColumn("__target", F.when(F.col("__open") == 0, (cap * F.col("__source_size")).cast("double")).otherwise((F.col("__weight") * F.col("__left")).cast("double") / F.col("__left_w").cast("double")))
        .select("__skey", "__source_size", "__target")
    )


def planned(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, doc_id: str = "doc_id", text: str = "text", source: str = "source", size: str | None = None, offsets: int = 16) -> DataFrame:
    """row (a struct of all columns of docs), size, source_size, target and copies: how often systematic sampling emits each document.

    Every document of a source expects the same number of copies, target / source size. In an order by size class
    and hash, the prefix sum of the expected copies plus one offset a source crosses an integer boundary as many times
    as the document is emitted. Ordering by size first makes the words taken follow the target closely.

    The prefix sum has levels: counts by source and size class are summed in order, then those by hash digits within a
    class, then rows are numbered within such a bucket. So no task holds a source. Sizes and hashes are written once; size names a column of word counts where these are known already.

    The offset of a source is that of several seeded ones whose words come nearest to the target, found by summing for
    all of them in one aggregation: in a source of a few dozen documents one long text more or less tells.

    Null text: size 0. Null source: a source of its own. Null doc_id: hashed as an empty string. Repeated rows: each
    is a document. Ties of size and hash: by doc_id. Texts of any length are counted whole. Empty table: empty result.
    Extra columns stay in row, so their names can't clash.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(quoted(doc_id)).cast("string")).cast("binary"))
    bits = F.length(F.bin("__size"))
    sized = (
        docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), (F.col(quoted(size)) if size else word_count(quoted(text))).alias("__size"), F.col(quoted(source)).cast("string").alias("__source"), key.alias("__hash"), F.col(quoted(doc_id)).alias("__id"))
        .withColumn("__skey", F.when(F.col("__source").isNull(), "n").otherwise(F.concat(F.lit("s"), "__source")))
        .withColumns({"__class": F.when(F.col("__size") == 0, F.lit(0).cast("long")).otherwise(bits * 16 + F.expr("shiftright(shiftleft(__size, 5), length(bin(__size)))")), "__part": F.substring("__hash", 1, 2)})
    )
    keys = materialise(sized.select("__skey", "__class", "__part", "__size", "__hash", "__id", "__source"), "mix-keys")
    buckets = materialise(keys.groupBy("__skey", "__class", "__part").agg(F.count("*").alias("__n"), F.sum("__size").alias("__words"), F.first("__source").alias("__source")), "mix-buckets")
    # classes of a source are summed in order, then the digits of a class: no window holds more than a few hundred rows
    in_source = Window.partitionBy("__skey").orderBy("__class").rowsBetween(Window.unboundedPreceding, -1)
    in_class = Window.partitionBy("__skey", "__class").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    classes = buckets.groupBy("__skey", "__class").agg(F.sum("__n").alias("__c")).select("__skey", "__class", F.coalesce(F.sum("__c").over(in_source), F.lit(0)).alias("__classes_before"))
    placed = buckets.withColumn("__before", F.coalesce(F.sum("__n").over(in_class), F.lit(0))).join(classes, ["__skey", "__class"]).select("__skey", "__class", "__part", (F.col("__before") + F.col("__classes_before")).alias("__before"))
    targets = source_targets(buckets.groupBy("__skey").agg(F.first("__source").alias("__source"), F.sum("__words").alias("__source_size")), weights, cap)
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size").cast("double")).otherwise(F.lit(0.0))
    starts = F.array(*[F.conv(F.substring(F.md5(F.concat(F.lit(f"offset:{seed}:{k}:"), "__skey").cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) for k in range(offsets)])
    rows = Window.partitionBy("__skey", "__class", "__part").orderBy("__size", "__hash", F.col("__id").asc_nulls_last())
    at = (F.col("__before") + F.row_number().over(rows)).cast("double")
    crossed = lambda u: (F.floor(F.col("__at") * F.col("__rate") + u) - F.floor((F.col("__at") - 1) * F.col("__rate") + u)).cast("long")
    given = targets.withColumns({"__rate": rate, "__starts": starts})
    numbered = keys.join(placed, ["__skey", "__class", "__part"]).withColumn("__at", at).select("__skey", "__size", "__at").join(given, "__skey")
    sums = numbered.groupBy("__skey").agg(F.first("__target").alias("__target"), F.first("__starts").alias("__starts"), F.array(*[F.sum(F.col("__size") * crossed(F.col("__starts")[k])) for k in range(offsets)]).alias("__taken"))
    nearest = F.array_min(F.transform("__taken", lambda x, k: F.struct(F.abs(x.cast("double") - F.col("__target")).alias("off"), k.alias("k"))))
    chosen = materialise(sums.select("__skey", F.element_at("__starts", nearest["k"] + 1).alias("__start")), "mix-offsets")
    return (
        sized.join(placed.join(given.drop("__starts").join(chosen, "__skey"), "__skey"), ["__skey", "__class", "__part"])
        .withColumn("__at", at)
        .select("row", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), crossed(F.col("__start")).alias("copies"))
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed table: the rows of docs, each emitted as often as planned. Columns as in docs, whatever their names."""
    plan = planned(docs, **options).where("copies > 0")
    return plan.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = materialise(docs.select("doc_id", "source", word_count().alias("size")), "word-counts")
    return planned(counted, size="size").select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR))) AS h,
         CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS skey FROM documents),
c AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE length(bin(size)) * 16 + ((size << 5) >> length(bin(size))) END AS cls, substr(h, 1, 2) AS part FROM d),
s AS (SELECT skey, min(source) AS source, sum(size)::HUGEINT AS source_size FROM c GROUP BY skey),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS k FROM s),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * CASE k % 3 WHEN 0 THEN 2 WHEN 1 THEN 5 ELSE 10 END AS fill FROM r),
a AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS total_w,
        coalesce(sum(3 * source_size) OVER (ORDER BY fill, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
        coalesce(sum(weight) OVER (ORDER BY fill, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before FROM w),
o AS (SELECT *, max(CASE WHEN 3 * source_size * (total_w - w_before) <= weight * (total - cap_before) THEN 0 ELSE 1 END)
        OVER (ORDER BY fill, skey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open FROM a),
l AS (SELECT *, total - sum(CASE WHEN open = 0 THEN 3 * source_size ELSE 0 END) OVER () AS rest, sum(CASE WHEN open = 1 THEN weight ELSE 0 END) OVER () AS rest_w FROM o),
t AS (SELECT skey, CAST(source_size AS BIGINT) AS source_size,
        CASE WHEN open = 0 THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(weight * rest AS DOUBLE) / CAST(rest_w AS DOUBLE) END AS target,
        [CAST(('0x' || substr(md5('offset:7:' || k || ':' || skey), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0 FOR k IN range(16)] AS us FROM l),
n AS (SELECT c.*, t.source_size, t.target, t.us, CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0 END AS rate,
        CAST(row_number() OVER (PARTITION BY c.skey ORDER BY cls, part, size, h, doc_id) AS DOUBLE) AS place FROM c JOIN t USING (skey)),
m AS (SELECT skey, k, us[k + 1] AS u, abs(CAST(sum(size * CAST(floor(place * rate + us[k + 1]) - floor((place - 1) * rate + us[k + 1]) AS BIGINT)) AS DOUBLE) - any_value(target)) AS off
        FROM n, range(16) AS r(k) GROUP BY ALL),
g AS (SELECT skey, u FROM m QUALIFY row_number() OVER (PARTITION BY skey ORDER BY off, k) = 1),
p AS (SELECT n.*, CAST(floor(place * rate + u) - floor((place - 1) * rate + u) AS BIGINT) AS copies FROM n JOIN g USING (skey))
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM p
"""
