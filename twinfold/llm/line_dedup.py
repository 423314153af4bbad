"""Line dedup by distinct-site spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, materialise, quoted, small_side, table

_BLANKS = " \t\n\x0b\f\r"


def _lines(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """One row for each line that has a word: the key of its document, its place, 128 bits of its trimmed text, its site."""
    parts = F.split(F.col(text), "\n", -1)
    return (
        docs.select(*_doc_key(doc_id, text), F.col(doc_id).alias("doc"), F.xxhash64(F.lit("site"), F.col(site)).alias("site"), F.posexplode(parts).alias("pos", "line"))
        .withColumn("line", F.btrim("line", F.lit(_BLANKS)))
        .where("line <> ''")
        .select("k1", "k2", "doc", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), F.col("line")).alias("h2"))
    )


def _doc_key(doc_id: str, text: str) -> list[Column]:
    return [F.xxhash64(F.col(doc_id), F.col(text)).alias("k1"), F.xxhash64(F.lit("second"), F.col(doc_id), F.col(text)).alias("k2")]


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int, band: float, hot_rows: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(the lines seen on two sites or more, the hashes among them that at least min_sites sites have, with the first place of each).

    Smallest and largest site of a hash tell without a sketch that a line has one site only. The others get a
    HyperLogLog sketch a hash; sketches merge in the aggregation, so a line in a third of all documents costs one
    partial sketch a task. An estimate within band of the threshold isn't trusted: such lines are counted exactly.
    Lines that stand hot_rows times or more are few (their number is checked), and are picked out where they are
    instead of being sent to the one task of their hash.
    """
    several = materialise(lines.groupBy("h1", "h2").agg(F.min("site").alias("least"), F.max("site").alias("most"), F.count("*").alias("times")).where("least < most").select("h1", "h2", "times"), "lines-of-sites")
    hot = small_side(materialise(several.where(F.col("times") >= hot_rows).select("h1", "h2"), "hot-lines"))
    common = lines.join(hot, ["h1", "h2"], "left_semi")
    others = lines.join(hot, ["h1", "h2"], "left_anti").join(several.where(F.col("times") < hot_rows).select("h1", "h2"), ["h1", "h2"])
    shared = materialise(common.unionByName(others), "shared-lines")
    spread = materialise(
        shared.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"), F.min(F.struct("doc", "pos", "k1", "k2")).alias("first")),
        "line-spread",
    )
    slack = max(1.0, band * min_sites)
    near = spread.where(F.abs(F.col("sites") - min_sites) <= slack)
    exact = shared.join(small_side(materialise(near.select("h1", "h2"), "near-lines")), ["h1", "h2"]).groupBy("h1", "h2").agg(F.count_distinct("site").alias("exact")).where(F.col("exact") >= min_sites)
    sure = spread.where(F.col("sites") > min_sites + slack).select("h1", "h2", "first")
    return shared, sure.unionByName(near.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def dedup_lines(docs: DataFrame, min_sites: int = 8, lg_k: int = 10, band: float = 0.15, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """docs with lines that min_sites sites or more have removed everywhere but at their first place (least doc_id, then line).

    Lines compare after trimming white space; lines without a word stay and never count. Adds n_lines and n_removed
    (with an underscore behind a name that docs has). Null text stays null with no lines, empty text is one line; a
    null site counts as one site; a null doc_id comes first. Rows alike in doc_id and text are treated alike, and hold
    the first place together. A document may end up with empty text, but none is dropped. Texts of any length are
    taken whole. An empty table gives an empty result. Other columns stay as they are, whatever their names.
    """
    shared, found = boilerplate(materialise(_lines(docs, doc_id, text, site), "hashed-lines"), min_sites, lg_k, band)
    here = F.struct("doc", "pos", "k1", "k2")
    gone = (
        shared.join(small_side(materialise(found, "boilerplate")), ["h1", "h2"])
        .where(~here.eqNullSafe(F.col("first")))
        .groupBy("k1", "k2")
        .agg(F.collect_set("pos").alias("gone"))
    )
    body, parts = F.col("row").getField(text), F.split(F.col("row").getField(text), "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "gone")
    rest = F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")
    n_lines = F.when(body.isNull(), 0).otherwise(F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) + 1)
    counts = beside(docs.columns, ["n_lines", "n_removed"])
    return (
        docs.select(*_doc_key(doc_id, text), F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"))
        .join(gone, ["k1", "k2"], "left")
        .select(
            *[F.when(F.col("gone").isNull(), body).otherwise(rest).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns],
            n_lines.cast("long").alias(counts[0]), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias(counts[1]),
        )
    )


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_kept"), F.md5(F.col("text").cast("binary")).alias("text_md5")
    )


OP5_SQL = r"""
WITH d AS (SELECT doc_id, text, source, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, coalesce('s' || source, 'n') AS site, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d),
k AS (SELECT doc_id, site, pos, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM l),
f AS (SELECT * FROM k WHERE line <> ''),
b AS (SELECT line, min({'doc_id': doc_id, 'pos': pos}) AS first FROM f GROUP BY line HAVING count(DISTINCT site) >= 8),
g AS (SELECT doc_id, list(DISTINCT pos) AS gone FROM f JOIN b USING (line) WHERE {'doc_id': doc_id, 'pos': pos} <> first GROUP BY doc_id),
o AS (SELECT d.doc_id, len(parts) AS n_lines, coalesce(len(gone), 0) AS n_removed,
        CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(1, len(parts) + 1), lambda i: NOT list_contains(gone, i)), lambda i: parts[i]), chr(10)) END AS text
      FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, CAST(length(text) AS BIGINT) AS n_chars_kept, md5(text) AS text_md5 FROM o
"""
