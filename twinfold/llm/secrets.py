"""Secret scan with corpus-wide ownership frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, small_side, table, text_of

#: Base kinds in their order: pattern, least length of the whole match (of group 2 for assign).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": (ASSIGN, 8), "access": ("AKIA[A-Z0-9]+", 16), "hex": ("[0-9a-f]{32,}", 32)}
#: Candidates beyond the base, by kind: whole private key blocks, signed tokens of three parts, credentials in addresses,
#: keys with a provider's prefix, and long runs of key characters that hold letters and digits. A match begins at the start
#: of a run of its characters, or goes on for a bounded stretch, so that no run is read anew from each of its places.
ADDED = {
    "block": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----",
    "signed": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "url": r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{0,30}+://[^\s/:@]++:[^\s/:@]++@",
    "prefixed": r"(?:gh[opsur]|glpat|xox[abprs]|[spr]k|npm|pypi|hf|AIza)[_-]?[A-Za-z0-9_-]{20,}",
    "owned": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}",
}


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, characters before the match since the last one, length, the match), in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    cut = F.zip_with(F.slice(between, 1, F.size(between) - 1), found, lambda gap, hit: F.struct(F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.length(hit).alias("len"), hit.alias("hit")))
    return F.when(F.rlike(text, F.lit(pattern)), cut).otherwise(F.array().cast("array<struct<kind:string,gap:int,len:int,hit:string>>"))


def scan(docs: DataFrame, max_owners: int = 2, max_repositories: int = 20, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row a document: doc_id and spans, its secret spans in order of start.

    A span has start, rank and kind, end, value hash, n_repositories and n_owners over the corpus, and live. A value is
    live if at most max_owners owners and max_repositories repositories have it; else it is a widely copied example.
    Base spans (assign, access, hex) are always there. Added ones (see ADDED) are there only if they are live, touch
    no base span, and start after the end of the added ones before them; of two with one start the kind listed first.

    The text is read once; what it yields is small and written to the shared folder. Values are aggregated by owner and
    repository before they are shuffled, and verdicts on values that stand often, few of which there can be, go back
    by broadcast, so that no task gets all spans of a value. Null and empty texts have no spans; a null owner or
    repository counts as one value each; repeated rows are each scanned, and are one repository. Texts of any length are
    taken whole. An empty table gives an empty result. Only doc_id and spans come back, so extra columns can't clash.
    """
    body = text_of(text)
    kinds = {**{k: p for k, (p, _) in BASE.items()}, **ADDED}
    rows = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
            F.xxhash64(F.lit("owner"), F.col(owner)).alias("owner"), F.xxhash64(F.lit("repository"), F.col(repository)).alias("repository"),
            F.concat(*[_matches(body, k, p) for k, p in kinds.items()]).alias("hits"),
        ),
        "secret-hits",
    )
    in_text = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(F.col("kind") == "assign", F.regexp_extract("hit", ASSIGN, 2)).otherwise(F.col("hit"))
    least = F.create_map(*[F.lit(x) for k, (_, n) in BASE.items() for x in (k, n)])
    is_base = F.col("kind").isin(*BASE)
    placed = (
        rows.select("row", "owner", "repository", F.posexplode("hits").alias("pos", "m")).select("row", "owner", "repository", "pos", "m.*")
        .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(in_text).cast("int"))
        .withColumns({"start": F.col("end") - F.col("len"), "value": value})
        .where(F.when(is_base, F.length("value") >= least[F.col("kind")]).when(F.col("kind") == "owned", F.col("hit").rlike("[0-9]") & F.col("hit").rlike("[A-Za-z]")).otherwise(True))
        .withColumns({"value": F.sha2(F.col("value").cast("binary"), 256), "rank": F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)]), F.col("kind"))})
    )
    spans = materialise(placed.select("row", "owner", "repository", "kind", "rank", "start", "end", "value"), "secret-spans")
    each = spans.groupBy("value", "owner", "repository").agg(F.count("*").alias("times"))
    spread = materialise(each.groupBy("value").agg(F.count_distinct("owner").alias("n_owners"), F.count_distinct("repository").alias("n_repositories"), F.sum("times").alias("times")), "secret-spread")
    often = spread.where("times >= 10000").drop("times")
    judged = spans.join(small_side(materialise(often, "secret-often")), "value").unionByName(spans.join(small_side(often.select("value")), "value", "left_anti").join(spread.where("times < 10000").drop("times"), "value"))
    judged = judged.withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)).where(is_base | F.col("live"))
    by_row = _chosen(judged).groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    none = F.array().cast(by_row.schema["spans"].dataType)
    return rows.select("row", "doc_id").join(by_row, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def _chosen(judged: DataFrame) -> DataFrame:
    """(row, span): base spans, and of the live added ones those that touch none and, from the left, one of those that overlap.

    Groups of overlapping candidates are found by windows over a text's spans, and only inside a group, mostly of one or
    two, are they taken one after the other.
    """
    is_base = F.col("kind").isin(*BASE)
    order = Window.partitionBy("row").orderBy("start", "rank")
    # what comes after is what came before in the opposite order; a frame that ends with the partition is computed anew for each row
    before, after = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (order, Window.partitionBy("row").orderBy(F.desc("start"), F.desc("rank"))))
    clear = (F.coalesce(F.max(F.when(is_base, F.col("end"))).over(before), F.lit(0)) <= F.col("start")) & (F.coalesce(F.min(F.when(is_base, F.col("start"))).over(after), F.lit(2**31 - 1)) >= F.col("end"))
    spans = judged.withColumns({"span": F.struct("start", "rank", "kind", "end", "value", "n_repositories", "n_owners", "live"), "clear": clear})
    added = spans.where(~is_base & F.col("clear")).withColumn("opens", (F.coalesce(F.max("end").over(before), F.lit(0)) <= F.col("start")).cast("int"))
    groups = added.withColumn("group", F.sum("opens").over(order)).groupBy("row", "group").agg(F.array_sort(F.collect_list("span")).alias("all"))
    none = F.array().cast(groups.schema["all"].dataType)
    one_by_one = F.aggregate("all", none, lambda kept, x: F.when(F.coalesce(F.try_element_at(kept, F.lit(-1))["end"], F.lit(0)) <= x["start"], F.concat(kept, F.array(x))).otherwise(kept))
    chosen = groups.select("row", F.explode(F.when(F.size("all") == 1, F.col("all")).otherwise(one_by_one)).alias("span"))
    return spans.where(is_base).select("row", "span").unionByName(chosen)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    n = lambda test: F.size(F.filter(spans, test)).cast("long")
    kind = lambda k: n(lambda s: s["kind"] == k)
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", kind("assign").alias("n_assign"), kind("access").alias("n_access"), kind("hex").alias("n_hex"),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(spans).alias("spans"),
        n(lambda s: s["live"]).alias("n_live"), n(lambda s: ~s["live"]).alias("n_copied"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["n_owners"].cast("string"), s["n_repositories"].cast("string"))), ",").alias("spread"),
    )
