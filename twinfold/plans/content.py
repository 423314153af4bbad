"""Queries on blocks, links and translation data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import blocks as B
from ..operators import links as L
from ..operators import translate as T
from .base import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
add = R.add
_SB, _TB = "source_blocks", "source_blocks target_blocks"

# --- blocks

_HASH = "md5(CAST(block_type AS VARCHAR) || chr(1) || CASE WHEN block_type = 27 THEN '' ELSE CASE block_type WHEN 2 THEN 'text' ELSE 'heading1' END || chr(2) || content || chr(0) || url || chr(3) END)"
_DIFF = f"""s AS (SELECT doc_id, idx, block_id AS src_id, {_HASH} AS src_hash, block_type AS src_type FROM source_blocks), t AS (SELECT doc_id, idx, block_id AS dst_id, {_HASH} AS dst_hash FROM target_blocks),
diff AS (SELECT doc_id, idx, src_id, src_hash, src_type, dst_id, dst_hash, CASE WHEN dst_hash IS NULL THEN 'append' WHEN src_hash IS NULL THEN 'delete' WHEN src_hash = dst_hash THEN 'keep' ELSE 'replace' END AS op FROM s FULL JOIN t USING (doc_id, idx)),
counts AS (SELECT doc_id, count(*) FILTER (op = 'replace') AS n_replace, count(*) FILTER (op = 'append') AS n_append, count(*) FILTER (op = 'delete') AS n_delete, count(*) FILTER (op = 'keep') AS n_keep, count(*) FILTER (op <> 'keep') AS total_changes, count(*) FILTER (op <> 'keep') = 0 AS is_no_op, count(*) FILTER (op = 'keep') AS saved_calls FROM diff GROUP BY doc_id)"""
_diff = lambda t: B.block_diff(t.source_blocks, t.target_blocks)
_res = lambda t: t.documents.where("doc_id % 4 <> 0").select("doc_id", F.when(F.col("doc_id") % 4 == 1, 0).otherwise(2).alias("n_ok"), F.when(F.col("doc_id") % 4 == 3, 0).otherwise(1).alias("n_failed"))
_STAT = _DIFF + ", st AS (SELECT doc_id, total_changes, CASE WHEN is_no_op THEN 'NoChange' WHEN doc_id % 4 IN (0, 3) THEN 'Synced' WHEN doc_id % 4 = 2 THEN 'PartialFail' ELSE 'Failed' END AS status FROM counts)"
_status = lambda t: B.sync_status(B.sync_plan_counts(_diff(t)), _res(t))

add(
    "block_text_field",
    lambda t: t.source_blocks.select("doc_id", "idx", B.block_text_field(F.col("block_type")).alias("field")),
    _SB,
    """
    SELECT doc_id, idx, CASE block_type WHEN 2 THEN 'text' WHEN 3 THEN 'heading1' END AS field
    FROM source_blocks""",
)
_element = lambda kind, content, title: F.struct(F.lit(kind).alias("kind"), content.alias("content"), F.lit("").alias("url"), F.lit("").alias("token"), title.alias("title"), F.create_map(F.lit("bold"), F.lit("true"), F.lit("odd"), F.lit("1")).alias("style"))
_elements = lambda: F.array(_element("text_run", F.col("content"), F.lit("")), _element("equation", F.lit("x+y"), F.lit("")), _element("mention_user", F.lit("u"), F.lit("")), _element("mention_doc", F.lit(""), F.col("block_id")))
add(
    "block_text",
    lambda t: t.source_blocks.select("doc_id", "idx", B.block_text(_elements()).alias("text"), B.block_text(_elements(), plain=True).alias("plain")),
    _SB,
    "SELECT doc_id, idx, content || block_id AS text, content || 'x+y' || block_id AS plain FROM source_blocks",
)


def _mixed_blocks(t):
    """Blocks of several elements: a run with a link, an equation, a user, a mentioned document."""
    element = lambda kind, content, url, token, title: F.struct(F.lit(kind).alias("kind"), content.alias("content"), url.alias("url"), token.alias("token"), title.alias("title"), F.create_map(F.lit("bold"), F.lit("true")).alias("style"))
    none = F.lit("")
    run = element("text_run", F.col("content"), F.col("url"), none, none)
    doc = element("mention_doc", none, F.col("url"), F.concat(F.lit("k"), "idx"), F.col("block_id"))
    full = F.array(run, element("equation", F.lit("x+y"), none, none, none), element("mention_user", F.lit("u"), F.lit("https://source.example/wiki/T2"), none, none), doc)
    return t.source_blocks.withColumn("elements", F.when(F.col("idx") % 3 == 0, full).when(F.col("idx") % 3 == 1, F.array(run, run)).otherwise(F.filter(full, lambda _: F.lit(False))))


_RUN, _NUL = "content || chr(0) || url", "|| chr(0) ||"
_MIXED_HASH = f"""md5(CAST(block_type AS VARCHAR) || chr(1) || CASE WHEN block_type = 27 THEN '' ELSE CASE block_type WHEN 2 THEN 'text' ELSE 'heading1' END || chr(2) ||
  CASE idx % 3 WHEN 0 THEN {_RUN} {_NUL} 'k' || idx {_NUL} url {_NUL} block_id WHEN 1 THEN {_RUN} {_NUL} {_RUN} ELSE '' END || chr(3) END)"""
add("block_hash", lambda t: B.hashed(_mixed_blocks(t)), _SB, f"SELECT doc_id, idx, block_id, block_type, {_MIXED_HASH} AS hash FROM source_blocks")
add("block_diff", _diff, _TB, f"WITH {_DIFF} SELECT * FROM diff")
add("sync_plan_counts", lambda t: B.sync_plan_counts(_diff(t)), _TB, f"WITH {_DIFF} SELECT * FROM counts")
add(
    "sync_patch_rows",
    lambda t: B.sync_patch_rows(_diff(t), t.source_blocks),
    _TB,
    f"""
    WITH {_DIFF} SELECT d.doc_id, d.idx, d.dst_id, b.content, b.url
    FROM diff d JOIN source_blocks b USING (doc_id, idx)
    WHERE d.op = 'replace' AND d.src_type IN (2, 3)""",
)
add(
    "sync_create_rows",
    lambda t: B.sync_create_rows(_diff(t), t.source_blocks),
    _TB,
    f"""
    WITH {_DIFF} SELECT d.doc_id, d.idx, b.block_type, b.content, b.url
    FROM diff d JOIN source_blocks b USING (doc_id, idx)
    WHERE d.op = 'append'""",
)
add("sync_status", _status, _TB, f"WITH {_STAT} SELECT * FROM st")
add(
    "mirror_outcome",
    lambda t: B.mirror_outcome(_status(t).join(t.state.select(F.col("stt").cast("long").alias("doc_id"), "title", "title_translated"), "doc_id")),
    f"{_TB} state",
    f"""
    WITH {_STAT} SELECT st.doc_id, st.total_changes, st.status, s.title, s.title_translated, CASE WHEN st.status IN ('Synced', 'NoChange', 'PartialFail') THEN 'OK' ELSE 'FAIL' END AS outcome, CASE WHEN s.title_translated = '' THEN s.title ELSE s.title_translated END AS new_title
    FROM st JOIN state s ON s.stt = st.doc_id""",
)
_typed = lambda t: t.source_blocks.select("doc_id", "idx", F.element_at(F.array(*[F.lit(x) for x in (2, 27, 23, 31, 24, 43, 18, 7, 99, 34)]), (F.col("idx") % 10 + 1).cast("int")).alias("block_type"), F.when(F.col("idx") % 20 < 10, F.concat(F.lit("m"), F.length("content") % 50)).otherwise("").alias("media_token"), "content", F.when(F.col("idx") % 3 == 0, 4).alias("rows"), F.lit(None).cast("int").alias("cols"), F.lit(None).cast("string").alias("file_name"))
_TYPED = """ty AS (SELECT doc_id, idx, content, [2, 27, 23, 31, 24, 43, 18, 7, 99, 34][idx % 10 + 1] AS block_type, CASE WHEN idx % 20 < 10 THEN 'm' || (length(content) % 50) ELSE '' END AS media_token, CASE WHEN idx % 3 = 0 THEN 4 END AS rows FROM source_blocks),
di AS (SELECT *, CASE block_type WHEN 18 THEN 'skipped' WHEN 27 THEN 'image' WHEN 43 THEN 'image' WHEN 23 THEN 'file' WHEN 31 THEN 'table' WHEN 24 THEN 'grid' WHEN 99 THEN 'generic' ELSE 'text' END AS action FROM ty),
dd AS (SELECT *, action = 'skipped' OR (action IN ('image', 'file') AND media_token = '') AS is_skipped, action <> 'skipped' AS is_recreated FROM di)"""
add(
    "clone_dispatch",
    lambda t: B.clone_dispatch(_typed(t)).select("doc_id", "idx", "action", "is_skipped", "is_recreated"),
    _SB,
    f"WITH {_TYPED} SELECT doc_id, idx, action, is_skipped, is_recreated FROM dd",
)
add(
    "clone_stats",
    lambda t: B.clone_stats(B.clone_dispatch(_typed(t)), t.documents.where("doc_id % 3 = 0").select("doc_id", (F.col("doc_id") % 12).alias("n_failed"))),
    _SB,
    f"""
    WITH {_TYPED}, a AS (SELECT doc_id, count(*) AS n_total, count(*) FILTER (is_skipped) AS n_skipped, count(*) FILTER (is_recreated) AS n_recreated, CASE WHEN doc_id % 3 = 0 THEN doc_id % 12 ELSE 0 END AS n_failed
    FROM dd
    GROUP BY doc_id) SELECT *, CASE WHEN n_failed > n_recreated THEN 'FAIL' ELSE 'OK' END AS outcome
    FROM a""",
)
add(
    "clone_body",
    lambda t: B.clone_body(B.clone_dispatch(_typed(t))),
    _SB,
    f"""
    WITH {_TYPED} SELECT doc_id, idx, block_type, CASE WHEN action = 'text' THEN content END AS content, CASE WHEN action = 'table' THEN coalesce(rows, 1) END AS rows, CASE action WHEN 'table' THEN 1 WHEN 'grid' THEN 2 END AS cols, CASE WHEN action = 'file' THEN 'file' END AS file_name
    FROM dd
    WHERE action <> 'skipped'""",
)
add(
    "media_tokens",
    lambda t: B.media_tokens(_typed(t)),
    _SB,
    f"""
    WITH {_TYPED} SELECT doc_id, idx, media_token, CASE block_type WHEN 27 THEN 'image' WHEN 23 THEN 'file' ELSE 'board' END AS kind
    FROM dd
    WHERE block_type IN (27, 23, 43) AND media_token <> ''""",
)
_known = lambda t: t.documents.select((F.col("doc_id") % 25).alias("k")).distinct().select(F.concat(F.lit("m"), "k").alias("media_token"), F.concat(F.lit("z"), "k").alias("target"))
_MEDIA = f"WITH {_TYPED}, me AS (SELECT doc_id, idx, media_token, CASE block_type WHEN 27 THEN 'image' WHEN 23 THEN 'file' ELSE 'board' END AS kind FROM dd WHERE block_type IN (27, 23, 43) AND media_token <> ''), ca AS (SELECT DISTINCT 'm' || (doc_id % 25) AS media_token, 'z' || (doc_id % 25) AS target FROM documents)"
add(
    "media_cache_hits",
    lambda t: B.media_cache_split(B.media_tokens(_typed(t)), _known(t))[0],
    _SB,
    f"{_MEDIA} SELECT media_token, doc_id, idx, kind, target FROM me JOIN ca USING (media_token)",
)
add(
    "media_cache_split",
    lambda t: B.media_cache_split(B.media_tokens(_typed(t)), _known(t))[1],
    _SB,
    f"{_MEDIA} SELECT DISTINCT media_token FROM me WHERE media_token NOT IN (SELECT media_token FROM ca)",
)
add(
    "style_filter",
    lambda t: t.source_blocks.select("doc_id", "idx", F.array_join(F.array_sort(F.map_keys(B.style_filter(F.create_map(F.lit("bold"), F.col("content"), F.lit("odd"), F.col("url"), F.lit("link"), F.col("url"))))), ",").alias("styles")),
    _SB,
    "SELECT doc_id, idx, 'bold,link' AS styles FROM source_blocks",
)

# --- links

_URLS = f"{_SB} token_map"
_REWRITE = """rw AS (SELECT l.doc_id, l.idx, l.url, CASE WHEN m.dst IS NULL THEN l.url ELSE 'https://target.example/wiki/' || m.dst || regexp_extract(l.url, 'https://source[.]example/wiki/([A-Za-z0-9]+)(.*)$', 2) END AS new_url, m.dst IS NOT NULL AS replaced
  FROM (SELECT doc_id, idx, url FROM source_blocks WHERE url <> '') l LEFT JOIN token_map m ON m.src = nullif(regexp_extract(l.url, 'https://source[.]example/wiki/([A-Za-z0-9]+)(.*)$', 1), ''))"""
_links = lambda t: L.extract_links(t.source_blocks)
_rewritten = lambda t: L.url_rewrite(_links(t), t.token_map)
add("extract_links", _links, _SB, "SELECT doc_id, idx, url FROM source_blocks WHERE url <> ''")
add("url_rewrite", _rewritten, _URLS, f"WITH {_REWRITE} SELECT * FROM rw")
add("url_rewrite_escaped", lambda t: L.url_rewrite(_links(t).withColumn("url", F.concat(F.replace("url", F.lit("/wiki/"), F.lit("%2Fwiki%2F")), F.when(F.col("idx") % 2 == 0, "&a=b+c%zz").otherwise("&a=%C3%A9"))), t.token_map, with_escapes=True).select("doc_id", "idx", "new_url", "replaced"), _URLS, r"""WITH u AS (SELECT doc_id, idx, replace(url, '/wiki/', '%2Fwiki%2F') || CASE WHEN idx % 2 = 0 THEN '&a=b+c%zz' ELSE '&a=%C3%A9' END AS url, url || CASE WHEN idx % 2 = 0 THEN '&a=b+c%zz' ELSE '&a=é' END AS plain FROM source_blocks WHERE url <> ''),
e AS (SELECT *, nullif(regexp_extract(plain, 'https://source[.]example/wiki/([A-Za-z0-9]+)(.*)$', 1), '') AS src, regexp_extract(plain, 'https://source[.]example/wiki/([A-Za-z0-9]+)(.*)$', 2) AS rest FROM u)
SELECT doc_id, idx, CASE WHEN m.dst IS NULL THEN url ELSE 'https://target.example/wiki/' || m.dst || rest END AS new_url, m.dst IS NOT NULL AS replaced FROM e LEFT JOIN token_map m USING (src)""")


def _fixed(t):
    """Each element as one text, so that whatever is lost or moved shows."""
    whole = lambda e: F.concat_ws("|", e["kind"], e["content"], e["url"], e["token"], e["title"], F.element_at(e["style"], "bold"))
    fixed = L.fix_elements(_mixed_blocks(t).select("doc_id", "idx", "elements"), t.token_map)
    return fixed.select("doc_id", "idx", F.array_join(F.transform("elements", whole), ";").alias("elements"), "n_replaced")


add("fix_elements", _fixed, _URLS, f"""WITH {_REWRITE},
f AS (SELECT b.doc_id, b.idx, b.content, b.block_id, coalesce(rw.new_url, b.url) AS u, coalesce(rw.replaced, false) AS r FROM source_blocks b LEFT JOIN rw ON rw.doc_id = b.doc_id AND rw.idx = b.idx),
e AS (SELECT *, 'text_run|' || content || '|' || u || '|||true' AS run FROM f)
SELECT doc_id, idx, CASE idx % 3 WHEN 0 THEN run || ';equation|x+y||||true;mention_user|u|https://source.example/wiki/T2|||true;mention_doc||' || u || '|k' || idx || '|' || block_id || '|true' WHEN 1 THEN run || ';' || run ELSE '' END AS elements,
  CAST(CASE WHEN r AND idx % 3 <> 2 THEN 2 ELSE 0 END AS BIGINT) AS n_replaced FROM e""")
add(
    "backlink_stats",
    lambda t: L.backlink_stats(_rewritten(t)),
    _URLS,
    f"""
    WITH {_REWRITE} SELECT doc_id, count(*) AS n_links, count(*) FILTER (replaced) AS n_replaced, CASE WHEN count(*) FILTER (replaced) = 0 THEN 'NoChange' ELSE 'Fixed' END AS status
    FROM rw
    GROUP BY doc_id""",
)
add(
    "unmapped_links",
    lambda t: L.unmapped_links(_links(t), t.token_map).select("doc_id", "idx", "src"),
    _URLS,
    """
    SELECT doc_id, idx, src
    FROM (SELECT doc_id, idx, regexp_extract(url, 'https://source[.]example/wiki/([A-Za-z0-9]+)', 1) AS src
    FROM source_blocks)
    WHERE src <> '' AND src NOT IN (SELECT src
    FROM token_map)""",
)
add(
    "parse_source_url",
    lambda t: L.parse_source_url(_links(t)).select("doc_id", "idx", "domain", "token", "valid"),
    _SB,
    r"""
    SELECT doc_id, idx, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS domain, regexp_extract(url, '/wiki/([A-Za-z0-9]+)', 1) AS token, url LIKE 'https://source.example/%' AS valid
    FROM source_blocks
    WHERE url <> ''""",
)

# --- text measures and translation data (the pattern takes the place of the script ranges, which these tables don't hold)

_P = "[àâçéèêëîïôûùüäößñáíóú]"
_P_SQL = f"len(regexp_extract_all({{0}}, '{_P}'))"
_WORDS = "the of and to in le la der die".split()
_LIST = ", ".join(f"'{w}'" for w in _WORDS)
_UNACC = f"len(list_filter(regexp_split_to_array(lower({{0}}), '[^\\p{{{{L}}}}\\p{{{{N}}}}_]+'), lambda w: w IN ({_LIST})))"
_unacc = lambda c: _UNACC.format(c)
_cnt = lambda c: _P_SQL.format(c)
add(
    "cjk_count",
    lambda t: t.items.select("item_id", X.cjk_count(F.col("text"), _P).cast("long").alias("n"), X.has_cjk(F.col("text"), _P).alias("has")),
    "items",
    f"SELECT item_id, CAST({_cnt('text')} AS BIGINT) AS n, {_cnt('text')} > 0 AS has FROM items",
)


def _bare(t):
    """Every line with published words behind it: all of them, two, or three in odd case and beside punctuation."""
    words = F.when(F.col("idx") % 4 == 0, " ".join(X.UNACCENTED)).when(F.col("idx") % 4 == 1, "khong duoc").when(F.col("idx") % 4 == 2, "(Thoi) GIAN, xa; xam").otherwise("")
    return t.items.withColumn("text", F.concat_ws(" ", "text", words))


_BARE = f"SELECT *, text || ' ' || CASE idx % 4 WHEN 0 THEN '{' '.join(X.UNACCENTED)}' WHEN 1 THEN 'khong duoc' WHEN 2 THEN '(Thoi) GIAN, xa; xam' ELSE '' END AS t FROM items"
_BARE_N = _unacc("t").replace(f"({_LIST})", "(" + ", ".join(f"'{w}'" for w in X.UNACCENTED) + ")")
add(
    "unaccented_count",
    lambda t: _bare(t).select("item_id", X.unaccented_count(F.col("text")).cast("long").alias("n")),
    "items",
    f"""
    WITH b AS ({_BARE}) SELECT item_id, CAST(CASE WHEN {_BARE_N} >= 3 THEN {_BARE_N} ELSE 0 END AS BIGINT) AS n
    FROM b""",
)
add(
    "has_diacritics",
    lambda t: t.items.select("item_id", X.has_diacritics(F.col("text"), _P).alias("has")),
    "items",
    f"SELECT item_id, {_cnt('lower(text)')} > 0 AS has FROM items",
)
_WRAPS = [("```\n\"", "\"\n```"), ("```Vietnamese \n", "\n``` "), ("```python\n", "\n```"), ("Bản  dịch: ", ""), ("dịch：", ""), ("Translation :", ""), ("Đây là bản dịch: Output:", ""), ("sau đây là:", ""), ("Kết quả： ", ""), ("'```vi\n", "\n```'"), ("Translated: ", "")]
_HEADS = ["", "", "```python\n", "", "", "", "", "", "", "", "Translated: "]


def _wrapped(t):
    at = (F.col("idx") % len(_WRAPS) + 1).cast("int")
    pick = lambda i: F.element_at(F.array(*[F.lit(w[i]) for w in _WRAPS]), at)
    return t.items.select("item_id", X.clean_artifacts(F.concat(pick(0), "text", pick(1))).alias("text"))


_quoted = lambda texts: "[" + ", ".join("'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for x in texts) + "]"
add("clean_artifacts", _wrapped, "items", rf"""
WITH c AS (SELECT item_id, idx % {len(_WRAPS)} AS k, regexp_replace(text, '[\s"'']+$', '') AS body FROM items)
SELECT item_id, nfc_normalize(trim({_quoted(_HEADS)}[k + 1] || CASE WHEN k IN (2, 10) THEN body WHEN k IN (0, 1, 9) THEN regexp_replace(body, '^[\s"'']+', '') ELSE regexp_replace(body, '^\s+', '') END)) AS text FROM c""")
_QUAL = f"""q0 AS (SELECT *, input IS NOT NULL AND regexp_matches(input, '\\S') AS has_in, coalesce(regexp_matches(output, '\\S'), false) AS has_out, {_cnt('input')} AS cin, {_cnt('output')} AS cjk, CASE WHEN {_unacc('output')} >= 3 THEN {_unacc('output')} ELSE 0 END AS bare, length(input) AS li, length(output) AS lo FROM pairs),
q1 AS (SELECT *, lo / greatest(li, 1) AS ratio, CASE WHEN NOT has_out AND has_in THEN true WHEN cin = 0 THEN false ELSE cjk / cin > 0.3 END AS same FROM q0),
q AS (SELECT *, NOT (NOT has_out AND has_in OR cjk > 0 OR same) AS passed, concat_ws(',', CASE WHEN NOT has_out AND has_in THEN 'empty_output' END, CASE WHEN cjk > 0 THEN 'cjk_leak' END, CASE WHEN bare > 0 THEN 'unaccented' END, CASE WHEN same THEN 'looks_untranslated' END, CASE WHEN li >= 20 AND lo > 0 AND (ratio < 0.2 OR ratio > 5) THEN 'suspicious_ratio' END) AS issues FROM q1)"""
add(
    "looks_untranslated",
    lambda t: t.pairs.select("conv_id", "turn", X.looks_untranslated(F.col("input"), F.col("output"), _P).alias("same")),
    "pairs",
    f"WITH {_QUAL} SELECT conv_id, turn, same FROM q",
)
_quality = lambda t: t.pairs.select("conv_id", "turn", X.assess_quality(F.col("input"), F.col("output"), _P, _WORDS).alias("q"))
add(
    "assess_quality",
    lambda t: _quality(t).select("conv_id", "turn", "q.passed", F.array_join("q.issues", ",").alias("issues"), F.col("q.cjk_count").cast("long").alias("cjk_count"), F.col("q.unaccented").cast("long").alias("unaccented"), F.col("q.ratio").alias("ratio"), "q.detail"),
    "pairs",
    f"""
    WITH {_QUAL}, h AS (SELECT *, length(coalesce(input, '')) AS g, length(coalesce(output, '')) AS o, 100 * length(coalesce(output, '')) // greatest(length(coalesce(input, '')), 1) AS w FROM q),
    k AS (SELECT *, w + CASE WHEN 2 * (100 * o - w * g) > g OR 2 * (100 * o - w * g) = g AND w % 2 = 1 THEN 1 ELSE 0 END AS p FROM h)
    SELECT conv_id, turn, passed, issues, CAST(cjk AS BIGINT) AS cjk_count, CAST(bare AS BIGINT) AS unaccented, ratio,
      concat_ws(' ', CASE WHEN cjk > 0 THEN 'cjk=' || cjk END, CASE WHEN bare > 0 THEN 'unacc=' || bare END, CASE WHEN g > 0 THEN 'ratio=' || (p // 100) || '.' || lpad(CAST(p % 100 AS VARCHAR), 2, '0') END) AS detail
    FROM k""",
)
add(
    "quality_summary",
    lambda t: T.quality_summary(t.pairs, "[éàü]"),
    "pairs",
    f"""
    WITH {_QUAL.replace(_P, '[éàü]').replace('lambda w: w IN (' + _LIST + ')', 'lambda w: w IN (' + ', '.join(repr(w) for w in X.UNACCENTED) + ')')} SELECT issue, count(*) AS n
    FROM (SELECT unnest(list_filter(string_split(issues, ','), lambda x: x <> '')) AS issue
    FROM q
    UNION ALL SELECT CASE WHEN passed THEN 'passed' ELSE 'failed' END
    FROM q)
    GROUP BY issue""",
)
_GLOSS = "g AS (SELECT src, dst AS glossary_text FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY section_order, entry_order) AS n FROM glossary) WHERE n = 1)"
add(
    "glossary_lookup",
    lambda t: T.glossary_lookup(t.items, t.glossary).select("item_id", "glossary_text"),
    "items glossary",
    f"WITH {_GLOSS} SELECT item_id, glossary_text FROM items LEFT JOIN g ON g.src = trim(text)",
)
add(
    "glossary_render",
    lambda t: T.glossary_render(t.glossary, 5),
    "glossary",
    """
    SELECT section, '- ' || section || ': ' || string_agg(src || '→' || dst, ' | ' ORDER BY entry_order) AS line
    FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY entry_order) AS n
    FROM glossary)
    WHERE n <= 5
    GROUP BY section""",
)
add(
    "cache_key",
    lambda t: t.items.select("item_id", X.cache_key(F.col("text"), "vi").alias("key")),
    "items",
    "SELECT item_id, sha256('vi' || chr(0) || 'content' || chr(0) || text) AS key FROM items",
)
add(
    "translatable_blocks",
    lambda t: T.translatable_blocks(t.source_blocks, _P).select("doc_id", "idx", "content"),
    _SB,
    f"""
    SELECT doc_id, idx, content
    FROM source_blocks
    WHERE block_type IN (2, 3) AND trim(content) <> '' AND {_cnt('content')} > 0""",
)
add("skipped_blocks", lambda t: T.skipped_blocks(t.source_blocks.withColumn("block_id", F.when(F.col("idx") % 11 == 7, F.lit(None)).otherwise(F.col("block_id"))), _P), _SB, f"""
SELECT doc_id, count(*) AS n_blocks, count(*) FILTER (r = 0) AS n_not_text, count(*) FILTER (r = 1) AS n_no_id, count(*) FILTER (r = 2) AS n_blank, count(*) FILTER (r = 3) AS n_nothing_to_translate
FROM (SELECT doc_id, CASE WHEN block_type NOT IN (2, 3) THEN 0 WHEN idx % 11 = 7 THEN 1 WHEN trim(content) = '' THEN 2 WHEN {_cnt('content')} = 0 THEN 3 END AS r FROM source_blocks) x GROUP BY doc_id""")
_KEY = "sha256('en' || chr(0) || 'content' || chr(0) || {0})"
_cache = lambda t: t.items.where("idx % 3 = 0").select(X.cache_key(F.col("text")).alias("key")).distinct().withColumn("translated", F.concat(F.lit("T:"), F.substring("key", 1, 8)))
_ROUTE = f"""{_GLOSS}, ca AS (SELECT DISTINCT {_KEY.format('text')} AS key, 'T:' || substring({_KEY.format('text')}, 1, 8) AS translated FROM items WHERE idx % 3 = 0),
r0 AS (SELECT i.*, {_KEY.format('i.text')} AS key, glossary_text FROM items i LEFT JOIN g ON g.src = CASE WHEN length(trim(i.text)) <= 20 THEN trim(i.text) END),
ro AS (SELECT r0.doc_id, r0.idx, item_id, text, r0.key, translated, CASE WHEN trim(text) = '' OR {_cnt('text')} = 0 THEN 'skip' WHEN glossary_text IS NOT NULL THEN 'glossary' WHEN translated IS NOT NULL THEN 'cache' ELSE 'pending' END AS route, glossary_text FROM r0 LEFT JOIN ca USING (key))"""
_routed = lambda t: T.route_items(t.items, t.glossary, _cache(t), _P)
add(
    "route_items",
    lambda t: _routed(t).select("item_id", "key", "route", "out"),
    "items glossary",
    f"""
    WITH {_ROUTE} SELECT item_id, key, route, CASE route WHEN 'skip' THEN text WHEN 'glossary' THEN glossary_text WHEN 'cache' THEN translated END AS out
    FROM ro""",
)
add(
    "pending_once",
    lambda t: T.pending_once(_routed(t)),
    "items glossary",
    f"""
    WITH {_ROUTE} SELECT key, min(text) AS text, count(*) AS n_uses
    FROM ro
    WHERE route = 'pending'
    GROUP BY key""",
)
_PACK = """RECURSIVE WITH seq AS (SELECT doc_id, CAST(idx AS BIGINT) AS idx, text, length(text) AS len, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS k FROM items),
pk AS (SELECT doc_id, idx, k, len AS chars, 1 AS n, CAST(0 AS BIGINT) AS batch_no FROM seq WHERE k = 1
  UNION ALL SELECT s.doc_id, s.idx, s.k, CASE WHEN p.chars + s.len > 1000 OR p.n >= 5 THEN s.len ELSE p.chars + s.len END, CASE WHEN p.chars + s.len > 1000 OR p.n >= 5 THEN 1 ELSE p.n + 1 END, CASE WHEN p.chars + s.len > 1000 OR p.n >= 5 THEN p.batch_no + 1 ELSE p.batch_no END FROM pk p JOIN seq s ON s.doc_id = p.doc_id AND s.k = p.k + 1)"""
_packed = lambda t: T.pack_batches(t.items, 1000, 5)
_with_text = lambda t: _packed(t).join(t.items.select("doc_id", F.col("idx").cast("long").alias("idx"), "text"), ["doc_id", "idx"])
add("pack_batches", _packed, "items", f"{_PACK} SELECT doc_id, idx, batch_no FROM pk")
add(
    "batch_message",
    lambda t: T.batch_message(_with_text(t)),
    "items",
    f"""
    {_PACK}, nu AS (SELECT pk.doc_id, batch_no, text, row_number() OVER (PARTITION BY pk.doc_id, batch_no ORDER BY pk.idx) - 1 AS i
    FROM pk JOIN seq USING (doc_id, idx)) SELECT doc_id, batch_no, string_agg('<<<item-' || i || '>>>' || chr(10) || text, chr(10) ORDER BY i) AS message, count(*) AS n_items
    FROM nu
    GROUP BY doc_id, batch_no""",
)


def _reply(messages: list[str]) -> list[str]:
    """A stand-in for a model: another letter in every text, and now and then a reply that has lost a mark."""
    return [m.replace("e", "E").replace("<<<itEm-", "<<<item-") if len(m) % 7 else m.replace("<<<item-0>>>", "") for m in messages]


_replies = lambda t: T.map_translate(T.batch_message(_with_text(t)), _reply)
_parsed = lambda t: _replies(t).join(T.batch_message(_with_text(t)), ["doc_id", "batch_no"]).withColumn("parsed", T.parse_batch_response(F.col("raw"), F.col("n_items").cast("int")))
_PARSED = f"""{_PACK},
nu AS (SELECT pk.doc_id, pk.idx, batch_no, text, row_number() OVER (PARTITION BY pk.doc_id, batch_no ORDER BY pk.idx) - 1 AS i, count(*) OVER (PARTITION BY pk.doc_id, batch_no) AS n FROM pk JOIN seq USING (doc_id, idx)),
me AS (SELECT doc_id, batch_no, count(*) AS n, string_agg('<<<item-' || i || '>>>' || chr(10) || text, chr(10) ORDER BY i) AS message FROM nu GROUP BY doc_id, batch_no),
ms AS (SELECT *, length(message) % 7 AS bad FROM me)"""
add("map_translate", lambda t: _replies(t), "items", f"""{_PARSED}
SELECT doc_id, batch_no, CASE WHEN bad = 0 THEN replace(message, '<<<item-0>>>', '') ELSE replace(replace(message, 'e', 'E'), '<<<itEm-', '<<<item-') END AS raw FROM ms""")
add(
    "parse_batch_response",
    lambda t: _parsed(t).select("doc_id", "batch_no", F.coalesce(F.size("parsed"), F.lit(-1)).cast("long").alias("n_parsed"), F.array_join(F.transform("parsed", lambda p: F.concat_ws("=", p["i"].cast("string"), p["text"])), "|").alias("texts")),
    "items",
    rf"""{_PARSED}, tx AS (SELECT doc_id, batch_no, string_agg(i || '=' || nfc_normalize(regexp_replace(regexp_replace(replace(text, 'e', 'E'), '^\s+', ''), CASE WHEN i = n - 1 THEN '[\s"'']+$' ELSE '\s+$' END, '')), '|' ORDER BY i) AS texts FROM nu GROUP BY doc_id, batch_no)
    SELECT doc_id, batch_no, CASE WHEN bad = 0 THEN -1 ELSE n END AS n_parsed, CASE WHEN bad <> 0 THEN texts END AS texts FROM ms JOIN tx USING (doc_id, batch_no)""",
)
add(
    "split_failed_batches",
    lambda t: T.split_failed_batches(_with_text(t), _parsed(t).where("parsed is null").select("doc_id", "batch_no")),
    "items",
    f"""
    {_PARSED} SELECT nu.doc_id, nu.idx, nu.batch_no * 2 + CASE WHEN i >= floor(nu.n / 2.0) THEN 1 ELSE 0 END AS half_no, CASE WHEN nu.n = 1 THEN 'failed' ELSE 'retry' END AS state
    FROM nu JOIN ms USING (doc_id, batch_no)
    WHERE bad = 0""",
)
add("items_per_call", lambda t: T.items_per_call(_packed(t)), "items", f"{_PACK} SELECT doc_id, count(DISTINCT batch_no) AS n_calls, count(*) / count(DISTINCT batch_no) AS avg_items FROM pk GROUP BY doc_id")
_LEN = "length('<<<item-' || i || '>>>') + 1 + length(text)"
add("translate_rounds", lambda t: T.translate_rounds(_with_text(t), _reply), "items", rf"""{_PACK}, r AS (SELECT pk.doc_id, pk.idx, pk.batch_no, seq.text, 1 AS round FROM pk JOIN seq USING (doc_id, idx)
UNION ALL SELECT doc_id, idx, batch_no * 2 + CASE WHEN i >= floor(n / 2.0) THEN 1 ELSE 0 END, text, round + 1 FROM (SELECT *, (sum({_LEN}) OVER (PARTITION BY doc_id, batch_no) + n - 1) % 7 AS bad FROM
  (SELECT *, row_number() OVER (PARTITION BY doc_id, batch_no ORDER BY idx) - 1 AS i, count(*) OVER (PARTITION BY doc_id, batch_no) AS n FROM r) a) b WHERE bad = 0 AND n > 1),
q AS (SELECT *, row_number() OVER (PARTITION BY round, doc_id, batch_no ORDER BY idx) - 1 AS i, count(*) OVER (PARTITION BY round, doc_id, batch_no) AS n FROM r),
z AS (SELECT *, (sum({_LEN}) OVER (PARTITION BY round, doc_id, batch_no) + n - 1) % 7 AS bad FROM q)
SELECT doc_id, idx, CASE WHEN bad = 0 THEN 'failed' ELSE 'done' END AS state, CASE WHEN bad <> 0 THEN nfc_normalize(regexp_replace(regexp_replace(replace(text, 'e', 'E'), '^\s+', ''), CASE WHEN i = n - 1 THEN '[\s"'']+$' ELSE '\s+$' END, '')) END AS text, round AS n_rounds
FROM z QUALIFY row_number() OVER (PARTITION BY doc_id, idx ORDER BY round DESC) = 1""")
add(
    "absorb_results",
    lambda t: T.absorb_results(t.pairs, _P).select("conv_id", "turn", "state", "error", "to_cache"),
    "pairs",
    f"""
    WITH {_QUAL} SELECT conv_id, turn, CASE WHEN trim(output) = '' THEN 'failed' WHEN passed THEN 'accepted' ELSE 'kept' END AS state, CASE WHEN trim(output) = '' THEN 'empty_translation' ELSE '' END AS error, trim(output) <> '' AND passed AS to_cache
    FROM q""",
)
add(
    "translate_fallback",
    lambda t: T.translate_fallback(t.pairs.select(F.col("conv_id").alias("item_id"), F.col("turn").alias("attempt"), F.lit("source").alias("input"), "output"), _P),
    "pairs",
    f"""
    WITH q0 AS (SELECT conv_id AS item_id, turn AS attempt, output, regexp_matches(output, '\\S') AND {_cnt('output')} = 0 AS ok
    FROM pairs) SELECT item_id, coalesce(min_by(output, attempt) FILTER (ok), max_by(output, attempt), 'source') AS text, bool_or(ok) AS passed
    FROM q0
    GROUP BY item_id""",
)
add("translate_stats", lambda t: T.translate_stats(_routed(t).select("doc_id", "route", F.when((F.col("route") == "pending") & (F.length("text") % 5 == 0), "failed").otherwise("accepted").alias("state"))), "items glossary", f"""WITH {_ROUTE}, s AS (SELECT doc_id, count(*) FILTER (route <> 'skip') AS n_needed, count(*) FILTER (route <> 'skip' AND NOT (route = 'pending' AND length(text) % 5 = 0)) AS n_ok, count(*) FILTER (route = 'pending' AND length(text) % 5 = 0) AS n_fail, count(*) FILTER (route = 'cache') AS n_hits FROM ro GROUP BY doc_id)
SELECT *, CASE WHEN n_needed = 0 THEN 0.0 ELSE n_hits * 100.0 / n_needed END AS cache_pct, CASE WHEN n_needed = 0 THEN 100.0 ELSE n_ok * 100.0 / n_needed END AS translated_pct, CASE WHEN n_needed = 0 OR n_fail < 0.2 * n_needed THEN 'OK' ELSE 'FAIL' END AS outcome FROM s""")
add(
    "translated_body",
    lambda t: t.source_blocks.select("doc_id", "idx", F.element_at(T.translated_body(_elements(), F.concat(F.lit("to: "), "content")), 1).alias("e")).select("doc_id", "idx", "e.kind", "e.content", F.element_at("e.style", "bold").alias("bold")),
    _SB,
    "SELECT doc_id, idx, 'text_run' AS kind, 'to: ' || content AS content, 'true' AS bold FROM source_blocks",
)
