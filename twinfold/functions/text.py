"""Text measures, cleaning and quality gates for translated text."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges counted as untranslated script, accented letters of the target alphabet, common words without
#: their accents, words after which a code fence opens, and what a model puts before its answer.
CJK = "[\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}]"
DIACRITICS = "[àáảãạâầấẩẫậăằắẳẵặđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵ]"
UNACCENTED = (
    "khong duoc nguoi viec thoi gian cong hoi nghi huong dan tai khoa hoc thanh cong truong thong tin trong ngoai chao ban toi bay "
    "gio nay kia do day kia ay nha cua tren duoi dau tien cuoi gan xa"
).split()
FENCES = ("vietnamese", "vi", "markdown", "text")
PREFIXES = (r"^(?:Bản\s*dịch|Dịch|Translation|Đây là bản dịch|Sau đây là)\s*[:：]\s*", r"^(?:Output|Kết quả)\s*[:：]\s*")
_WORDS = r"[^\p{L}\p{N}_]+"


def cjk_count(text: Column, pattern: str = CJK) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))


def has_cjk(text: Column, pattern: str = CJK) -> Column:
    return F.coalesce(F.rlike(text, F.lit(pattern)), F.lit(False))


def unaccented_count(text: Column, words: list[str] = UNACCENTED, min_words: int = 3) -> Column:
    """Whole words of the list, in any case; fewer than min_words count as none."""
    n = F.size(F.filter(F.split(F.lower(text), _WORDS), lambda w: w.isin(words)))
    return F.when(text.isNotNull() & (n >= min_words), n).otherwise(0)


def has_diacritics(text: Column, pattern: str = DIACRITICS) -> Column:
    return F.coalesce(F.rlike(F.lower(text), F.lit(pattern)), F.lit(False))


def is_blank(text: Column) -> Column:
    return text.isNull() | ~F.rlike(text, F.lit(r"(?U)\S"))


_OPEN = re.compile(rf"```(?:{'|'.join(FENCES)})?\s*\n", re.IGNORECASE)
_CLOSE = re.compile(r"\n```\s*\Z")
_QUOTES = ('"', "'")


def clean_one(text: str | None) -> str:
    """Trim, peel off code fences and quotes until nothing changes, drop known prefixes, compose accents."""
    now, before = (text or "").strip(), None
    while now != before:
        before = now
        if opened := _OPEN.match(now):
            now = now[opened.end() :].strip()
        now = _CLOSE.sub("", now).strip()
        if now.startswith(_QUOTES):
            now = now[1:].strip()
        if now.endswith(_QUOTES):
            now = now[:-1].strip()
    for pattern in PREFIXES:
        if found := re.match(pattern, now, re.IGNORECASE):
            now = now[found.end() :].lstrip()
    return unicodedata.normalize("NFC", now)


@F.pandas_udf(T.StringType())
def _clean(texts: pd.Series) -> pd.Series:
    return texts.map(clean_one)


def clean_artifacts(text: Column) -> Column:
    """Spark has no Unicode composition, so what may change goes to Python; plain clean text stays in the JVM."""
    touched = F.rlike(text, F.lit("(?iU)^\\s|\\s$|^[`'\"]|[`'\"]$|^(translation|output)|[^\\x00-\\x7F]"))
    return F.when(text.isNull(), "").when(touched, _clean(text)).otherwise(text)


def looks_untranslated(source: Column, output: Column, pattern: str = CJK, share: float = 0.3) -> Column:
    given, left = cjk_count(source, pattern), cjk_count(output, pattern)
    return F.when(is_blank(output) & ~is_blank(source), True).when(given == 0, False).otherwise(left / given > share)


def assess_quality(source: Column, output: Column, pattern: str = CJK, words: list[str] = UNACCENTED) -> Column:
    """struct(passed, issues, cjk_count, unaccented, in_len, out_len, ratio, detail). Only an empty, leaking or untranslated output fails."""
    given, made = F.length(F.coalesce(source, F.lit(""))), F.length(F.coalesce(output, F.lit("")))
    ratio, cjk, bare = made / F.greatest(given, F.lit(1)), cjk_count(output, pattern), unaccented_count(output, words)
    rules = [("empty_output", is_blank(output) & ~is_blank(source)), ("cjk_leak", cjk > 0), ("unaccented", bare > 0), ("looks_untranslated", looks_untranslated(source, output, pattern)), ("suspicious_ratio", (given >= 20) & (made > 0) & ((ratio < 0.2) | (ratio > 5.0)))]
    issues = F.array_compact(F.array(*[F.when(test, name) for name, test in rules]))
    failed = rules[0][1] | rules[1][1] | rules[3][1]
    # hundredths in whole numbers, halves to the even one
    whole, rest = F.floor(100 * made / F.greatest(given, F.lit(1))), (100 * made) % F.greatest(given, F.lit(1))
    parts = whole + F.when((2 * rest > given) | ((2 * rest == given) & (whole % 2 == 1)), 1).otherwise(0)
    shown = F.when(given > 0, F.concat(F.lit("ratio="), F.floor(parts / 100).cast("string"), F.lit("."), F.lpad((parts % 100).cast("string"), 2, "0")))
    detail = F.concat_ws(" ", F.when(cjk > 0, F.concat(F.lit("cjk="), cjk.cast("string"))), F.when(bare > 0, F.concat(F.lit("unacc="), bare.cast("string"))), shown)
    return F.struct((~failed).alias("passed"), issues.alias("issues"), cjk.alias("cjk_count"), bare.alias("unaccented"), given.alias("in_len"), made.alias("out_len"), ratio.alias("ratio"), detail.alias("detail"))


def cache_key(text: Column, lang: str = "en", mode: str = "content") -> Column:
    return F.sha2(F.concat(F.lit(f"{lang}\x00{mode}\x00"), text).cast("binary"), 256)
