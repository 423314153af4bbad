"""Quality rules with distribution divergence from language references."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_pandas
from .common import beside, free_names, materialise, quoted, small_side, table

#: Common words by language; a document's share of each makes its common-word histogram.
COMMON_WORDS = {
    "en": "the of and to in is it that for on with as was be by are this at from have".split(),
    "fr": "le la les de des du et un une que qui en dans pour par sur est pas au avec".split(),
    "de": "der die das und in zu den von mit ist nicht ein eine auf für im dem sich des als".split(),
    "es": "el la los las de que y en un una por con para del se no su es al lo".split(),
}
#: Character classes. Whatever is in none of them is "other"; letters beyond ASCII count as "wide".
CLASSES = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "blank": " \t\x0b\f\r", "line": "\n", "stop": ".,;:!?'\"()-", "symbol": "#*$%&|<>", "wide": "", "other": ""}
_VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})
_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _class_of_byte() -> np.ndarray:
    """Class number by UTF-8 byte; bytes after the first of a character have one of their own, dropped later."""
    names = list(CLASSES)
    of = np.full(256, names.index("other"), dtype=np.uint8)
    for i, chars in enumerate(CLASSES.values()):
        of[np.frombuffer(chars.encode(), dtype=np.uint8)] = i
    of[0xC0:], of[0x80:0xC0] = names.index("wide"), len(names)
    return of


def _repeats(words: list[bytes], width: int) -> int:
    """Words that stand in some window of width words found twice or more."""
    windows = list(zip(*[words[i:] for i in range(width)], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict = {}
    marked = np.zeros(len(words) + 1, dtype=np.int32)
    for at, w in enumerate(windows):
        first = seen.setdefault(w, at)
        if first != at:
            for x in (first, at):
                marked[x] += 1
                marked[min(x + width, len(words))] -= 1
    return int((np.cumsum(marked[:-1]) > 0).sum())


def measure_text(text: str | None, vocabulary: dict[bytes, int], of_byte: np.ndarray, width: int = 5) -> tuple:
    """The base counts, then both histograms; the last word bin holds all other words."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    chars = np.bincount(of_byte[np.frombuffer(raw, dtype=np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]
    common = [0] * (len(vocabulary) + 1)
    for w in raw.lower().split():
        common[vocabulary.get(w, -1)] += 1
    in_words = int(chars.sum() - chars[3] - chars[4])
    return len(words), in_words, sum(raw.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")), len(lines) - len(set(lines)), _repeats(words, width), chars.astype("int64"), common


def measured(docs: DataFrame, width: int = 5) -> DataFrame:
    """docs with its column text replaced by the base counts and the histograms chars and common of every whole text. Null text counts as empty."""
    keep = [c for c in docs.columns if c != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [_BASE, "chars array<long>, common array<long>"])
    names = [*[x.split()[0] for x in _BASE.split(", ")], "chars", "common"]

    def run(parts):
        vocabulary, of_byte = {w.encode(): i for i, w in enumerate(_VOCABULARY)}, _class_of_byte()
        for part in parts:
            got = [measure_text(t, vocabulary, of_byte, width) for t in part.pop("text")]
            yield pd.concat([part[keep], pd.DataFrame(got, columns=names, index=part.index)], axis=1)

    return map_pandas(docs.select(*keep, "text"), run, schema)


def divergence(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of counts from the reference's counts; nan if one is empty."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p = counts / counts.sum(1, keepdims=True)
        q = reference / reference.sum()
        m = (p + q) / 2
        both = np.where(p > 0, p * np.log2(p / m), 0.0).sum(1) + np.where(q > 0, q * np.log2(q / m), 0.0).sum(1)
        return np.where((counts.sum(1) > 0) & (reference.sum() > 0), np.sqrt(np.maximum(both / 2, 0.0)), np.nan)


def judged(docs: DataFrame, min_words: int = 50, max_chars: float = 0.30, max_common: float = 0.20, slack: float = 1.0, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns in keep, then base counts, base_failed, both distances and kept for every document.

    The reference of a language is the sum of the histograms of all its documents that pass the base rules and have
    min_words words: one pre-aggregated row for each of the languages in COMMON_WORDS, so these rows are bounded and
    go to the tasks with the function. A document is turned down by the base rules (under 10 words, or over 20 % of
    its words in repeated windows), or if it has min_words words and its distance to its language is over max_chars
    (characters) or over max_common + slack / sqrt(words) (common words; sampling noise of a histogram falls with the
    root of its size). Shorter documents and those of another or no language get no verdict by divergence and stay.
    Null or empty text: no words, fails. Repeated rows count each; there are no ties. Texts of any length are taken
    whole. Empty table: empty result. Extra columns don't come along; of kept ones that have a result's name, the
    result's gets an underscore behind it.
    """
    inner = [f"keep{i}" for i in range(len(keep))]
    rows = materialise(measured(docs.select(*[F.col(quoted(c)).alias(n) for c, n in zip(keep, inner, strict=True)], F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text"))), "quality")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rated = (F.col("n_words") >= min_words) & F.col("lang").isin(*COMMON_WORDS)
    sums = lambda c, n: F.array(*[F.sum(F.col(c)[i]) for i in range(n)])
    totals = rows.where(rated & ~failed).groupBy("lang").agg(sums("chars", len(CLASSES)).alias("chars"), sums("common", len(_VOCABULARY) + 1).alias("common")).collect()
    reference = {r["lang"]: (np.array(r["chars"], dtype=float), np.array(r["common"], dtype=float)) for r in totals}
    base = [x.split()[0] for x in _BASE.split(", ")]

    def run(parts):
        for part in parts:
            far = np.full((2, len(part)), np.nan)
            words, langs = part["n_words"].to_numpy(), part["lang"].to_numpy()
            for name, own in reference.items():
                at = np.flatnonzero((langs == name) & (words >= min_words))
                for k, c in enumerate(("chars", "common")):
                    if len(at):
                        far[k, at] = divergence(np.stack(part[c].to_numpy()[at]).astype(float), own[k])
            bad = (words < 10) | (100 * part["n_repeat_words"].to_numpy() > 20 * words)
            with np.errstate(invalid="ignore", divide="ignore"):
                kept = ~bad & ~(far[0] > max_chars) & ~(far[1] > max_common + slack / np.sqrt(np.maximum(words, 1)))
            yield part[[*inner, *base]].assign(base_failed=bad, char_distance=far[0], common_distance=far[1], kept=kept)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*inner).schema]
    found = map_pandas(rows, run, ", ".join([*fields, _BASE, "base_failed boolean, char_distance double, common_distance double, kept boolean"]))
    results = [*base, "base_failed", "char_distance", "common_distance", "kept"]
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, inner, strict=True)], *[F.col(r).alias(n) for r, n in zip(results, beside(list(keep), results), strict=True)])


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """The rows of docs that judged() keeps, all columns as they were, whatever their names. What is turned down is few: only its keys are joined."""
    key = [F.xxhash64(F.col(quoted(doc_id)), F.col(quoted(text))), F.xxhash64(F.lit("second"), F.col(quoted(doc_id)), F.col(quoted(text)))]
    keyed = docs.select(key[0].alias("k1"), key[1].alias("k2"), F.col(quoted(text)).alias("text"), F.col(quoted(lang)).alias("lang"))
    k1, k2 = free_names(docs, "k1", "k2")
    bad = judged(keyed, keep=("k1", "k2"), **options).where("not kept").select(F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct()
    return docs.withColumns({k1: key[0], k2: key[1]}).join(small_side(materialise(bad, "turned-down")), [k1, k2], "left_anti").select(*map(quoted, docs.columns))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), keep=("doc_id",))
