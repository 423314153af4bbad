"""Spelling variants: words one edit apart by bidirectional search schemes over FM-indexes of the vocabulary, and their forms."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import materialise, small_side, table

#: Maximal runs of these letters are words' raw forms; only A-Z have a lower case here.
LETTERS = "A-Za-zÀ-ÿ"
#: Characters of a shard of the vocabulary, on average, and the most that words with one key may have together before the key is refined.
SHARD = 100_000
#: One-error states that are followed at once.
STATES = 500_000


class Index:
    """The suffix ranks of words, each ended by a mark of its own, and the counts of every symbol before every rank."""

    def __init__(self, words: list[str]):
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        codes = np.frombuffer("".join(w + "\0" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.sizes, self.start = sizes, np.cumsum(sizes + 1) - sizes - 1
        letters, symbols = np.unique(codes, return_inverse=True)
        self.text, n, v = symbols, len(codes), len(words)
        ends = self.start + sizes
        rank = symbols + v
        rank[ends] = np.arange(v)
        step = 1
        while True:
            after = np.zeros(n, dtype=np.int64)
            after[: n - step] = rank[step:] + 1 if step < n else 0
            key = rank * (n + v + len(letters) + 2) + after
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
            step *= 2
            if rank[order[-1]] == n - 1:
                break
        before = symbols[order - 1]
        self.occ = np.zeros((n + 1, len(letters)), dtype=np.int32)
        self.occ[np.arange(1, n + 1), before] = 1
        np.cumsum(self.occ, axis=0, out=self.occ)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=len(letters)))[:-1]))
        # the word that begins at each suffix with an end mark before it, in the order of ranks
        self.heads = np.searchsorted(self.start, order[before == 0])

    def back(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranks of suffixes that begin with c and go on with those between lo and hi."""
        return self.first[c] + self.occ[lo, c], self.first[c] + self.occ[hi, c]

    def search(self, word: np.ndarray, front: np.ndarray, rear: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for the words one edit away from indexed words, the edit between their first `front` and last `rear` letters.

        From the end mark leftwards: the last letters exactly, then letters with one error, then the others exactly.
        """
        found = []
        clean = [np.arange(len(word)), self.sizes[word], np.zeros(len(word), dtype=np.int64), np.full(len(word), len(self.sizes))]
        wrong: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * 4
        while len(clean[0]) or len(wrong[0]):
            q, p, lo, hi = wrong
            done = p == 0
            self._ended(q[done], lo[done], hi[done], found)
            wrong = [x[~done] for x in wrong]
            wrong = self._exact(word, *wrong)
            q, p, lo, hi = clean
            made = [wrong]
            free = p <= self.sizes[word[q]] - rear[q]
            inside = free & (p > front[q])
            made.append([q[inside], p[inside] - 1, lo[inside], hi[inside]])  # a letter of the query is missing
            some = np.flatnonzero(free)
            if len(some):
                low, high = self.occ[lo[some]], self.occ[hi[some]]
                at, c = np.nonzero(low[:, 1:] < high[:, 1:])
                c = c + 1
                low, high = self.first[c] + low[at, c], self.first[c] + high[at, c]
                at = some[at]
                more, next_ = p[at] > front[q[at]], self.text[np.maximum(self.start[word[q[at]]] + p[at] - 1, 0)]
                other = more & (c != next_)
                made.append([q[at[other]], p[at[other]] - 1, low[other], high[other]])  # another letter
                extra = ~more | (c != next_)
                made.append([q[at[extra]], p[at[extra]], low[extra], high[extra]])  # one letter more
            on = p > front[q]
            clean = self._exact(word, q[on], p[on], lo[on], hi[on])
            wrong = [np.concatenate(x) for x in zip(*made, strict=True)]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        q, w = (np.concatenate(x) for x in zip(*found, strict=True))
        key = np.unique(q * len(self.sizes) + w)
        return key // len(self.sizes), key % len(self.sizes)

    def _exact(self, word, q, p, lo, hi):
        lo, hi = self.back(self.text[self.start[word[q]] + p - 1], lo, hi)
        alive = lo < hi
        return [q[alive], p[alive] - 1, lo[alive], hi[alive]]

    def _ended(self, q, lo, hi, found):
        lo, hi = self.occ[lo, 0], self.occ[hi, 0]
        whole = lo < hi  # one word at most: they differ
        if whole.any():
            found.append((q[whole], self.heads[lo[whole]]))


def _near(part: pa.Table) -> pa.Table:
    """A shard: words (word, n, lo, hi, a, b); those with lo to hi letters are looked for."""
    part = part.combine_chunks()
    rows, toward = part.column("word").to_pylist(), part.column("backward")[0].as_py()
    lo, hi, a, b = (np.asarray(part.column(c).combine_chunks()).astype(np.int64) for c in ("lo", "hi", "a", "b"))
    names = sorted(set(rows))
    place = {w: i for i, w in enumerate(names)}
    word = np.fromiter(map(place.__getitem__, rows), dtype=np.int64, count=len(rows))
    n = np.zeros(len(names), dtype=np.int64)
    n[word] = np.asarray(part.column("n").combine_chunks())
    index = Index(names if toward else [w[::-1] for w in names])
    size = index.sizes[word]
    # in a class of several lengths every word has its own halves
    front = np.where(hi > lo, np.where(b > 0, 0, size // 2), a)
    rear = np.where(hi > lo, np.where(b > 0, size - size // 2, 0), b)
    if not toward:
        front, rear = rear, front
    asked = np.flatnonzero((lo <= size) & (size <= hi))
    out = [index.search(word[x], front[x], rear[x]) for x in np.array_split(asked, max(1, len(asked) * 100 // STATES)) if len(x)]
    parts = np.array_split(asked, max(1, len(asked) * 100 // STATES))
    mine = np.concatenate([word[x][q] for x, (q, _) in zip([x for x in parts if len(x)], out, strict=True)] or [np.zeros(0, dtype=np.int64)])
    other = np.concatenate([w for _, w in out] or [np.zeros(0, dtype=np.int64)])
    every = pa.array(names)
    return pa.table({"word": every.take(pa.array(mine)), "near": every.take(pa.array(other)), "near_n": pa.array(n[other])})


def _class_from(size: Column) -> Column:
    """The least length of the class of a length: 0, 1, 2, 4, 6, 8, 12, 20, 36, ..."""
    power = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(size - 4, F.lit(1)).cast("double")) + 1e-9)).cast("int")
    return F.when(size < 2, size).when(size < 4, 2).when(size < 6, 4).otherwise(4 + power)


def _class_to(low: Column) -> Column:
    return F.when(low < 2, low).when(low < 4, 3).when(low < 6, 5).otherwise(2 * low - 5)


def _entry(lo: Column, hi: Column, a: Column, b: Column) -> Column:
    return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), a.cast("int").alias("a"), b.cast("int").alias("b"))


def _keyed(rows: DataFrame) -> DataFrame:
    """rows (word, n, e) with the key of their entry: classes of lengths, and the letters that must be equal at both ends."""
    left, right = F.substring("word", F.lit(1), F.col("e.a")), F.when(F.col("e.b") > 0, F.expr("right(word, e.b)")).otherwise("")
    return rows.select("word", "n", "e.*", F.struct("e.*", left.alias("x"), right.alias("y")).alias("key")).withColumn("key", F.xxhash64("key"))


def _first_entries(vocabulary: DataFrame) -> DataFrame:
    """Every word with the halves of its class, and with those of the classes that a letter more or less would belong to."""
    size = F.length("word")
    classes = F.array_distinct(F.transform(F.filter(F.array(size - 1, size, size + 1), lambda x: x >= 0), _class_from))
    both = lambda lo: F.array(_entry(lo, _class_to(lo), F.floor(lo / 2), F.lit(0)), _entry(lo, _class_to(lo), F.lit(0), lo - F.floor(lo / 2)))
    return vocabulary.select("word", "n", F.explode(F.flatten(F.transform(classes, both))).alias("e"))


def _finer_entries(rows: DataFrame) -> DataFrame:
    """A class of several lengths becomes one entry a length; one of a single length is split where the error may be: in the first half of what is free, or behind it."""
    size, lo, hi, a, b = F.length("word"), F.col("lo"), F.col("hi"), F.col("a"), F.col("b")
    lengths = F.filter(F.array(size - 1, size, size + 1), lambda x: x.between(lo, hi))
    singles = F.transform(lengths, lambda x: F.when(b > 0, _entry(x, x, F.lit(0), x - F.floor(x / 2))).otherwise(_entry(x, x, F.floor(x / 2), F.lit(0))))
    half = F.floor((lo - a - b) / 2)
    halves = F.array(_entry(lo, lo, a + half, b), _entry(lo, lo, a, lo - a - half))
    return rows.select("word", "n", F.explode(F.when(hi > lo, singles).otherwise(halves)).alias("e"))


def near_words(vocabulary: DataFrame, shard: int = SHARD) -> DataFrame:
    """(word, near, near_n) for words that differ by one inserted, deleted or replaced code point; a pair may come more than once, each way round.

    vocabulary: word (distinct), n. One error leaves the first or the second half of a word as it is. So words are dealt
    to shards by lengths and either half, and a shard's index answers for the words with that half: backwards over the
    words for the second half, over the reversed words for the first. A key of very many words is refined: what may
    hold the error is halved again, until the words of a key differ in one or two letters, so a shard is bounded however
    many words share a half.
    """
    ship(vocabulary.sparkSession)
    rows, parts = _keyed(_first_entries(vocabulary)), []
    while True:
        weight = rows.groupBy("key").agg(F.sum(F.length("word") + 1).alias("chars"), F.max((F.col("hi") > F.col("lo")) | (F.col("lo") - F.col("a") - F.col("b") > 1)).alias("finer"))
        hot = materialise(weight.where(F.col("finer") & (F.col("chars") > shard)).select("key"), "hot-keys")
        if hot.isEmpty():
            parts.append(rows)
            break
        side = small_side(hot)
        parts.append(rows.join(side, "key", "left_anti").select(*rows.columns))
        rows = materialise(_keyed(_finer_entries(rows.join(side, "key", "left_semi"))), "finer-words")
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    total = sum(p.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).first()[0] for p in parts)
    placed = whole.withColumns({"backward": F.col("b") > F.col("a"), "shard": F.pmod("key", F.lit(max(1, math.ceil(total / shard))))})
    return placed.select("backward", "shard", "word", "n", "lo", "hi", "a", "b").groupBy("backward", "shard").applyInArrow(_near, "word string, near string, near_n long")


def variants(vocabulary: DataFrame, ratio: int = 2, shard: int = SHARD) -> DataFrame:
    """word, form, root, n, n_near, form_n for a vocabulary (word, n).

    A word's form is its near word of largest n (ties: smallest in code-point order), if that n is at least ratio times
    the word's. Its root is the last word on the way from form to form. Rows with a null word are left out; repeated
    words are added up; empty words and words of any length are taken; an empty table gives an empty result. ratio must
    be over 1, so that forms end. Extra columns don't matter.
    """
    words = materialise(vocabulary.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "vocabulary")
    alone = words.select("word", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"), "n")
    pairs = near_words(words, shard).withColumn("n", F.lit(None).cast("long")).unionByName(alone).repartition("word")
    once = pairs.groupBy("word", "near").agg(F.max("near_n").alias("near_n"), F.max("n").alias("n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))))
    judged = once.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    taken = -F.col("best.less") >= ratio * F.col("n")
    forms = materialise(judged.select("word", "n", "n_near", F.when(taken, F.col("best.form")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n")), "forms")
    roots, on = forms.where("form is not null").select("word", F.col("form").alias("root")), True
    while on:  # every round doubles the length of the way
        further = small_side(roots).select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = materialise(roots.select("word", "root").join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        on = not roots.where("moved").isEmpty()
    return forms.join(roots.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def counted(docs: DataFrame, at_least: int = 5, times: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of whole texts with so many letters and occurrences, some of them misspelt on purpose.

    Of the runs for which 97 divides h, the crc32 of `<doc_id>:<lower-cased run>`, the letter h % length is left out. A null text has no
    words, a null doc_id counts as an empty string, repeated rows count each.
    """
    run = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{at_least},}}"), F.lit(0))).alias("run")
    lower = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"), run).select("d", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    h = lower.select("run", F.crc32(F.concat_ws(":", "d", "run").cast("binary")).alias("h"))
    cut = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % 97 == 0, F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))).otherwise(F.col("run"))
    return h.select(word.alias("word")).where(F.length("word") >= at_least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(counted(table(spark, sf_dir, "documents")))
