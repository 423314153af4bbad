"""Toxicity by class-conditional Kneser-Ney models of how words are spelt."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow.parquet
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import map_pandas
from ..sources.pages import files
from .common import materialise, new_path, portions, small_side, table

ORDER = 6
_WORD = re.compile(r"\w+")
_FIRST, _LAST = "\x02", "\x03"
_MULTIPLY, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_loaded: dict[str, tuple] = {}


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; a null id counts as the empty string, whose remainder is 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def gram_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(start of each word in the joined characters, place of each character in its word, by order the hash of the gram that ends at each character)."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths) - lengths
    chars = np.frombuffer("".join(words).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    place = np.arange(len(chars)) - np.repeat(starts, lengths)
    out, h = [], np.zeros(len(chars), dtype=np.uint64)
    for o in range(ORDER):
        h = (h + np.concatenate((np.zeros(o, dtype=np.uint64), chars[: len(chars) - o]))) * _MULTIPLY
        h = (h ^ h >> np.uint64(32)) * _SPREAD
        h = h ^ h >> np.uint64(29)
        out.append(h)
    return starts, place, out


def _load(path: str) -> tuple:
    """The model's grams as arrays sorted by hash; read once by each worker process, whatever tasks it runs."""
    if path not in _loaded:
        fs, base = files(path)
        rows = pyarrow.parquet.read_table(base, filesystem=fs)
        key = rows["key"].to_numpy().view(np.uint64)
        order = np.argsort(key)
        _loaded.clear()
        _loaded[path] = key[order], rows["gain"].to_numpy()[order], rows["back"].to_numpy()[order], {}
    return _loaded[path]


@dataclass
class Model:
    """Two interpolated modified Kneser-Ney models of the characters of a word, as differences of log-probabilities.

    By class, the probability of a character after those before it discounts the count of the whole gram of ORDER
    characters and backs off to shorter ones, which count the distinct characters seen in front of them; the shortest
    backs off to counts that both classes share. A rare expression so gets most of its probability from what both
    classes know, and one that neither knows tells nothing. Written as differences (toxic minus ordinary), a gram adds
    its gain wherever it stands and its back wherever a character follows it: a word's difference is a plain sum.
    """

    grams: DataFrame  # gram, key (its hash), gain, back
    path: str  # where they are written
    size: int  # how many there are
    each: float  # what every character adds: the back of the empty history
    share: float = 0.03  # of the words of a toxic document, how many come from the toxic model
    weights: tuple[float, float] = (0.0, 0.0)  # score is logistic(weights[0] + weights[1] * asinh(100 * difference))

    def evidence(self, difference):
        """log-likelihood of a word in a toxic document (a mixture of both models) minus that in an ordinary one."""
        return np.logaddexp(np.log1p(-self.share), np.log(self.share) + difference)

    def _of_words(self, words: list[str], held: tuple) -> np.ndarray:
        keys, gain, back, _ = held
        starts, place, hashes = gram_hashes([f"{_FIRST}{w}{_LAST}" for w in words])
        total = np.zeros(len(place))
        follows = np.append(place[1:] > 0, False)
        there = np.arange(len(place))
        for o, h in enumerate(hashes):
            there = there[place[there] >= o]
            if not len(keys) or not len(there):
                break
            at = np.minimum(np.searchsorted(keys, h[there]), len(keys) - 1)
            hit = keys[at] == h[there]
            there, at = there[hit], at[hit]  # a gram can only be there if the shorter one that ends it is
            total[there] += gain[at]
            if o + 1 < ORDER:
                total[there] += np.where(follows[there], back[at], 0.0)
        total[place > 0] += self.each
        return self.evidence(np.add.reduceat(total, starts))

    def differences(self, docs: DataFrame, held_grams: int = 4_000_000) -> DataFrame:
        """docs with text replaced by x, the mean over its words of evidence(): toxic minus ordinary log-likelihood, normalised by length; 0 without words.

        Up to held_grams grams (24 bytes each) are held by every worker process, which reads them from the shared
        folder; a larger model is joined to the words of the documents instead, with the same result.
        """
        others = [c for c in docs.columns if c != "text"]
        fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in others)
        if self.size > held_grams:
            return self._by_join(docs, others)
        path, measure = self.path, Model(None, self.path, self.size, self.each, self.share)

        def run(parts):
            held = _load(path)
            memo = held[3]
            for part in parts:
                got: list[float] = []
                for texts in portions(part["text"]):
                    split = [_WORD.findall(t.lower()) for t in texts]
                    if len(memo) > 150_000:
                        memo.clear()
                    new = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in memo]
                    for at in range(0, len(new), 20_000):
                        some = new[at : at + 20_000]
                        memo.update(zip(some, measure._of_words(some, held).tolist(), strict=True))
                    got += [sum(map(memo.__getitem__, words)) / len(words) if words else 0.0 for words in split]
                yield part[others].assign(x=np.array(got, dtype=float))

        return map_pandas(docs.select(*others, "text"), run, fields + "x double").select(*others, "x")

    def _by_join(self, docs: DataFrame, others: list[str]) -> DataFrame:
        """The same by joins: words to grams, then documents to words. Frequent words are pre-aggregated by document."""
        rows = materialise(docs.withColumn("row#", F.monotonically_increasing_id()), "toxic-rows")

        def run(parts):
            for part in parts:
                for row, text in zip(part["row#"], part["text"], strict=True):
                    seen = Counter(_WORD.findall((text or "").lower()))
                    if seen:
                        yield pd.DataFrame([(row, *x) for x in seen.items()], columns=["row", "word", "n"])

        words = materialise(map_pandas(rows.select("row#", "text"), run, "row long, word string, n long"), "toxic-words")
        spelt = F.concat(F.lit(_FIRST), "word", F.lit(_LAST))
        ends = F.sequence(F.lit(1), F.length(spelt))
        grams = F.flatten(F.transform(ends, lambda j: F.transform(F.sequence(F.lit(1), F.least(j, F.lit(ORDER))), lambda o: F.struct(spelt.substr(j - o + 1, o).alias("gram"), ((o < ORDER) & (j < F.length(spelt))).alias("follows")))))
        parts = words.select("word").distinct().select("word", F.explode(grams).alias("g")).select("word", "g.*")
        sums = parts.join(self.grams, "gram", "left").groupBy("word").agg(F.sum(F.coalesce(F.col("gain"), F.lit(0.0)) + F.when(F.col("follows"), F.coalesce("back", F.lit(0.0))).otherwise(0.0)).alias("d"))
        values = sums.select("word", (F.col("d") + self.each * (F.length("word") + 1)).alias("d"))
        low, high = float(np.log1p(-self.share)), float(np.log(self.share))
        most = F.greatest(F.lit(low), F.col("d") + high)
        evidence = most + F.log1p(F.exp(-F.abs(F.col("d") + high - low)))
        found = words.join(values, "word").groupBy("row").agg((F.sum(F.col("n") * evidence) / F.sum("n")).alias("x"))
        return rows.join(found, rows["row#"] == found["row"], "left").select(*others, F.coalesce("x", F.lit(0.0)).alias("x"))


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, count among ordinary rows n0, among toxic rows n1)."""

    def flush(seen):
        return pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["word", "toxic", "n"])

    def run(parts):
        seen: Counter = Counter()
        for part in parts:
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                for word, n in Counter(_WORD.findall((text or "").lower())).items():
                    seen[word, int(toxic)] += n
                if len(seen) > 500_000:
                    yield flush(seen)
                    seen.clear()
        if seen:
            yield flush(seen)

    counted = map_pandas(rows.select("text", "toxic"), run, "word string, toxic int, n long")
    return counted.groupBy("word").agg(*[F.sum(F.when(F.col("toxic") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in (0, 1)])


def discounts(counts: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from how many grams have the counts 1, 2, 3 and 4."""
    out, y = [], counts[0] / (counts[0] + 2 * counts[1]) if counts[0] else 0.5
    for k in (1, 2, 3):
        d = k - (k + 1) * y * counts[k] / counts[k - 1] if counts[k - 1] else y
        out.append(min(max(d, 0.05), k))
    return out


def gram_levels(words: DataFrame) -> list[DataFrame]:
    """By length from 1 to ORDER the grams with their counts c0 and c1: of the longest, and of those at the start of a
    word, how often they stand in words; of the others how many different characters stand in front of them."""
    spelt = F.concat(F.lit(_FIRST), "word", F.lit(_LAST))
    grams = F.transform(F.sequence(F.lit(2), F.length(spelt)), lambda j: spelt.substr(F.greatest(j - (ORDER - 1), F.lit(1)), F.least(j, F.lit(ORDER))))
    top = materialise(words.select(F.explode(grams).alias("gram"), "n0", "n1").groupBy("gram").agg(F.sum("n0").alias("c0"), F.sum("n1").alias("c1")), "grams")
    levels = [materialise(top.where(F.length("gram") == ORDER), "grams-of-length")]
    for o in range(ORDER - 1, 0, -1):
        shorter = levels[0].groupBy(F.substring("gram", 2, o).alias("gram")).agg(*[F.count_if(F.col(c) > 0).alias(c) for c in ("c0", "c1")])
        levels.insert(0, materialise(shorter.unionByName(top.where(F.length("gram") == o)), "grams-of-length"))
    return levels


def _values(levels: list[DataFrame]) -> tuple[DataFrame, float]:
    """(gram, gain, back) of all grams and histories, and the back of the empty history."""
    ratio = lambda a, b: F.log(b) - F.log(a)
    every, each = [], 0.0
    shorter = None
    for o, level in enumerate(levels, 1):
        stats = level.agg(F.count("*").alias("size"), F.sum(F.col("c0") + F.col("c1")).alias("all"), *[F.count_if(F.col(f"c{i}") == k).alias(f"n{i}{k}") for i in (0, 1) for k in (1, 2, 3, 4)]).first()
        take = {i: F.element_at(F.array(F.lit(0.0), *map(F.lit, discounts([stats[f"n{i}{k}"] for k in (1, 2, 3, 4)]))), (F.least(F.col(f"c{i}"), F.lit(3)) + 1).cast("int")) for i in (0, 1)}
        cut = level.withColumns({"history": F.substring("gram", 1, o - 1), "t0": take[0], "t1": take[1]})
        history = cut.groupBy("history").agg(*[F.sum(f"{x}{i}").alias(f"{y}{i}") for i in (0, 1) for x, y in (("c", "k"), ("t", "taken"))])
        history = history.withColumns({f"m{i}": F.when(F.col(f"k{i}") > 0, F.col(f"taken{i}") / F.col(f"k{i}")).otherwise(1.0) for i in (0, 1)}).withColumn("back", ratio(F.col("m0"), F.col("m1")))
        history = materialise(history, "gram-histories")
        if o == 1:  # one history, the empty one
            shared = (F.col("c0") + F.col("c1") + 1) / float((stats["all"] or 0) + stats["size"] + 1)
            only = history.first()
            each = float(only["back"])
            both = cut.withColumns({**{c: F.lit(only[c]) for c in ("k0", "k1", "m0", "m1", "back")}, "q0": shared, "q1": shared})
        else:
            both = cut.join(history, "history").join(shorter.select(F.col("gram").alias("shorter"), F.col("p0").alias("q0"), F.col("p1").alias("q1")), F.substring("gram", 2, o) == F.col("shorter"))
        p = lambda i: F.when(F.col(f"k{i}") > 0, (F.col(f"c{i}") - F.col(f"t{i}")) / F.col(f"k{i}")).otherwise(0.0) + F.col(f"m{i}") * F.col(f"q{i}")  # noqa: E731, B023
        shorter = materialise(both.withColumns({"p0": p(0), "p1": p(1)}).select("gram", "p0", "p1", (ratio(F.col("p0"), F.col("p1")) - ratio(F.col("q0"), F.col("q1")) - F.col("back")).alias("gain")), "gram-values")
        every.append(shorter.select("gram", "gain", F.lit(0.0).alias("back")))
        if o > 1:
            every.append(history.select(F.col("history").alias("gram"), F.lit(0.0).alias("gain"), "back"))
    found = every[0]
    for more in every[1:]:
        found = found.unionByName(more)
    return found.groupBy("gram").agg(F.sum("gain").alias("gain"), F.sum("back").alias("back")), each


def _keyed(grams: DataFrame) -> DataFrame:
    def run(parts):
        for part in parts:
            if len(part):
                starts, _, hashes = gram_hashes(part["gram"].tolist())
                lengths = part["gram"].map(len).to_numpy()
                yield part.assign(key=np.array(hashes)[lengths - 1, starts + lengths - 1].view(np.int64))[["gram", "key", "gain", "back"]]

    return map_pandas(grams, run, "gram string, key long, gain double, back double")


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method with a little ridge; the slope is never negative. One class alone gives a constant."""
    if len(y) == 0 or y.min() == y.max():
        return float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), 0.0
    x, w, ridge = np.column_stack([np.ones(len(x)), x]), np.zeros(2), np.diag([1e-6, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
    return float(w[0]), max(float(w[1]), 0.0)


def fit(labelled: DataFrame, calibration_rows: int = 10_000, share: float = 0.03) -> Model:
    """labelled: text, toxic (0/1), fold. All rows of folds 1-3 are counted; fold 4 gives the two numbers that turn a difference into a score, from at most calibration_rows rows.

    Words and grams are counted, discounted and valued by Spark and stay in tables; to the driver come counts of counts
    and the calibration rows' differences. With no labels of one class the score is a constant, as no difference is known.
    """
    spark = labelled.sparkSession
    words = materialise(_word_counts(labelled.where("fold in (1, 2, 3)")), "word-counts")
    seen = words.agg(F.coalesce(F.sum("n0"), F.lit(0)).alias("n0"), F.coalesce(F.sum("n1"), F.lit(0)).alias("n1")).first()
    if seen["n0"] and seen["n1"]:
        values, each = _values(gram_levels(words))
    else:
        values, each = spark.createDataFrame([], "gram string, gain double, back double"), 0.0
    path = new_path(spark, "toxic-grams")
    _keyed(values).write.parquet(path)
    grams = spark.read.schema("gram string, key long, gain double, back double").parquet(path)
    model = Model(grams, path if "://" in path or path.startswith("file:") else f"file://{path}", grams.count(), each, share)
    # differences first, then the sample of them: no text goes to the driver
    measured = model.differences(labelled.where("fold = 4").select("text", F.col("toxic").cast("double").alias("y"), F.xxhash64("text").alias("at")))
    got = measured.orderBy("at", "x", "y").limit(calibration_rows).select("x", "y").toPandas().sort_values(["x", "y"]).to_numpy(dtype=float)
    model.weights = _logistic(np.arcsinh(100 * got[:, 0]), got[:, 1])
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id and score in 0..1 of every whole text, however long; only these columns come back, so extra columns can't clash.

    Null and empty texts have no words: difference 0, the score of no evidence. Equal texts have equal scores, repeated
    rows are each scored, an empty table gives an empty result.
    """
    measured = model.differences(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), **options)
    dot = model.weights[0] + model.weights[1] * F.asinh(100 * F.col("x"))
    return measured.select("doc_id", (1 / (1 + F.exp(-F.greatest(F.least(dot, F.lit(30.0)), F.lit(-30.0))))).alias("score"), F.col("x").alias("difference"))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, fold of the labelled documents of folds 1-4. Several labels of one id: toxic if one says so. Null labels are left out."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(fold_of() != 0)
    return docs.select("doc_id", "text").join(small_side(materialise(marks, "toxic-labels")), "doc_id").select("text", "toxic", fold_of().cast("int").alias("fold"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(labelled_rows(docs, table(spark, sf_dir, "labels")))
    return score(docs, model).select("doc_id", (fold_of() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "difference")
