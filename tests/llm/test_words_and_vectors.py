"""BPE, spelling variants and hard negatives against the library, brute force and SQL; odd rows by value."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from twinfold.llm import bpe, negatives, spelling
from twinfold.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcé"


def documents(sf):
    return duckdb.connect().execute(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()


# --- BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(WORDS)


ODD_TEXTS = [
    None, "", " \n\t ", "<|endoftext|>x <|startoftext|", "É é Σας ΑΣ", "日本語  ａｂｃ　x y \x1c z", "'s it's'LL 12345 !!!???", "á ́b", "x" * 5000, "ab" * 3000 + "!", "\x00\x7f\xa0 ",
    " ".join(f"w{i % 977}x{i}" for i in range(20_000)), "".join(random.Random(5).choice("etaoin") for _ in range(20_000)),
]


def test_proposals_that_hold_are_what_merging_finds(encoder, library):
    rng = random.Random(1)
    names = list(encoder.ids)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 14))) for _ in range(5000)]
    words += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 20))) for _ in range(2000)]
    words += [(rng.choice(names) + rng.choice(names)).replace("</w>", "") for _ in range(8000)]
    merged = [[t.id for t in library.model.tokenize(w)] for w in words]
    held = encoder.speculate(words)
    assert all(h is None or h == m for h, m in zip(held, merged, strict=True))
    # and none is turned down that merging would have found
    assert all(h is not None or encoder._propose(w) != m for w, h, m in zip(words, held, merged, strict=True))
    assert 1000 < sum(h is None for h in held) < len(words) - 1000


def test_a_token_that_merging_cannot_make_is_not_taken():
    # (b, c) comes first, so "abc" is never made of ab and c
    ids = {"a": 0, "b": 1, "c": 2, "bc": 3, "ab": 4, "abc": 5}
    pairs = bpe.Pairs(ids, [["b", "c"], ["a", "b"], ["ab", "c"]])
    assert pairs.proper and pairs.whole.tolist() == [True, True, True, True, True, False]
    assert pairs.compatible(np.array([0, 4, 0]), np.array([3, 2, 1])).tolist() == [True, False, False]
    assert not bpe.Pairs(ids, [["ab", "c"], ["a", "b"], ["b", "c"]]).proper  # a merge before its parts
    assert bpe.Pairs({"a": 0}, []).compatible(np.array([0]), np.array([0])).tolist() == [True]


@pytest.mark.parametrize("memo", [200_000, 3])
def test_texts_equal_the_library(monkeypatch, library, memo):
    monkeypatch.setattr(bpe.Encoder, "MEMO", memo)
    fresh = bpe.Encoder(WORDS)
    texts = [t or "" for t in ODD_TEXTS]
    for _ in range(2):
        for at in range(0, len(texts), 3):
            ids = bpe.listed(fresh(texts[at : at + 3]))
            for text, found, shown in zip(texts[at : at + 3], ids.to_pylist(), fresh.decode(ids).to_pylist(), strict=True):
                want = library.encode(text, add_special_tokens=False).ids
                assert found == want and shown == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_bpe_query_equals_the_library(spark, library, sf):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_bpe"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    rows = documents(sf)
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        assert got[doc_id] == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest())


def test_bpe_of_odd_rows(spark, library):
    rows = spark.createDataFrame([(i, t, "mine") for i, t in enumerate([*ODD_TEXTS, ODD_TEXTS[4]])], "`a.b` long, text string, ids string")
    got = bpe.encode_decode(rows, WORDS, keep=("a.b", "ids"))
    assert got.columns == ["a.b", "ids", "ids_", "decoded"]
    found = {r["a.b"]: r for r in got.collect()}
    assert len(found) == len(ODD_TEXTS) + 1 and {r["ids"] for r in found.values()} == {"mine"}
    for i, text in enumerate([*ODD_TEXTS, ODD_TEXTS[4]]):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert found[i]["ids_"] == want and found[i]["decoded"] == library.decode(want, skip_special_tokens=False)
    assert found[0]["ids_"] == [] and found[0]["decoded"] == ""
    for packed in (True, False):
        assert bpe.encode_decode(rows.limit(0), WORDS, keep=("a.b",), packed=packed).collect() == []


def test_other_models_are_turned_down():
    with pytest.raises(ValueError):
        bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


# --- spelling


def near(word, letters):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out |= {word[:i] + c + word[i + 1 :] for c in letters} | {word[:i] + word[i + 1 :]}
    return out - {word}


def plain_variants(n, ratio=2):
    letters, have, forms = sorted(set("".join(n))), set(n), {}
    for w in n:
        found = near(w, letters) & have
        best = min(found, key=lambda x: (-n[x], x), default=None)
        forms[w] = (None if best is None or n[best] < ratio * n[w] else best, len(found))

    def root(w):
        while forms[w][0] is not None:
            w = forms[w][0]
        return w

    return sorted((w, f, root(w), n[w], k, None if f is None else n[f]) for w, (f, k) in forms.items())


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 9))) for _ in range(1500)})
    # many words with one half in common, and long ones
    words = sorted({*words, *("prefix" * 3 + w for w in words[:400]), *(w + "suffix" * 5 for w in words[:300]), "x" * 70, "x" * 71, "x" * 300, "x" * 301})
    return {w: rng.randint(1, 300) for w in words}


def test_the_index_finds_every_word_one_edit_away(vocabulary):
    words = [w for w in vocabulary if len(w) < 100]
    want = {(w, x) for w in words for x in near(w, sorted(set("".join(words)))) & set(words)}
    every = np.arange(len(words))

    def found(reverse, rear):
        index = spelling.Index([w[::-1] for w in words] if reverse else words)
        return {(words[i], words[j]) for i, j in zip(*index.search(every, np.zeros(len(words), dtype=int), rear(index.sizes)), strict=True)}

    assert found(False, lambda n: 0 * n) == want  # the error anywhere
    ends = found(False, lambda n: n - n // 2), found(True, lambda n: n // 2)
    assert ends[0] | ends[1] == want and ends[0] != want != ends[1]
    # both ends fixed: the error stays between them
    index = spelling.Index(words)
    fixed = {(words[i], words[j]) for i, j in zip(*index.search(every, index.sizes // 3, index.sizes // 3), strict=True)}
    assert fixed == {(w, x) for w, x in want if len(x) >= 2 * (len(w) // 3) and x.startswith(w[: len(w) // 3]) and x.endswith(w[len(w) - len(w) // 3 :])}


@pytest.mark.parametrize("shard", [100_000, 300])
def test_variants_equal_brute_force(spark, vocabulary, shard):
    table = spark.createDataFrame([(w, n, "x") for w, n in vocabulary.items()], "word string, n long, form string")
    assert sorted(map(tuple, spelling.variants(table, shard=shard).collect())) == plain_variants(vocabulary)


def test_keys_of_very_many_words_are_refined_until_they_are_small(spark):
    rng = random.Random(8)
    words = {"a" * 12 + "".join(rng.choice("bcdefghij") for _ in range(12)) for _ in range(3000)}
    words |= {w[:20] + w[21:] for w in list(words)[:300]} | {w[:-1] + "z" for w in list(words)[:300]}
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    rows = spelling._keyed(spelling._first_entries(table))
    assert rows.groupBy("key").count().agg(F.max("count")).first()[0] >= 3000
    found = spelling.near_words(table, shard=2000)
    got = {(r["word"], r["near"]) for r in found.collect()}
    assert got == {(w, x) for w in words for x in near(w, "abcdefghijz") & words} and got


def test_classes_of_lengths(spark):
    got = {r["id"]: (r["lo"], r["hi"]) for r in spark.range(3000).select("id", spelling._class_from(F.col("id").cast("int")).alias("lo")).select("id", "lo", spelling._class_to(F.col("lo")).alias("hi")).collect()}
    starts = [0, 1, 2, 4, 6, 8, 12, 20, 36, 68, 132, 260, 516, 1028, 2052, 4100]
    for lo, after in zip(starts, starts[1:], strict=False):
        assert all(got[i] == (lo, after - 1) for i in range(lo, min(after, 3000)))


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    return {w: n for w, n in counts.items() if n >= 3}


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_spelling_query_equals_brute_force(spark, sf):
    assert sorted(map(tuple, QUERIES["op12_spelling_variants"](spark, sf).select("word", "form", "root", "n", "n_near", "form_n").collect())) == plain_variants(plain_counts(documents(sf)))


def test_spelling_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "ÀPPLE apple×÷ Apple apples apples, APPLES"), (None, "apple"), (3, "ÀPPLE apple×÷ Apple apples apples, APPLES"), (4, "ab" * 150), (5, "ab" * 150), (6, "ab" * 150), (7, "\U0001f600Zürich zürich")]
    rows += [(i, f"lengthyword crc{chr(97 + i % 26)}run") for i in range(3000)]
    table = spark.createDataFrame([(*r, "w") for r in rows], "doc_id long, text string, word string")
    got = {r["word"]: r["n"] for r in spelling.counted(table).collect()}
    assert got == plain_counts(rows) and "apples" in got
    assert any(len(w) == 10 for w in got)  # letters are left out
    assert sorted(map(tuple, spelling.variants(spelling.counted(table)).collect())) == plain_variants(got)
    assert spelling.variants(spelling.counted(table.limit(0))).collect() == []
    ties = spark.createDataFrame([("bword", 5), ("bword", 5), ("aword", 10), ("cword", 1), (None, 9)], "word string, n long")
    assert sorted(map(tuple, spelling.variants(ties).collect())) == [("aword", None, "aword", 10, 2, None), ("bword", None, "bword", 10, 2, None), ("cword", "aword", "aword", 1, 2, 10)]


def test_words_of_very_many_letters(spark):
    words = ["ab" * 10_000, "ab" * 10_000 + "c", "ab" * 5_000 + "c" + "ab" * 5_000, "b" * 19_999]
    got = {r["word"]: (words.index(r["root"]), r["n_near"]) for r in spelling.variants(spark.createDataFrame([(w, 10**i) for i, w in enumerate(words)], "word string, n long")).collect()}
    assert [got[w] for w in words] == [(2, 2), (1, 1), (2, 1), (3, 0)]


def test_roots_of_a_long_way(spark):
    words = [("a" * i, 2 ** (i - 5)) for i in range(5, 40)]
    got = spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()
    assert {r["root"] for r in got} == {"a" * 39} and all(r["form"] == (None if len(r["word"]) == 39 else "a" * (len(r["word"]) + 1)) for r in got)


# --- hard negatives


def plain_negatives(rows, is_anchor=lambda i: i % 100 == 0, k=5, m=5, low=80):
    rows = [(i, y, v) for i, y, v in rows if None not in (i, y, v) and all(x is not None for x in v)]
    out = []
    for anchor, label, own in {(i, y, tuple(v)) for i, y, v in rows if is_anchor(i)}:
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(own, v, strict=False)), i, y) for i, y, v in rows if i != anchor)
        for p, i, _ in [x for x in scored if x[2] == label][:k]:
            fits = [(q, j) for q, j, y in scored if y != label and low * -p <= 100 * -q <= 100 * -p]
            out += [(anchor, i, rank, j, -p, -q) for rank, (q, j) in enumerate(fits[:m], 1)]
    return sorted(out)


def prepared(rows):
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            yield i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(x)) for x in v]


def test_negatives_query_equals_brute_force(spark):
    rows = duckdb.connect().execute(f"select vec_id, label, embedding from '{SF}/embeddings.parquet'").fetchall()
    assert sorted(map(tuple, QUERIES["op13_hard_negatives"](spark, SF).collect())) == plain_negatives(prepared(rows))


SCHEMA = "id long, label long, vec array<long>"


@pytest.mark.parametrize(("rows_in", "anchors_in", "broadcast"), [(4096, 1024, 64 << 20), (7, 3, 64 << 20), (5, 2, 0)])
def test_blocks_make_no_difference(spark, monkeypatch, rows_in, anchors_in, broadcast):
    monkeypatch.setattr(negatives, "ROWS", rows_in)
    monkeypatch.setattr(negatives, "ANCHORS", anchors_in)
    monkeypatch.setattr(negatives, "BROADCAST_BYTES", broadcast)
    rng = random.Random(2)
    # few values, so that ties are many; lengths differ; one vector stands very often; negative scores too
    rows = [(i, rng.randint(0, 2), [rng.randint(-2, 3) for _ in range(rng.choice((3, 4)))]) for i in range(150)]
    rows += [(i, i % 3, [1, 1, 1, 1]) for i in range(150, 320)]
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA), "id % 10 = 0")
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_of_odd_rows(spark):
    rows = [(0, 1, [3, 4]), (0, 1, [3, 4]), (1, 1, [3, 4]), (1, 1, [3, 4]), (2, 2, [3, 4]), (2, 2, [3, 4]), (3, 2, [3]), (4, None, [3, 4]), (None, 1, [3, 4]), (5, 1, None), (6, 1, [None, 4]), (7, 2, []), (100, 2, []), (200, 3, [-1, -1])]
    table = spark.createDataFrame([(*r, "mine") for r in rows], f"{SCHEMA}, score string")
    got = sorted(map(tuple, negatives.mine(table, "id % 100 = 0").collect()))
    # the repeated anchor is one, its repeated positive two, the repeated negative counts twice
    assert got == plain_negatives(rows) and [r[:4] for r in got if r[0] == 0] == [(0, 1, 1, 2), (0, 1, 1, 2), (0, 1, 2, 2), (0, 1, 2, 2)]
    assert any(r[0] == 100 and r[4] == r[5] == 0 for r in got)
    for none in (table.limit(0), table.where("id = 1")):
        assert negatives.mine(none, "id % 100 = 0").collect() == []


def test_scores_are_exact_and_stay_in_a_long():
    rng = random.Random(4)
    for size in (10, 2**28, 2**30, 2**62):
        a, b = ([[rng.randint(-size, size) for _ in range(6)] for _ in range(5)] for _ in range(2))
        want = [[max(-(2**63 - 1), min(2**63 - 1, sum(x * y for x, y in zip(u, v, strict=True)))) for v in b] for u in a]
        found = negatives.scores(np.array(a), np.array(b))
        assert found.tolist() == want
        mask = np.array([[(i + j) % 2 == 0 for j in range(5)] for i in range(5)])
        rows, at = negatives.first(found, mask, 2)
        for i in range(5):
            assert sorted(at[rows == i].tolist()) == sorted(sorted((j for j in range(5) if mask[i, j]), key=lambda j: (-want[i][j], j))[:2])
