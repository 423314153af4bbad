"""Odd rows by value, and extra columns whose names clash with the operators' own."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from twinfold.llm import jaccard, licenses, line_dedup, media, mixing, pieces, quality, records, secrets, toxicity
from twinfold.llm.common import new_path

CLASHING = (
    "k1 k2 row row# text_ size copies payload ids starts ends decoded gone n_lines n_removed kept base_failed n_words word_chars spans matches x "
    "component_id part node start n_tokens media n_bytes chars common line h1 h2 pos doc site hits owner value score __k1 __k2 __size __copies __lang __text __n_lines a.b"
).split()
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
SPM, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    (1, None, None, None), (2, "", "en", "s1"), (3, " \n\t\n", "xx", None), (4, LONG, "en", "s1"), (5, "twice the same text in these rows, word for word, again", "en", "s1"), (5, "twice the same text in these rows, word for word, again", "en", "s1"),
    (6, "twice the same text in these rows, word for word, again", "fr", "s2"), (None, "password=abcdefgh12 ünï 日本", "de", "s2"), (7, "Licensed under the Apache License, Version 2.0.\nline two", "fr", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    plain = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string")
    return plain.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(c) for c in CLASHING]).cache()


def by_text(df, *columns):
    """{(doc_id, text): [values]}"""
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in columns))
    return {k: sorted(v, key=str) for k, v in out.items()}


def extras(df):
    return sorted((str(r["doc_id"]), *[r[c] for c in CLASHING]) for r in df.collect())


def test_extra_columns_come_back_unharmed(odd):
    everything = extras(odd)
    for found, ids in ((line_dedup.dedup_lines(odd), None), (quality.keep_good(odd), {"4", "5", "6"}), (jaccard.keep_one(odd), None), (mixing.mix(odd), None)):
        assert set(extras(found)) <= set(everything) and found.columns[: len(odd.columns)] == odd.columns
        if ids:
            assert {r[0] for r in extras(found)} == ids
    assert extras(line_dedup.dedup_lines(odd)) == everything and line_dedup.dedup_lines(odd).columns[-2:] == ["n_lines_", "n_removed_"]
    kept = pieces.encode_decode(odd, SPM, keep=("doc_id", "ids"))
    assert kept.columns == ["doc_id", "ids", "ids_", "starts", "ends", "decoded"] and {r["ids"] for r in kept.collect()} == {r["ids"] for r in odd.collect()}
    judged = quality.judged(odd, keep=("doc_id", "kept", "__lang"))
    assert "kept_" in judged.columns and {r["kept"] for r in judged.collect()} == {r["kept"] for r in odd.collect()}
    stored = media.read(media.store(odd).withColumns({"payload": F.lit("mine"), "c0": F.lit("c")}))
    assert {(r["payload"], r["c0"], r["intact"]) for r in stored.collect()} == {("mine", "c", True)} and "payload_" in stored.columns
    for found in (secrets.scan(odd), licenses.scan(odd), jaccard.classes(odd), mixing.planned(odd)):
        assert found.count() == len(TEXTS)
    model = toxicity.fit(toxicity.labelled_rows(odd, odd.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))))
    assert toxicity.score(odd, model).count() == toxicity.score(odd, model, held_grams=0).count() == len(TEXTS)


def test_toxicity_values(odd):
    model = toxicity.fit(toxicity.labelled_rows(odd, odd.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))))
    got = by_text(toxicity.score(odd, model), "score", "difference")
    assert got[1] == got[2] == got[3] and got[1][0][1] == 0 and got[5][0] == got[5][1] == got[6][0]


def test_secret_and_licence_values(odd):
    got = by_text(secrets.scan(odd), "spans")
    assert [(s["kind"], s["start"], s["end"]) for s in got[None][0][0]] == [("assign", 0, 19)] and all(v == [([],)] * len(v) for k, v in got.items() if k)
    got = by_text(licenses.scan(odd), "matches")
    assert [(m["license"], m["start"], m["end"]) for m in got[7][0][0]] == [("Apache-2.0 notice", 0, 47), ("Apache-2.0 notice", 0, 56)] and all(v == [([],)] * len(v) for k, v in got.items() if k != 7)


def test_audio_values(odd):
    got = by_text(media.read(media.store(odd)), "n_bytes", "payload", "intact")
    for doc_id, text, *_ in TEXTS:
        raw = (text or "").encode()
        assert (len(raw), bytearray(raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")), True) in got[doc_id]
    assert len(got[5]) == 2 and media.read(media.store(odd).withColumn("media", F.lit(None).cast("binary"))).where("n_frames = 0").count() == len(TEXTS)


def test_line_dedup_values(spark, odd):
    got = by_text(line_dedup.dedup_lines(odd, min_sites=2), "text", "n_lines_", "n_removed_")
    same = TEXTS[4][1]
    assert got[1] == [(None, 0, 0)] and got[2] == [("", 1, 0)] and got[3] == [(" \n\t\n", 3, 0)] and got[4] == [(LONG, 1, 0)]
    assert got[5] == [(same, 1, 0)] * 2 and got[6] == [("", 1, 1)] and got[7][0][1:] == (2, 0)
    # at least eight sites, near the threshold: a tie of ids goes to the least line
    rows = [(1, "a\nbanner\nbanner", f"s{i}") for i in range(8)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r["text"] for r in got.collect()} == {"a\nbanner"}


def test_quality_values(odd):
    got = by_text(quality.judged(odd, keep=("doc_id",)), "n_words", "base_failed", "char_distance", "kept")
    assert got[1] == got[2] == [(0, True, None, False)] and got[3][0][:2] == (0, True) and got[5] == [(11, False, None, True)] * 2 and got[4][0][0] == 30_000


def test_mixing_values(odd):
    got = {}
    for r in mixing.planned(odd).collect():
        got.setdefault(r["row"]["doc_id"], []).append((r["size"], r["source_size"]))
    assert got[1] == [(0, 9)] and got[2] == [(0, 30_022)] and got[3] == [(0, 9)] and got[5] == [(11, 30_022)] * 2 and got[None] == [(3, 14)] and got[7] == [(9, 9)]
    assert all(0 <= r["copies"] <= 3 for r in mixing.planned(odd).collect())


def test_sentencepiece_values(odd):
    got = by_text(pieces.encode_decode(odd, SPM, keep=("doc_id", "text")), "ids", "starts", "ends", "decoded")
    assert got[1] == got[2] == [([], [], [], "")] and got[3][0][3] == " \n\t\n" and len(got[5]) == 2 and got[5][0] == got[5][1] == got[6][0] and got[4][0][2][-1] == len(LONG)


def test_jaccard_values(odd):
    got = by_text(jaccard.classes(odd), "n_shingles", "component_id")
    assert got[1] == [(0, 1)] and got[2] == [(0, 2)] and got[3] == [(0, 3)] and got[5] == [(7, 5)] * 2 and got[6] == [(7, 5)] and got[None] == [(1, None)] and got[4] == [(29_996, 4)]
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in jaccard.keep_one(odd).collect())
    assert [k for k, _ in kept] == [0, 1, 2, 3, 4, 5, 7]


def test_record_values(spark, odd):
    folder = new_path(spark, "records")
    got = records.read(spark, folder, records.write(odd, folder, WORDS)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 5, 6, 7] and [r["n_tokens"] for r in got][1:4] == [1, 1, 1]
    assert all(np.frombuffer(r["ids"], dtype="<u4")[-1] == 2 and len(r["ids"]) == 4 * r["n_tokens"] for r in got)
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got][:-1]]).tolist() and zlib.crc32(got[5]["ids"]) == zlib.crc32(got[6]["ids"])
    assert hashlib.sha256(got[5]["ids"]).digest() == hashlib.sha256(got[7]["ids"]).digest()
