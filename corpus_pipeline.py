"""A training corpus from raw documents: quality rules, line dedup, near-copy removal, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.llm import jaccard, line_dedup, mixing, pieces, quality
from twinfold.llm.common import clean, materialise, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the distance from their language turn down go.

    Null and empty texts have under 10 words and go. Repeated rows go or stay alike. An empty table stays empty.
    """
    return quality.keep_good(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites share go from all but their first place; n_chars follows the text. No document goes.

    A null text stays null with its n_chars; an empty text stays. Repeated rows hold a first place together.
    """
    found = line_dedup.dedup_lines(docs)
    return found.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles or more, that of the least id stays.

    Null and empty texts link with nothing and stay. Of rows alike in doc_id and text one stays.
    """
    return jaccard.keep_one(docs, width=5, p=80, q=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights.

    Null and empty texts have size 0; where a source has nothing else, they aren't taken. Each repeated row counts.
    """
    return mixing.mix(docs)


def sentencepiece_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with their byte offsets, and digests of ids and decoding. Null and empty texts have no ids; each row is encoded."""
    encoded = pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))
    return pieces.digests(encoded, "doc_id", "lang", "source", "ids", "starts", "ends")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", sentencepiece_tokens),
]

#: DuckDB can't run SentencePiece; a test holds the rows against a plain version of all five stages that shares no code with them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = written()
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        clean(spark, written()[len(before) : -1])  # what the stage wrote on its way isn't read again
    return STAGES[-1][1](spark, docs, sf_dir)
