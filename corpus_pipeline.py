"""The corpus pipeline: from documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read
again as the next one's ``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inboxlens.llm import exact_dedup, mixing, near_dups, packing, toxicity
from inboxlens.llm.common import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learned from ``labels`` does not reject."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the largest id, of every group of equal texts."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every class of near copies."""
    return near_dups.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at the same share of characters; a repeated document is a repeated row."""
    return mixing.replicate(docs, seed=7).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and their token ids."""
    return packing.pack(docs, tokenizer=packing.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: The learned lexicon, MinHash and the tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *earlier, (_, last) = STAGES
    for _, stage in earlier:
        docs = settle(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
