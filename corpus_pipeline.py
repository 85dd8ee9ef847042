"""Corpus pipeline: quality rules, toxicity, near duplicates, mixing, encoding.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns they were given.
Models are learned from the rows of ``labels`` whose documents are still there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import minhash, mixing, quality, spm, toxicity
from ledgerflow.llm.common import fold, read_table, shared_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs, quality.fit_quality(docs, read_table(spark, sf_dir, "labels")))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold."""
    labels = read_table(spark, sf_dir, "labels")
    return toxicity.keep_clean(docs, toxicity.fit_toxicity(docs, labels, learn=lambda c: fold(c, 5) != 0))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return minhash.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with their digests."""
    return spm.encode_digests(docs, keep_ids=True)


STAGES = [("quality rules", quality_rules), ("toxicity", toxicity_filter), ("MinHash near-dedup", near_dedup),
          ("mixing sources", mix_sources), ("SentencePiece encoding", encode)]

#: Learned models, hashed signatures and the tokenizer have no SQL form; tests
#: hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = shared_table(docs, f"stage-{at}")
    return docs
