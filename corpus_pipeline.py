"""From raw documents to token ids: the stages of the corpus pipeline."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmeter.llm import byte_bpe, hyper_minhash, repetition, source_mixing, span_dedup
from loanmeter.llm.queries import RANKS, table
from loanmeter.llm.shared_tables import stored_alone

NEAR = hyper_minhash.NearRules(shingle=5, percent=80, bands=24, least_estimate=0.57)
"""At the threshold a pair shares no band with a chance of 3e-6, and is below the least estimate with less than 1e-6."""

PASSAGES = (
    span_dedup.SpanRules(keep="first"),
    span_dedup.SpanRules(words=True, length=50, reach=40, keep="first"),
)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return hyper_minhash.keep_one(docs, NEAR)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere; the first copy of a passage stays.

    A passage has 50 words or more, however short they are, or 400 bytes or more, however few words (texts
    without blanks). A document keeps its row even if nothing of its text is left.
    """
    return span_dedup.without_repeats(docs, *PASSAGES).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: a row for each epoch that takes the document."""
    return source_mixing.mixed(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and a digest of what they decode to."""
    coded = byte_bpe.round_trip(docs, byte_bpe.read_ranks(RANKS))
    return coded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

ORACLE_SQL = None
"""SQL cannot express the BPE merges; tests compare the stages with plain Python versions instead."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        # A stage's own tables go when its result is written; nothing else reads them.
        docs = stored_alone(spark, partial(stage, spark, docs, sf_dir), name)
    return docs
