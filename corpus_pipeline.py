"""From raw documents to a tokenized mix: five stages, each one operator of the llm subpackage.

Quality comes first, so that nothing later learns from junk; shared lines go before near duplicates are
sought, so that documents do not look alike for their boilerplate only; the mix is taken from what is left,
and is tokenized last. Every stage works on all rows the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeassay.llm import bpe, linededup, mixing, quality, simhash
from lakeassay.llm.common import staged

#: Documents below this probability of high quality go.
MIN_QUALITY = 0.7


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not reject."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model, column="__llm_score")
    return scored.where(F.col("__llm_score") >= MIN_QUALITY).drop("__llm_score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    return linededup.drop_shared_lines(docs, min_documents=10).select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return docs.select("doc_id", bpe.round_trip(F.col("text"), vocabulary, public_tokenizers.PATTERN).alias("r")).select("doc_id", "r.*")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: The classifier and the fingerprints cannot be written in SQL; the tests hold all stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written once and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
