"""The registered queries of the subpackage: thin uses of its operators on the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeassay.llm import ann, bpe, common, divergence, htmltext, langid, licensescan, linededup, mixing, quality, rules, simhash, warc, whitening
from lakeassay.llm.licenses import standard_templates


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_shared_lines(_table(spark, sf_dir, "documents"), min_documents=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = _table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs, path), path)
    return found.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licensescan.license_matches(_table(spark, sf_dir, "documents"), standard_templates(), min_coverage=0.8)
    return found.select("doc_id", F.explode("licenses").alias("m")).select("doc_id", "m.*")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    trip = bpe.round_trip(F.col("text"), vocabulary, public_tokenizers.PATTERN)
    return _table(spark, sf_dir, "documents").select("doc_id", trip.alias("r")).select("doc_id", "r.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.base_and_verdict(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"), min_documents=10, top_terms=10)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"), components=16)
    return found.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error",
                        F.posexplode(F.arrays_zip("whitened", "explained")).alias("component", "c")).select(
        "vec_id", (F.col("component") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(_table(spark, sf_dir, "pages"), common.scratch_folder(spark), least_bytes=100)
    return warc.read_records(index, payloads=False).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_line_dedup, op3_mixing, op4_language_id, op5_license_scan, op6_quality, op7_nearest_neighbours, op8_main_text, op9_byte_bpe, op10_quality_rules,
    op11_source_divergence, op12_whitening, op13_warc)}
