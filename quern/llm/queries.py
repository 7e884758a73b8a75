"""The registered queries of the training-data operators, over whole tables.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds the
DuckDB query of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import (bpe, decontaminate, filter_audit, fingerprints, jaccard_join, language_id, license_scan, line_dedup, near_dedup,
                       pii, quality, substring_dedup, whitening)
from quern.llm.common import crc_bucket, documents
from quern.llm.oracles import SQL  # noqa: F401
from quern.sources.tables import read_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(documents(spark, sf_dir), keep=["doc_id"]))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    model = quality.train(docs, read_table(spark, sf_dir, "labels"), usable=~held_out)
    return quality.score(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    encoded = bpe.encode(documents(spark, sf_dir), path, pattern, keep=["doc_id"])
    return bpe.digests(bpe.decode(encoded, path))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.summary(decontaminate.search_documents(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated(documents(spark, sf_dir)).drop("text_hash")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_bucket(F.col("doc_id"), 3) == 1
    model = language_id.fit(docs.filter(~held_out))
    return language_id.predict(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find(documents(spark, sf_dir), keep=["doc_id"]))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(documents(spark, sf_dir))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(documents(spark, sf_dir), near_dedup.Rule(shingle=3, percent=85))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(documents(spark, sf_dir).select("doc_id", "text"))


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir), jaccard_join.Rule(shingle=5, percent=80))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_quality_classifier, op3_byte_bpe, op4_decontamination, op5_substring_dedup,
    op6_language_id, op7_pii, op8_fingerprints, op9_minhash_near_dedup, op10_line_dedup,
    op11_ngram_jaccard, op12_whitening, op13_filter_audit,
)}

