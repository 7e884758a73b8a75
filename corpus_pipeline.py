"""Corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
stage's rows as Parquet and reads them again as the next stage's ``docs``.  All stages but the last return the columns of ``documents``.

Columns of ``documents`` beyond the known ones pass every stage, whatever their names.  Rows of a null id pass the stages that work by id; null and empty texts pass like any other that no stage rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from quern.llm.common import crc_bucket, documents, written
from quern.sources.tables import read_table

#: Near duplicates: five-word shingles, similarity 0.8.
NEAR = near_dedup.Rule(shingle=5, percent=80)


def free(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as make it no column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, scores 0.7 or more."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"), usable=crc_bucket(F.col("doc_id"), 4) != 2)
    name = free(docs, "score")
    scored = quality.score(docs, model, name=name)
    return scored.filter(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the content-defined chunks of lines, compared byte by byte, and the other passages of two lines or more that an
    earlier place has; documents of which nothing is left go.
    Near copies, by the next stage's rule, that share lines with their first copy go here, while they can be told."""
    lines, removed = free(docs, "n_lines"), free(docs, "n_removed")
    left = line_dedup.dedup_whole(docs, counts=(lines, removed), near=(NEAR.shingle, NEAR.percent), chunks=True)
    left = left.filter(F.col("text").isNull() | (F.col("text") != "") | (F.col(removed) == 0))
    n_chars = F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return left.select(*[n_chars.alias(c) if c == "n_chars" else left[f"`{c}`"] for c in docs.columns])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8), that of the smallest id; of
    rows equal in id and text, one."""
    found = near_dedup.components(docs, NEAR)
    kept = found.filter("kept and doc_id is not null").select("doc_id").distinct()
    text_hash, place = free(docs, "text_hash"), free(docs, "place")
    hashed = docs.withColumn(text_hash, F.xxhash64("text"))
    same = Window.partitionBy("doc_id", text_hash).orderBy(text_hash)
    one = hashed.join(kept, "doc_id", "left_semi").withColumn(place, F.row_number().over(same)).filter(F.col(place) == 1)
    return one.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated.  That depends on the text alone, so texts are named by their hash here."""
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    found = decontaminate.search_documents(texts, read_table(spark, sf_dir, "benchmark"))
    text_hash = free(docs, "text_hash")
    gone = decontaminate.summary(found).filter("contaminated").select(F.col("doc_id").alias(text_hash)).distinct()
    return docs.withColumn(text_hash, F.xxhash64("text")).join(gone, text_hash, "left_anti").select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 and decoded_sha256."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    # Written between the two, so that a task never holds an encoding and a decoding worker at once.
    encoded = written(bpe.encode(docs.select("doc_id", "text"), path, pattern, keep=["doc_id"]))
    return bpe.digests(bpe.decode(encoded, path), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: The classifier and the tokenizer can't be expressed in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
