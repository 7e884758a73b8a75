"""One line in every document: the joins that carry the repeats back are dealt over many tasks."""

import pytest
from pyspark.sql import functions as F

from quern.llm import line_dedup, substring_dedup

CONF = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16", "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1"}
N = 4_000


@pytest.fixture()
def split(spark):
    """Settings under which small skew counts, and what says whether a result's plan split a join."""
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)

    def was_split(df):
        plan = df._jdf.queryExecution().executedPlan()
        plan.execute().count()
        return "skew=true" in plan.toString()

    yield was_split
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _docs(spark):
    n = F.col("id").cast("string")
    own = [F.concat(F.lit(f"line {k} of its own in document "), n, F.lit(" with words enough to count")) for k in range(3)]
    shared = F.lit("the very same eight words stand in all documents here")
    return spark.range(0, N, 1, 16).select(F.col("id").alias("doc_id"), F.concat_ws("\n", own[0], shared, F.lit("and one more line"), own[1], own[2]).alias("text"))


def test_a_line_of_all_documents_is_split_in_substring_dedup(spark, split):
    spans = substring_dedup.repeated(_docs(spark))
    assert split(spans)
    rows = spans.collect()
    assert len(rows) == N - 1 and {r.kept_doc_id for r in rows} == {0}


def test_a_chunk_of_all_documents_is_split_in_line_dedup(spark, split):
    body = "\n".join(f"line {k} of a passage that all documents hold" for k in range(30))
    docs = _docs(spark).withColumn("text", F.concat("text", F.lit("\n" + body))).withColumn(line_dedup.HASH, F.xxhash64("text"))
    removed = line_dedup.removed_chunks(docs)
    assert split(removed)
    rows = removed.collect()
    assert len(rows) == N - 1 and 0 not in {r.id for r in rows}


def test_lines_of_all_documents_are_split_in_whole_line_dedup(spark, split):
    docs = _docs(spark).withColumn(line_dedup.HASH, F.xxhash64("text"))
    later = line_dedup.later_units(line_dedup.placed_units(docs))
    assert split(later)
    assert later.count() == N - 1
