"""Run a streaming plan to completion and hand back its result as a table.

Results go through ``foreachBatch`` into a parquet table under the shared
checkpoint folder (never into driver memory); the query's own checkpoint is
there too.  Each micro-batch has a folder of its own, so a batch that is run
again is not counted twice.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import ensure_stateful_conf, scratch_path


#: Most state partitions a core: each opens and commits its stores in every micro-batch, with rows or without, and a second round of
#: tasks costs as much again.
PARTITIONS_A_CORE = 1


@contextmanager
def state_partitions(spark: SparkSession):
    """Streams started inside have the session's number of shuffle partitions, but at most ``PARTITIONS_A_CORE`` for each core.
    A stream keeps the number it was started with."""
    key = "spark.sql.shuffle.partitions"
    own = spark.conf.get(key)
    spark.conf.set(key, min(int(own), PARTITIONS_A_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, own)


def drop_flush(df: DataFrame, ts: str) -> DataFrame:
    """Remove the end-of-input rows after the watermark has seen them.

    The predicate mentions the event-time column on purpose: Catalyst pushes
    filters that do not reference it below the watermark node, and the
    watermark would then never see the end-of-input time."""
    if "_eoi" in df.columns:
        keep = F.col("_eoi").isNull() | ~F.col("_eoi") | F.col(ts).isNull()
        return df.filter(keep).drop("_eoi")
    return df


def order_by(df: DataFrame, *cols: str, ascending: bool = True) -> DataFrame:
    """A global sort of a stream's aggregate.  Spark samples a sort's input in a job of its own, which would open and commit the
    aggregate's state a second time in every micro-batch; the rows are exchanged first, and both jobs read that one exchange.  It is by
    the columns of the sort: by the aggregate's keys Spark would leave it out."""
    return df.repartition(*cols).orderBy(*cols, ascending=ascending)


def run_to_table(df: DataFrame, output_mode: str = "append", *, spark: SparkSession | None = None,
                 trigger_once: bool = False, with_batch_id: bool = False) -> DataFrame:
    """Start ``df`` (a streaming frame), process all available input, stop,
    and return everything it emitted as a batch DataFrame.

    ``with_batch_id`` keeps the micro-batch id, so update-mode results can be
    reduced to the final value per key by the caller.
    """
    spark = spark or df.sparkSession
    ensure_stateful_conf(spark)
    out_path = scratch_path(spark, "stream_out")
    ck = scratch_path(spark, "stream_ck")
    schema = df.schema
    spark.createDataFrame([], schema).write.parquet(f"{out_path}/_batch_id=-1")  # so that there is a table if nothing is emitted

    def sink(batch: DataFrame, batch_id: int) -> None:
        # A batch that is run again after a failure replaces what it wrote before.
        batch.write.mode("overwrite").parquet(f"{out_path}/_batch_id={batch_id}")

    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", ck).foreachBatch(sink)
    if trigger_once:
        w = w.trigger(availableNow=True)
    with state_partitions(spark):
        q = w.start()
    try:
        if trigger_once:
            q.awaitTermination()
        else:
            q.processAllAvailable()
    finally:
        q.stop()
    if q.exception() is not None:
        raise q.exception()
    from pyspark.sql.types import LongType, StructField, StructType
    full = StructType(list(schema.fields) + [StructField("_batch_id", LongType())])
    res = spark.read.schema(full).parquet(out_path)
    return res if with_batch_id else res.drop("_batch_id")


def final_by_key(df: DataFrame, keys: list[str], batch_col: str = "_batch_id") -> DataFrame:
    """Update-mode results: the last emitted row of every key."""
    cols = [c for c in df.columns if c not in keys and c != batch_col]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(batch_col)).alias("_last"))
    return agg.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in cols])
