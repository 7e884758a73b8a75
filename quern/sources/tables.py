"""Bounded sources (SRC-*): table scans, literal rows, ranges, text files.

Every reader returns a lazy DataFrame so Catalyst can push projections and
filters into the parquet scan (``ReadSchema`` / ``PushedFilters``).
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """SRC-14 batch table scan; ``columns`` only documents the projection,
    Catalyst prunes the scan to what the plan uses either way."""
    from quern.session import ship_package, use_utc
    ship_package(spark)
    use_utc(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str,
                   names: Iterable[str] = TABLES) -> None:
    """Expose the tables to ``spark.sql`` under their own names (SET-22)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def as_table(df: DataFrame, names: Sequence[str] | None = None, *,
             rowtime: str | None = None, proctime: str | None = None,
             watermark_delay: str | None = None,
             view: str | None = None) -> DataFrame:
    """SRC-19 stream/table to table: rename columns, mark the time attribute.

    ``rowtime`` names an existing column that becomes the event-time
    attribute (cast to TIMESTAMP, the type ``withWatermark`` requires); on
    a streaming frame a watermark with ``watermark_delay`` is attached.
    ``proctime`` appends a processing-time column.
    """
    if names:
        df = df.toDF(*names)
    if rowtime:
        df = df.withColumn(rowtime, F.col(rowtime).cast("timestamp"))
        if df.isStreaming:
            df = df.withWatermark(rowtime, watermark_delay or "0 seconds")
    if proctime:
        df = df.withColumn(proctime, F.current_timestamp())
    if view:
        df.createOrReplaceTempView(view)
    return df


def from_elements(spark: SparkSession, rows: Sequence, schema) -> DataFrame:
    """SRC-01/02/17 literal rows (``fromElements``, ``fromCollection``, VALUES)."""
    return spark.createDataFrame(list(rows), schema)


def generate_sequence(spark: SparkSession, start: int, end: int,
                      num_partitions: int | None = None) -> DataFrame:
    """SRC-03/04 inclusive long range, split into parallel slices."""
    return spark.range(start, end + 1, 1, num_partitions).withColumnRenamed(
        "id", "value")


def read_text_file(spark: SparkSession, path: str,
                   charset: str = "UTF-8") -> DataFrame:
    """SRC-05 one row per line (column ``value``)."""
    return spark.read.option("encoding", charset).text(path)


def connect(spark: SparkSession, fmt: str, path: str | None = None, *,
            schema: T.StructType | str | None = None,
            options: dict[str, str] | None = None, streaming: bool = False,
            view: str | None = None) -> DataFrame:
    """SRC-09/18 connector descriptor: format + schema + options [+ view]."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    df = reader.load(path) if path else reader.load()
    if view:
        df.createOrReplaceTempView(view)
    return df


def kafka_reader_options(servers: str, topic: str, group: str | None = None,
                         start: str = "latest") -> dict[str, str]:
    """SRC-12 Kafka source settings (topic, group, start from latest)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": start}
    if group:
        opts["kafka.group.id"] = group
    return opts


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-15 a table file as a file stream (schema fixed up front).

    The glob keeps the file source from treating the file as a base
    directory; the schema comes from the batch reader, never inferred per
    micro-batch.
    """
    schema = spark.read.parquet(table_path(sf_dir, name)).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(table_path(sf_dir, name)[:-1] + "[t]")


def event_time(c: str | Column) -> Column:
    """SRC-16 rowtime extractor: long millis, timestamp or text to TIMESTAMP."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


def millis_to_ts(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_millis(c)
