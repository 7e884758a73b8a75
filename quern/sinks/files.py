"""Batch and micro-batch writers (SNK-*).

Exactly-once external writes follow one rule: every micro-batch is written
to a staging folder named by its batch id and published by an atomic commit
marker; a replayed batch finds its marker and does nothing.  Readers only see
committed batches.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE_TIME_BUCKET = "yyyy-MM-dd--HH"  # default bucket format (fixed value)
DEFAULT_ROLL_RECORDS = 1_000_000


def write_as_text(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """SNK-02: one line per row (the row's text form)."""
    cols = [F.col(c).cast("string") for c in df.columns]
    line = cols[0] if len(cols) == 1 else F.concat_ws(",", *cols)
    df.select(line.alias("value")).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def write_as_csv(df: DataFrame, path: str, overwrite: bool = False,
                 row_delimiter: str = "\n", field_delimiter: str = ",") -> None:
    """SNK-03."""
    (df.write.mode("overwrite" if overwrite else "errorifexists")
       .option("sep", field_delimiter).option("lineSep", row_delimiter).csv(path))


def bucket_column(ts: str | Column, fmt: str = DATE_TIME_BUCKET) -> Column:
    """SNK-12 date-time bucket assigner."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, fmt)


def write_bucketed(df: DataFrame, path: str, ts: str, fmt: str = DATE_TIME_BUCKET,
                   max_records_per_file: int = DEFAULT_ROLL_RECORDS, fmt_name: str = "parquet") -> None:
    """SNK-12/13: one folder per time bucket, files rolled by record count."""
    (df.withColumn("bucket", bucket_column(ts, fmt))
       .write.mode("append").option("maxRecordsPerFile", max_records_per_file)
       .partitionBy("bucket").format(fmt_name).save(path))


def replace_files(spark: SparkSession, source: str, target: str) -> None:
    """Put the data files of one folder in the places of another's, in order of their names: files that change in place."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def data(folder):
        names = sorted(f.getPath().toString() for f in fs.listStatus(path(folder)))
        return [n for n in names if n.rsplit("/", 1)[-1][0] not in "._"]

    new, old = data(source), data(target)
    if len(new) != len(old):
        raise ValueError(f"{len(new)} files for {len(old)}")
    for n, o in zip(new, old):
        fs.delete(path(o), False)
        fs.rename(path(n), path(o))


class IdempotentBatchWriter:
    """SNK-15/16 two-phase commit for ``foreachBatch``.

    pre-commit: write the batch to ``<path>/_staging/<batch_id>``; commit:
    create ``<path>/_committed/<batch_id>`` (atomic rename of an empty file
    on the shared store); a replayed batch id with a marker is skipped.
    ``read`` returns only committed batches.
    """

    def __init__(self, path: str, fmt: str = "parquet"):
        self.path, self.fmt = path, fmt

    def _marker(self, batch_id: int) -> str:
        return os.path.join(self.path, "_committed", f"{batch_id:020d}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        marker = jvm.org.apache.hadoop.fs.Path(self._marker(batch_id))
        fs = marker.getFileSystem(conf)
        if fs.exists(marker):
            return  # already committed: a replay after failure
        staging = os.path.join(self.path, "_staging", f"{batch_id:020d}")
        batch.write.mode("overwrite").format(self.fmt).save(staging)
        tmp = jvm.org.apache.hadoop.fs.Path(self._marker(batch_id) + ".tmp")
        fs.create(tmp, True).close()
        fs.rename(tmp, marker)

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, "_committed"))
        fs = root.getFileSystem(conf)
        ids = []
        if fs.exists(root):
            ids = [st.getPath().getName() for st in fs.listStatus(root)
                   if not st.getPath().getName().endswith(".tmp")]
        paths = [os.path.join(self.path, "_staging", i) for i in sorted(ids)]
        if not paths:
            if schema is None:
                raise ValueError("nothing committed and no schema given")
            return spark.createDataFrame([], schema)
        reader = spark.read.format(self.fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(paths)
