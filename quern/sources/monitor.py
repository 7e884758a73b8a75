"""SRC-06 continuous mode: a folder watched for new and changed files.

Spark's file source reads each path once; here a file that changes is read again, whole.  ``discover`` lists the folder
through Spark (the binary file source without its content opens no file), joins the listing to the log of what was seen
before and appends the new and changed files to the log; the log is itself a stream of Parquet files, so Spark's own offsets
and checkpoint say which entries have been read, also after a restart.  ``monitor`` reads the files that a micro-batch of the
log names with Spark's reader and hands them to a sink under the batch's id.

A file counts as changed if its modification time or length is not that of its last entry, in either direction.  A file that
is gone when its turn comes is skipped; one that changes between listing and reading is read in its new form and, being
changed, once more.  Files whose names begin with ``.`` or ``_`` are ignored, as in every Spark source.  The log grows by a row a
file version; an empty folder and a round without changes add nothing."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "path string, modified timestamp, length long, round long"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, modified, length of the files below a folder whose names match a glob."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
            .option("ignoreMissingFiles", "true").load(folder)
            .select("path", F.col("modificationTime").alias("modified"), "length"))


def discover(spark: SparkSession, folder: str, log: str, pattern: str = "*", files_per_batch: int = 10_000) -> bool:
    """Append the new and changed files of ``folder`` to ``log``; true if there were any.

    A log file holds at most ``files_per_batch`` entries.  If the append fails half way, the entries that did not get there
    are found again by the next call."""
    now = listing(spark, folder, pattern)
    if _exists(spark, log):
        log_rows = spark.read.schema(LOG).parquet(log)
        number = (log_rows.agg(F.max("round")).first()[0] or 0) + 1
        last = log_rows.groupBy("path").agg(F.max_by(F.struct("modified", "length"), "round").alias("seen"))
        now = (now.join(last, "path", "left")
               .filter(~F.struct("modified", "length").eqNullSafe(F.col("seen"))).drop("seen"))
    else:
        number = 1
    if now.isEmpty():
        return False
    (now.withColumn("round", F.lit(number).cast("long")).write.mode("append")
        .option("maxRecordsPerFile", files_per_batch).parquet(log))
    return True


def monitor(spark: SparkSession, folder: str, fmt: str, schema, sink: Callable[[DataFrame, int], None], state: str, *,
            pattern: str = "*", options: dict[str, str] | None = None, files_per_batch: int = 10_000,
            rounds: int | None = None, interval: float = 60.0) -> None:
    """Read ``folder`` as it grows and changes: ``sink(rows, batch_id)`` gets each batch of whole files.

    ``state`` is a folder on shared storage that holds the log and the checkpoint; a later call with the same one goes on where
    this one ended.  ``rounds`` ends the watch after so many listings (``None``: never); they are ``interval`` seconds apart.
    A batch that is run again after a failure has the same id and names the same files, so a sink that writes
    under the id (``sinks.files.IdempotentBatchWriter``) keeps each version of a file once."""
    log = f"{state}/log"

    def read(batch: DataFrame, batch_id: int) -> None:
        # one log file a batch: at most files_per_batch names reach the driver, as for any list of input files
        paths = sorted({r.path for r in batch.select("path").collect()})
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths if _exists(spark, p)]
        if paths:
            sink(spark.read.format(fmt).schema(schema).options(**(options or {})).load(paths), batch_id)

    done = 0
    while rounds is None or done < rounds:
        if done:
            time.sleep(interval)
        discover(spark, folder, log, pattern, files_per_batch)
        if _exists(spark, log):
            (spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(log).writeStream.foreachBatch(read)
                  .option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start().awaitTermination())
        done += 1
