"""A bounded table that arrives as a stream of Parquet files, in an order of its own.

The rows are written to the shared folder in slices of the arrival order, one after another, and read by Spark's file
source a slice a micro-batch: offsets, file listing and decoding are Spark's, and so is the watermark, which
moves from slice to slice.  Rows may lie anywhere in event time: arrival order is what counts.

A trigger takes a fixed number of files, so every slice has as many: one of a small table, of a larger one as many as
the longest slice needs at ``FILE_ROWS`` rows each, at most one a core.  They are written, and read again, side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import scratch_path

#: Rows of a slice's file, as long as there are cores for more files.
FILE_ROWS = 100_000


def arrive(df: DataFrame, order: str, bounds: Sequence[float], closing: DataFrame | None = None) -> DataFrame:
    """``df`` as a stream: the rows with ``order`` below the first bound, then those below the second, and so on, then the
    rest, a micro-batch each.  ``closing`` (rows of the same columns, such as one far in the future for a final
    watermark) comes in two more micro-batches, so that the second runs under the watermark of the first."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "arrival")
    edges = [None, *bounds, None]
    within = [(F.lit(True) if low is None else F.col(order) >= low) & (F.lit(True) if high is None else F.col(order) < high)
              for low, high in zip(edges[:-1], edges[1:])]
    longest = df.agg(*[F.count_if(w).alias(f"n{k}") for k, w in enumerate(within)]).first()
    files = max(1, min(spark.sparkContext.defaultParallelism, -(-max(longest) // FILE_ROWS)))
    parts = [*[df.filter(w) for w in within], *([closing] * 2 if closing is not None else [])]
    nothing = spark.createDataFrame([], df.schema).coalesce(1)
    for k, part in enumerate(parts):
        rows, at = part.select(*df.columns), f"{path}/slice={k:06d}"
        (rows.repartition(files) if files > 1 else rows.coalesce(1)).write.parquet(at)
        # A task without rows writes no file: empty ones stand in for those.
        for _ in range(files - len(spark.read.schema(df.schema).parquet(at).inputFiles()) if files > 1 else 0):
            nothing.write.mode("append").parquet(at)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(path)
