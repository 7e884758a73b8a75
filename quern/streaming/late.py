"""Late data (STR-22), punctuated watermarks (STR-04) with per-record
watermark semantics, computed as distributed prefix maxima over arrival order.

A row's watermark is the largest event time that arrived before it minus the
bound; a row is late for its window when window end - 1 ms + lateness <= that
watermark.  The running maximum comes from
:func:`quern.operators.prefix.prefix_scan` (range-partitioned, no single task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.joins import micros
from quern.operators.prefix import prefix_scan


def tag_late(df: DataFrame, arrival: str, ts: str, bound_ms: int, window_ms: int,
             lateness_ms: int = 0) -> DataFrame:
    """Adds ``watermark_ms`` and ``is_late`` (dropped by a tumbling window of
    ``window_ms`` with the given allowed lateness)."""
    d = df.withColumn("_lt_ms", F.floor(micros(ts) / 1000))
    sc = prefix_scan(d, [], [arrival], row_number=None, maxs={"_lt_max": "_lt_ms"})
    wm = F.col("_lt_max") - F.lit(bound_ms)
    end = F.floor(F.col("_lt_ms") / window_ms) * window_ms + window_ms
    late = (end - 1 + F.lit(lateness_ms)) <= wm
    return sc.withColumn("watermark_ms", wm).withColumn("is_late", late).drop("_lt_ms", "_lt_max")


def punctuated_watermark(df: DataFrame, arrival: str, ts: str, is_mark: Column) -> DataFrame:
    """STR-04: the watermark moves only on marker rows (to their event time);
    adds ``watermark_ms`` = the latest marker time at or before each row."""
    d = df.withColumn("_pm_ms", F.when(is_mark, F.floor(micros(ts) / 1000)))
    sc = prefix_scan(d, [], [arrival], row_number=None, maxs={"watermark_ms": "_pm_ms"})
    return sc.drop("_pm_ms")
