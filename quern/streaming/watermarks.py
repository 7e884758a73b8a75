"""Watermarks and time attributes (STR-01..05, SET-18)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WM = re.compile(
    r"WATERMARK\s+FOR\s+(\w+)\s+AS\s+(\w+)(?:\s*-\s*INTERVAL\s+'(\d+)'\s+(\w+))?", re.I)


def parse_watermark(spec: str) -> tuple[str, str]:
    """``WATERMARK FOR ts AS ts - INTERVAL '5' SECOND`` -> ("ts", "5 seconds")."""
    m = _WM.search(spec)
    if not m:
        raise ValueError(f"not a watermark clause: {spec}")
    col, _, n, unit = m.groups()
    if n is None:
        return col, "0 seconds"
    unit = unit.lower().rstrip("s") + "s"
    return col, f"{n} {unit}"


def with_computed_columns(df: DataFrame, computed: dict[str, str],
                          watermark: str | None = None) -> DataFrame:
    """SET-18 / STR-05: computed columns ``name AS expr`` and a WATERMARK
    clause.  On a streaming frame the watermark is attached; on a bounded
    table it has no effect."""
    out = df.withColumns({k: F.expr(v) for k, v in computed.items()})
    if watermark:
        col, delay = parse_watermark(watermark)
        out = out.withColumn(col, F.col(col).cast("timestamp"))
        if out.isStreaming:
            out = out.withWatermark(col, delay)
    return out


def bounded_out_of_orderness(df: DataFrame, ts: str, bound: str) -> DataFrame:
    """STR-02: watermark = max event time seen - bound (never decreases)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, bound)


def ascending_timestamps(df: DataFrame, ts: str) -> DataFrame:
    """STR-03: timestamps arrive in order, watermark = max - 0."""
    return bounded_out_of_orderness(df, ts, "0 seconds")
