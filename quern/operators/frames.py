"""Bounded ROWS and RANGE frames without sending a key to one task.

``OVER (PARTITION BY k ORDER BY t ROWS BETWEEN a PRECEDING AND b FOLLOWING)``
as a Spark window function puts every row of a key in one task.  Here:

* ROWS frames (OVR-01/02/04/07/08/12): the prefix scan numbers the rows of each
  key, and rows are grouped into blocks of ``BLOCK`` numbers.  The last ``a``
  rows of a block are copied to the next block and the first ``b`` to the one
  before, so that a window function over (key, block) sees every frame
  whole; copies are dropped behind it.
* RANGE frames (OVR-03): the same with blocks of the order value's range.

The window functions are Spark's own: any type, exact as they are, spilling
when a block is large.  Null keys are one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.prefix import prefix_scan

BLOCK = 1 << 16
_RN, _BLK, _COPY = "_fr_rn", "_fr_block", "_fr_copy"


def _frame(fn: str, col: str, w, spec: tuple) -> Column:
    if fn == "shift":
        offset = int(spec[2])
        default = spec[3] if len(spec) > 3 else None
        return F.lead(col, offset, default).over(w) if offset >= 0 else F.lag(col, -offset, default).over(w)
    frame = w.rowsBetween(int(spec[2]), int(spec[3]))
    if fn == "count_distinct":
        return F.size(F.collect_set(col).over(frame)).cast("long")
    return {"sum": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max}[fn](col).over(frame)


def rows_frame(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               aggs: dict[str, tuple], *, num_slices: int | None = None,
               row_number: str | None = None) -> DataFrame:
    """``aggs``: output -> (fn, column, lo, hi) with fn in sum / count / avg /
    min / max / count_distinct over ROWS BETWEEN lo AND hi (lo <= hi, negative
    = preceding), or (``"shift"``, column, offset[, default]) for LAG / LEAD:
    the default stands outside the key only, a null that is there stays.
    ``row_number`` names a column for the row's number within its key."""
    before = after = 0
    for spec in aggs.values():
        if spec[0] not in ("sum", "count", "avg", "min", "max", "shift", "count_distinct"):
            raise ValueError(f"unsupported frame function {spec[0]}")
        lo, hi = int(spec[2]), int(spec[2] if spec[0] == "shift" else spec[3])
        if lo > hi:
            raise ValueError("frame start after frame end")
        before, after = max(before, -lo), max(after, hi)
    block = max(BLOCK, before + after)
    keys = list(keys)
    scanned = prefix_scan(df, keys, order, row_number=_RN, num_slices=num_slices)
    own, place = F.floor((F.col(_RN) - 1) / block), (F.col(_RN) - 1) % block
    at = lambda b, copy: F.struct(b.alias("b"), F.lit(copy).alias("copy"))
    none = F.array().cast("array<struct<b:bigint,copy:boolean>>")
    places = F.concat(F.array(at(own, False)), F.when(place >= block - before, F.array(at(own + 1, True))).otherwise(none),
                      F.when((place < after) & (own > 0), F.array(at(own - 1, True))).otherwise(none))
    spread = scanned.withColumn("_fr_at", F.explode(places)).select("*", F.col("_fr_at.b").alias(_BLK), F.col("_fr_at.copy").alias(_COPY)).drop("_fr_at")
    w = Window.partitionBy(*keys, _BLK).orderBy(_RN)
    framed = spread.withColumns({out: _frame(spec[0], spec[1], w, spec) for out, spec in aggs.items()}).filter(~F.col(_COPY))
    number = [F.col(_RN).alias(row_number)] if row_number else []
    return framed.select(*[c for c in df.columns if c not in aggs], *aggs, *number)


def range_frame(df: DataFrame, keys: Sequence[str], order: str, lo: int, hi: int, value: str,
                id_col: str, *, count: str = "range_cnt", total: str = "range_sum",
                num_slices: int | None = None) -> DataFrame:
    """``COUNT(value)`` and ``SUM(value)`` over ``RANGE BETWEEN lo AND hi``
    (offsets on a numeric ``order`` column, peers included) per key.

    Values of ``order`` are cut into blocks of the frame's width; a row is
    copied to the (at most three) blocks that hold rows whose frame reaches it, and sums are taken
    inside the frame.  A null order value's frame is the rows that are null too."""
    width = max(hi - lo, 1)
    o = F.col(order).cast("long")
    reach = F.sequence(F.floor((o - hi) / width), F.floor((o - lo) / width))
    # A row's own block may lie outside its reach if the frame doesn't hold the row itself.
    blocks = F.when(o.isNotNull(), F.array_union(reach, F.array(F.floor(o / width)))).otherwise(F.array(F.lit(None).cast("bigint")))
    spread = df.withColumn("_rf_block", F.explode(blocks)).withColumn("_rf_o", o)
    w = Window.partitionBy(*keys, "_rf_block").orderBy("_rf_o").rangeBetween(lo, hi)
    framed = spread.withColumns({count: F.count(value).over(w), total: F.sum(value).over(w)})
    return framed.filter(F.col("_rf_block").eqNullSafe(F.floor(F.col("_rf_o") / width))).drop("_rf_block", "_rf_o")


def dense_ids(df: DataFrame, col: str, out: str, num_slices: int | None = None) -> DataFrame:
    """Exact integer ids for the values of ``col`` (for frame functions that
    need numbers): the distinct values are numbered by the global prefix scan
    and joined back; null stays null."""
    vals = df.select(F.col(col).alias("_di_v")).filter(F.col("_di_v").isNotNull()).distinct()
    ids = prefix_scan(vals, [], ["_di_v"], row_number="_di_id", num_slices=num_slices)
    return df.join(ids, df[col].eqNullSafe(ids["_di_v"]), "left").drop("_di_v").withColumn(
        out, F.col("_di_id").cast("double")).drop("_di_id")
