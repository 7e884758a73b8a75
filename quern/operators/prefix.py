"""Per-key prefix scans (row number, running sum / min / max) that stay
balanced when one key holds a large share of all rows.

A window function ``PARTITION BY key ORDER BY t`` sends every row of a key to
one task, so a key with a third of the data becomes a third of the job on
one core.  Here the rows are cut into slices of the order (hash of the key,
order columns), so a hot key is cut into many contiguous slices:

1. slice bounds come from a sample of those columns (a few rows a slice reach
   the driver) and become part of the plan, so that a row's slice is a
   function of the row alone: however often a branch of the plan is run,
   or a lost task run again, it finds the same slices;
2. window functions over (slice, key) give the local prefix values;
3. totals for each (slice, key) are partial aggregates; a key only continues
   from an earlier slice at a slice's first key hash, so of the totals only those of
   each slice's first and last key hash matter: a few rows a slice, broadcast
   with that bound;
4. final value = local value combined with what the earlier slices carry in.

Everything runs in the JVM, keys are compared null-safe (null keys are one
key), and values keep their types.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PID = "_q_pid"
_HASH = "_q_hash"
#: Sampled rows for each slice.
SAMPLE = 20
_PLAIN = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def num_slices_of(df: DataFrame, n: int | None) -> int:
    return int(n or df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("long")


def _turned(c: Column, kind: T.DataType) -> Column:
    """A column that rises where ``c`` falls, nulls last.  A rounded double doesn't break the order: equal values share a slice."""
    if isinstance(kind, T.StringType):  # byte by byte; the end of a string comes behind any byte, a null behind both
        return F.coalesce(F.concat(F.translate(F.hex(c.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G")), F.lit("H"))
    if isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, T.TimestampNTZType):
        c = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast(kind), c)
    elif isinstance(kind, T.BooleanType):
        c = c.cast("int")
    return F.coalesce(-c.cast("double"), F.lit(float("inf")))


def _rising(df: DataFrame, order: Sequence[str | Column]) -> list[Column]:
    """The leading order columns as columns that rise in the order; those behind
    one of an unknown order are left out (their rows then share a slice)."""
    out = []
    for o in order:
        m = re.fullmatch(r"Column<'(.+?)(?: (ASC|DESC) NULLS (FIRST|LAST))?'>", str(o)) if isinstance(o, Column) else None
        name, falls, last = (o, False, False) if isinstance(o, str) else (m[1], m[2] == "DESC", m[3] == "LAST") if m else (None, False, False)
        kind = df.schema[name].dataType if name in df.columns else None
        if not isinstance(kind, _PLAIN):
            break
        if last != falls:  # nulls at the other end than Spark's default
            out.append(F.col(name).isNull() if last else F.col(name).isNotNull())
        out.append(_turned(F.col(name), kind) if falls else F.col(name))
    return out


def _in_order(values: tuple) -> tuple:
    """Sort key of sampled values in Spark's ascending order: nulls first, NaN last."""
    return tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in values)


def with_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """Adds ``_q_pid``, 0 to n - 1, which never falls in the order of a key, and ``_q_hash``, the key's hash."""
    if _PID in df.columns:
        return df  # sliced by an earlier scan in the same order
    df = df.withColumn(_HASH, key_hash(keys))
    place = F.struct(F.col(_HASH).alias("c0"), *[c.alias(f"c{i + 1}") for i, c in enumerate(_rising(df, order))])
    places = df.select(place.alias("p"))
    total = places.count() if n > 1 else 0
    if not total:
        return df.withColumn(_PID, F.lit(0))
    some = places if total <= SAMPLE * n else places.sample(SAMPLE * n / total, seed=17)
    sample = sorted((tuple(r.p) for r in some.collect()), key=_in_order)  # about SAMPLE rows a slice
    chosen = list(dict.fromkeys(sample[len(sample) * k // n] for k in range(1, n))) if sample else []
    if not chosen:
        return df.withColumn(_PID, F.lit(0))
    fields = places.schema["p"].dataType.fields
    bounds = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, fields)]) for b in chosen])
    # Binary search: how many bounds lie at or below the row, whose place is worked out once.
    step = lambda at: lambda a, _: F.when(a["lo"] >= a["hi"], a).otherwise(
        F.when(F.get(bounds, F.floor((a["lo"] + a["hi"]) / 2).cast("int")) <= at, F.struct((F.floor((a["lo"] + a["hi"]) / 2) + 1).cast("int").alias("lo"), a["hi"].alias("hi")))
        .otherwise(F.struct(a["lo"].alias("lo"), F.floor((a["lo"] + a["hi"]) / 2).cast("int").alias("hi"))))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(chosen)).alias("hi"))
    slice_of = lambda at: F.aggregate(F.sequence(F.lit(0), F.lit(len(chosen).bit_length())), start, step(at), lambda a: a["lo"])
    return df.withColumn(_PID, F.transform(F.array(place), slice_of)[0])


def prefix_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                *, row_number: str | None = "rn",
                sums: dict[str, str] | None = None,
                mins: dict[str, str] | None = None,
                maxs: dict[str, str] | None = None,
                maxs_before: dict[str, str] | None = None,
                num_slices: int | None = None, keep_slices: bool = False) -> DataFrame:
    """Add per-key running values in ``order`` (which must be a total order
    within a key: include a unique column as the last tie-breaker).

    ``sums`` / ``mins`` / ``maxs`` map output column -> input column.  An empty
    ``keys`` gives a global prefix (one stream, as for a global watermark).
    Running sums of decimals are decimals (exact), others doubles; nulls count
    as 0 for sums and are ignored by min / max, which keep the column's type.
    ``maxs_before`` are maxima over the rows strictly before (null at a key's first).
    ``keep_slices`` leaves the slice columns for a next scan in the same order.
    """
    sums, mins, maxs, earlier = sums or {}, mins or {}, maxs or {}, maxs_before or {}
    keys = list(keys)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    sliced = with_slices(df, keys, order, num_slices_of(df, num_slices))
    number = lambda c: F.coalesce(F.col(c), F.lit(0)) if isinstance(df.schema[c].dataType, T.DecimalType) else F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    running = {"_q_rn": F.count(F.lit(1)), **{f"_q_{o}": F.sum(number(c)) for o, c in sums.items()},
               **{f"_q_{o}": F.min(c) for o, c in mins.items()}, **{f"_q_{o}": F.max(c) for o, c in {**maxs, **earlier}.items()}}

    here = Window.partitionBy(_PID, *keys).orderBy(*cols)
    local = sliced.withColumns({name: f.over(here.rowsBetween(Window.unboundedPreceding, -1 if name[3:] in earlier else 0)) for name, f in running.items()})

    totals = sliced.groupBy(_PID, _HASH, *keys).agg(*[f.alias(name) for name, f in running.items()])
    slice_ = Window.partitionBy(_PID)
    at_edge = totals.withColumns({"_q_low": F.min(_HASH).over(slice_), "_q_high": F.max(_HASH).over(slice_)}) \
        .filter((F.col(_HASH) == F.col("_q_low")) | (F.col(_HASH) == F.col("_q_high")))
    before = Window.partitionBy(_HASH, *keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    fold = lambda name: F.min(name) if name[3:] in mins else F.max(name) if name[3:] in maxs or name[3:] in earlier else F.sum(name)
    carried = at_edge.select(F.col(_PID).alias("_q_c_pid"), *[F.col(k).alias(f"_q_k{i}") for i, k in enumerate(keys)],
                             *[fold(name).over(before).alias(f"_q_c{name}") for name in running]).filter("_q_c_q_rn is not null")

    same = F.col(_PID) == F.col("_q_c_pid")
    for i, k in enumerate(keys):
        same = same & local[k].eqNullSafe(carried[f"_q_k{i}"])
    joined = local.join(F.broadcast(carried), same, "left")
    outs = [(F.col("_q_rn") + F.coalesce("_q_c_q_rn", F.lit(0))).alias(row_number)] if row_number else []
    outs += [(F.col(f"_q_{o}") + F.coalesce(F.col(f"_q_c_q_{o}"), F.lit(0))).alias(o) for o in sums]
    outs += [F.least(f"_q_{o}", f"_q_c_q_{o}").alias(o) for o in mins]
    outs += [F.greatest(f"_q_{o}", f"_q_c_q_{o}").alias(o) for o in [*maxs, *earlier]]
    slices = [_PID, _HASH] if keep_slices else []
    return joined.select(*[local[c] for c in df.columns if c not in (_PID, _HASH)], *[local[c] for c in slices], *outs)
