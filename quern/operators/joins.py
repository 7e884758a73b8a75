"""Joins Spark has no single operator for (JOI-12..17, 22, 23).

Time-bounded joins are bucketed range joins: rows are hashed on
(key, time bucket) so that one hot key is spread over many tasks instead of
one; each left row probes only the buckets its interval can reach.  The
as-of (temporal) join is a running max of version times followed by an
equi-join, so no key is ever held in memory as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.prefix import prefix_scan

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros(ts: str | Column) -> Column:
    """Zone-independent microseconds since the epoch of a timestamp column."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), c.cast("timestamp_ntz"))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  left_ts: str, right_ts: str, lower_us: int, upper_us: int, *,
                  lower_inclusive: bool = True, upper_inclusive: bool = True,
                  how: str = "inner", bucket_us: int | None = None) -> DataFrame:
    """Rows with equal keys and ``l.ts + lower <= r.ts <= l.ts + upper``.

    ``how`` is inner / left / right / full; outer rows are null-padded.  The
    result keeps both sides' columns (right-side names must not collide).
    """
    # The bucket width is the interval's length.  Exactly one side is copied into the (at most two) buckets from
    # which the other side's rows reach it; the side that stays whole can then
    # be the outer one of a native join.  An empty interval (upper < lower) has no buckets.
    width = max(bucket_us or (upper_us - lower_us), 1)
    lm, rm = micros(left_ts), micros(right_ts)
    none = F.array().cast("array<bigint>")
    reached = lambda first, last: F.explode_outer(F.when(first <= last, F.sequence(F.floor(first / width), F.floor(last / width))).otherwise(none))
    l_one, r_one = left.withColumn("_ij_b", F.floor(lm / width)), right.withColumn("_ij_b", F.floor(rm / width))
    l_many = left.withColumn("_ij_b", reached(lm + F.lit(lower_us), lm + F.lit(upper_us)))
    r_many = right.withColumn("_ij_b", reached(rm - F.lit(upper_us), rm - F.lit(lower_us)))

    def rows(lhs: DataFrame, rhs: DataFrame, kind: str) -> DataFrame:
        gap = micros(rhs[right_ts]) - micros(lhs[left_ts])
        cond = (lhs["_ij_b"] == rhs["_ij_b"]) & (gap >= lower_us if lower_inclusive else gap > lower_us) & (gap <= upper_us if upper_inclusive else gap < upper_us)
        for k in keys:
            cond = cond & (lhs[k] == rhs[k])
        rcols = [rhs[c] for c in right.columns if c not in keys] if how == "inner" else [rhs[c].alias(f"r_{c}") if c in keys else rhs[c] for c in right.columns]
        if kind == "right_only":
            pads = [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns]
            return rhs.join(lhs, cond, "left_anti").select(*pads, *rcols)
        return lhs.join(rhs, cond, kind).select(*[lhs[c] for c in left.columns], *rcols)

    if how == "right":
        return rows(l_many, r_one, "right")
    matched = rows(l_one, r_many, "inner" if how == "inner" else "left")
    return matched.unionByName(rows(l_many, r_one, "right_only")) if how == "full" else matched


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                left_ts: str, right_ts: str, size: str) -> DataFrame:
    """JOI-14: pairs with equal key in the same tumbling window (inner)."""
    lw = left.withColumn("window_start", F.window(F.col(left_ts), size).start)
    rw = right.withColumn("window_start", F.window(F.col(right_ts), size).start)
    return lw.join(rw, [*keys, "window_start"], "inner")


def window_cogroup(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   left_ts: str, right_ts: str, size: str,
                   left_aggs: Sequence[Column], right_aggs: Sequence[Column]) -> DataFrame:
    """JOI-15: per key and window both sides' groups, also when one is empty:
    each side is aggregated first (partial aggregation before the shuffle),
    then the two summaries are full-outer joined."""
    lg = (left.groupBy(*keys, F.window(F.col(left_ts), size).start.alias("window_start"))
              .agg(*left_aggs))
    rg = (right.groupBy(*keys, F.window(F.col(right_ts), size).start.alias("window_start"))
               .agg(*right_aggs))
    return lg.join(rg, [*keys, "window_start"], "full")


def asof_join(left: DataFrame, versions: DataFrame, keys: Sequence[str],
              left_ts: str, version_ts: str, how: str = "inner",
              num_slices: int | None = None, arrival: Sequence[str] | None = None) -> DataFrame:
    """JOI-16 temporal table join: each left row with the version of its key
    valid at the row's time (largest version time <= row time).

    Steps: union the left times and the version times, a per-key running max
    of version times (hot-key safe prefix scan) gives every left row the
    valid-from time of its version, then one equi-join fetches the version.
    Of several versions of a key at one time only one is valid: the last by
    ``arrival`` (columns; by default all the others in their order).
    """
    rest = [c for c in versions.columns if c not in keys and c != version_ts]
    if rest:
        last = F.max_by(F.struct(*rest), F.struct(*(arrival or rest))).alias("_asof_row")
        versions = versions.groupBy(*keys, version_ts).agg(last).select(*keys, version_ts, "_asof_row.*")
    else:
        versions = versions.distinct()
    vt_name = "_asof_vt"
    lk = left.select(*keys, F.col(left_ts).cast("timestamp_ntz").alias("_asof_t"),
                     F.lit(1).alias("_asof_side"), F.lit(None).cast("long").alias("_asof_v"))
    vk = versions.select(*keys, F.col(version_ts).cast("timestamp_ntz").alias("_asof_t"),
                         F.lit(0).alias("_asof_side"), micros(version_ts).alias("_asof_v"))
    # Left rows are matched back on (keys, time): rows sharing both get the
    # same version, so no row id is needed.
    both = lk.unionByName(vk)
    scanned = prefix_scan(both, keys, ["_asof_t", "_asof_side"], row_number=None,
                          maxs={vt_name: "_asof_v"}, num_slices=num_slices)
    valid = (scanned.filter(F.col("_asof_side") == 1)
                    .select(*keys, F.col("_asof_t"), F.col(vt_name)).distinct())
    lt = left.withColumn("_asof_t", F.col(left_ts).cast("timestamp_ntz"))
    lv = lt.join(valid, [*keys, "_asof_t"], "left")
    vv = versions.withColumn(vt_name, micros(version_ts))
    out = lv.join(vv, [*keys, vt_name], "left" if how == "left" else "inner")
    return out.drop("_asof_t", vt_name)


def lookup_join(stream: DataFrame, dim: DataFrame, on: Sequence[str] | Column,
                how: str = "inner", broadcast: bool = False) -> DataFrame:
    """JOI-17 lookup join against a dimension table (inner or left).

    ``broadcast`` is only for dimensions with a fixed bound on their size;
    otherwise the planner (and AQE at run time) picks the strategy."""
    if how not in ("inner", "left"):
        raise ValueError("lookup join supports inner and left only")
    d = F.broadcast(dim) if broadcast else dim
    return stream.join(d, on, how)


def null_safe_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
                   how: str = "inner") -> DataFrame:
    """JOI-23 equi-join with IS NOT DISTINCT FROM keys."""
    cond = None
    for lc, rc in pairs:
        c = left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)


def not_in(left: DataFrame, column: str, right: DataFrame, values: str) -> DataFrame:
    """JOI-05 ``column NOT IN (SELECT values)`` with SQL's null rules: without
    values everything passes; a null among the values lets nothing pass; else a
    null on the left doesn't pass.  An equi anti join and one row of two counts,
    where Spark would broadcast all values for a null-aware join."""
    found = right.select(F.col(values).alias("_ni_v"))
    facts = found.agg(F.count(F.lit(1)).alias("_ni_n"), F.count("_ni_v").alias("_ni_k"))
    passed = left.join(found.filter("_ni_v is not null"), F.col(column) == F.col("_ni_v"), "left_anti")
    ok = (F.col("_ni_n") == 0) | ((F.col("_ni_n") == F.col("_ni_k")) & F.col(column).isNotNull())
    return passed.crossJoin(F.broadcast(facts)).filter(ok).select(*left.columns)  # facts: one row
