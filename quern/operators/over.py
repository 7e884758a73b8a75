"""OVER windows, top-N and de-duplication (OVR-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

UNBOUNDED = None


def over(partition_by: Sequence[str | Column], order_by: Sequence[str | Column], *,
         rows: tuple[int | None, int | None] | None = None,
         range_: tuple[int | None, int | None] | None = None) -> WindowSpec:
    """Table API ``Over.partitionBy(..).orderBy(..).preceding(..).following(..)``;
    ``None`` bounds are unbounded, 0 is the current row."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)

    def b(x, lo):
        if x is None:
            return Window.unboundedPreceding if lo else Window.unboundedFollowing
        return x
    if rows is not None:
        w = w.rowsBetween(b(rows[0], True), b(rows[1], False))
    elif range_ is not None:
        w = w.rangeBetween(b(range_[0], True), b(range_[1], False))
    return w


def top_n(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
          n: int, rank_col: str | None = "rank_num", fn: str = "row_number") -> DataFrame:
    """OVR-14 top-N per group; Spark pushes a partial limit per group below
    the shuffle (WindowGroupLimit), so a hot group ships n rows per task."""
    rank_fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[fn]
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    out = df.withColumn("_topn", rank_fn().over(w).cast("long")).filter(F.col("_topn") <= n)
    return out.withColumnRenamed("_topn", rank_col) if rank_col else out.drop("_topn")


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """OVR-16 keep the first row per key (by ``order``): an aggregate with
    min_by, so partial aggregation keeps one candidate per key per task."""
    cols = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_d"))
    return agg.select(*keys, *[F.col(f"_d.{c}").alias(c) for c in cols])


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """OVR-17 keep the last row per key."""
    cols = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_d"))
    return agg.select(*keys, *[F.col(f"_d.{c}").alias(c) for c in cols])


# --- hot-key-safe ranking and first/last non-null (prefix-scan based) ---------

def _names(order):
    return [o if isinstance(o, str) else o[0] for o in order]


def _cols(order):
    out = []
    for o in order:
        if isinstance(o, str):
            out.append(F.col(o))
        else:
            name, asc = o
            out.append(F.col(name).asc_nulls_first() if asc else F.col(name).desc_nulls_last())
    return out


def rank_keyed(df: DataFrame, keys: Sequence[str], order: Sequence, tie: str, *,
               row_number: str | None = "rn", rank: str | None = "rk",
               dense_rank: str | None = "drk", num_slices: int | None = None) -> DataFrame:
    """ROW_NUMBER / RANK / DENSE_RANK over (PARTITION BY keys ORDER BY order)
    without a key in one task.  ``order`` items are column names (ascending)
    or (name, ascending) pairs; ``tie`` is a unique column for row numbers.

    rank = row number of the first row among peers (one aggregate on
    (keys, order values)); dense rank = a prefix count over the peer groups."""
    from quern.operators.prefix import prefix_scan
    names, cols = _names(order), _cols(order)
    sc = prefix_scan(df, keys, [*cols, F.col(tie)], row_number="_rk_rn", num_slices=num_slices)
    out = sc
    if rank or dense_rank:
        peers = sc.groupBy(*keys, *names).agg(F.min("_rk_rn").alias("_rk_first"))
        if dense_rank:
            peers = prefix_scan(peers, keys, cols, row_number="_rk_dense", num_slices=num_slices)
        cond = [out[k].eqNullSafe(peers[k]) for k in keys] + [out[n].eqNullSafe(peers[n]) for n in names]
        keep = [peers["_rk_first"]] + ([peers["_rk_dense"]] if dense_rank else [])
        out = out.join(peers, cond, "inner").select(out["*"], *keep)
    sel = [c for c in df.columns]
    if row_number:
        sel.append(F.col("_rk_rn").alias(row_number))
    if rank:
        sel.append(F.col("_rk_first").alias(rank))
    if dense_rank:
        sel.append(F.col("_rk_dense").alias(dense_rank))
    return out.select(*sel)


def first_last_non_null(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, *,
                        first: str = "first_nn", last: str = "last_nn",
                        num_slices: int | None = None) -> DataFrame:
    """FIRST_VALUE / LAST_VALUE(value IGNORE NULLS) OVER (... ROWS BETWEEN
    UNBOUNDED PRECEDING AND CURRENT ROW): running min / max of the row
    numbers of non-null rows, then one equi-join each to fetch the value."""
    from quern.operators.prefix import prefix_scan
    sc = prefix_scan(df, keys, order, row_number="_fl_rn", num_slices=num_slices, keep_slices=True)
    sc = sc.withColumn("_fl_nn", F.when(F.col(value).isNotNull(), F.col("_fl_rn")))
    sc = prefix_scan(sc, keys, order, row_number=None, mins={"_fl_first": "_fl_nn"},
                     maxs={"_fl_last": "_fl_nn"}, num_slices=num_slices)
    # A row's own value needs no join: the values sought stand in other rows of the key.
    vals = sc.filter(F.col(value).isNotNull()).select(*[F.col(k).alias(f"_fl_k{i}") for i, k in enumerate(keys)],
                                                      F.col("_fl_rn").alias("_fl_at"), F.col(value).alias("_fl_v"))

    def fetch(rows: DataFrame, at: str, name: str) -> DataFrame:
        same = rows[at] == F.col("_fl_at")
        for i, k in enumerate(keys):
            same = same & rows[k].eqNullSafe(F.col(f"_fl_k{i}"))
        return rows.join(vals, same, "left").select(*[rows[c] for c in rows.columns], F.col("_fl_v").alias(name))

    return fetch(fetch(sc, "_fl_first", first), "_fl_last", last).select(*df.columns, first, last)
