"""Aggregates with reference semantics (AGG-*) and declarative UDAFs.

All of them are declarative Spark aggregates, so Spark plans a partial
(map-side) aggregate before the shuffle and a hot key costs one partial row
per task, not one task with a third of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.prefix import prefix_scan


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def avg_keep_type(c, dtype: str = "int") -> Column:
    """AVG over integers keeps the integer type (truncating quotient)."""
    n = F.count(_c(c))
    return F.when(n > 0, F.call_function("div", F.sum(_c(c).cast("long")), F.greatest(n, F.lit(1)))).cast(dtype)


def sum0(c) -> Column:
    """SUM0: 0 instead of null for a group without non-null input."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def first_value(c, order) -> Column:
    """FIRST_VALUE: first non-null by the given order."""
    return F.min_by(F.when(_c(c).isNotNull(), _c(c)),
                    F.when(_c(c).isNotNull(), _c(order)))


def last_value(c, order) -> Column:
    return F.max_by(F.when(_c(c).isNotNull(), _c(c)),
                    F.when(_c(c).isNotNull(), _c(order)))


def listagg(c, delimiter: str = ",", order: str | None = None) -> Column:
    """LISTAGG: nulls skipped, default delimiter ``,``."""
    if order:
        return F.expr(f"listagg({c}, '{delimiter}') WITHIN GROUP (ORDER BY {order})")
    return F.listagg(_c(c), F.lit(delimiter))


def collect_multiset(df: DataFrame, keys: Sequence[str], value: str,
                     out: str = "multiset") -> DataFrame:
    """COLLECT: multiset of values per group as a map value -> count.

    Counted per (keys, value) first, so only distinct values travel."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_ms_n"))
    return counts.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(value), F.col("_ms_n")))).alias(out))


def distinct_count_split(df: DataFrame, keys: Sequence[str], value: str, out: str = "n_distinct") -> DataFrame:
    """AGG-06 skew split of COUNT(DISTINCT): distinct values are hashed on (keys, value), so a hot key's set spreads over all
    tasks, finer than any number of buckets; the count of them is partial, a row a task and key.  Keys without a value have no row."""
    values = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value)).distinct()
    return values.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias(out))


def grouping_sets(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], aggs: dict[str, Column],
                  grouping_id: str = "gid", group_id: str = "group_id") -> DataFrame:
    """AGG-08/09 GROUPING SETS in which a set may stand several times: GROUP_ID numbers the repeats of a set from 0 and GROUPING_ID has a
    bit for each key that the set leaves out, the first key's the highest.

    Each row is repeated for each set under a literal array and aggregated once, partially before the shuffle.  ``aggs`` see the keys' own
    values.  A null key of the data and one that is left out differ in GROUPING_ID.  An empty input has no row, not even for ()."""
    seen: dict[int, int] = {}
    marks = []
    for s in sets:
        if set(s) - set(keys):
            raise ValueError(f"not among the keys: {sorted(set(s) - set(keys))}")
        left_out = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s)
        marks.append(F.struct(F.lit(left_out).cast("long").alias("out"), F.lit(seen.get(left_out, 0)).cast("long").alias("nth")))
        seen[left_out] = seen.get(left_out, 0) + 1
    marked = df.withColumn("_gs", F.explode(F.array(*marks)))
    kept = {f"_gk_{i}": F.when(F.col("_gs.out").bitwiseAND(F.lit(1 << (len(keys) - 1 - i))) == 0, F.col(k)) for i, k in enumerate(keys)}
    out = marked.withColumns(kept).groupBy("_gs", *kept).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(*[F.col(f"_gk_{i}").alias(k) for i, k in enumerate(keys)], F.col("_gs.out").alias(grouping_id), F.col("_gs.nth").alias(group_id), *aggs)


@dataclass(frozen=True)
class Udaf:
    """A user aggregate defined by mergeable partial aggregates and a final
    expression (create / accumulate / merge / getValue in declarative form).

    ``partials`` maps a name to an aggregate expression over the input row;
    ``result`` builds the output from the partials.  Spark combines partials
    map-side, so the aggregate is as scalable as SUM.
    """
    partials: dict[str, Callable[..., Column]]
    result: Callable[[dict[str, Column]], Column]

    def __call__(self, *args) -> Column:
        parts = {n: f(*[_c(a) for a in args]) for n, f in self.partials.items()}
        return self.result(parts)


WEIGHTED_AVG = Udaf(
    partials={"sw": lambda x, w: F.sum(x * w), "w": lambda x, w: F.sum(w)},
    result=lambda p: p["sw"] / p["w"])

# multiSum(a, b): sum of a + b per group (study UDAF)
MULTI_SUM = Udaf(partials={"s": lambda a, b: F.sum((a + b).cast("long"))},
                 result=lambda p: p["s"])

# RowCountSum: count and sum(num * price) over rows with num > 0 and price > 0
ROW_COUNT_SUM = Udaf(
    partials={"n": lambda num, price: F.count(F.when((num > 0) & (price > 0), F.lit(1))),
              "s": lambda num, price: F.coalesce(F.sum(F.when((num > 0) & (price > 0), num * price)), F.lit(0.0))},
    result=lambda p: F.struct(p["n"].alias("cnt"), p["s"].alias("account")))


def keyed_rolling(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                  num_slices: int | None = None) -> DataFrame:
    """AGG-26 keyed rolling sum / min / max: the running value after each row."""
    return prefix_scan(df, keys, order, row_number="rn",
                       sums={"rolling_sum": value}, mins={"rolling_min": value},
                       maxs={"rolling_max": value}, num_slices=num_slices)


def keyed_max_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 id_col: str, num_slices: int | None = None) -> DataFrame:
    """AGG-27 running maxBy: after each row, the id of the row holding the
    maximum so far (the first such row on ties)."""
    sc = prefix_scan(df, keys, order, row_number=None, maxs={"_mb_max": value},
                     num_slices=num_slices)
    firsts = (sc.filter(F.col(value) == F.col("_mb_max"))
                .groupBy(*keys, "_mb_max")
                .agg(F.min_by(F.col(id_col), F.struct(*[F.col(o) for o in order])).alias("max_by_id")))
    firsts = firsts.select(*[F.col(k).alias(f"_mb_k{i}") for i, k in enumerate(keys)], F.col("_mb_max").alias("_mb_at"), "max_by_id")
    same = F.col("_mb_max") == F.col("_mb_at")
    for i, k in enumerate(keys):
        same = same & sc[k].eqNullSafe(firsts[f"_mb_k{i}"])
    return sc.join(firsts, same, "left").select(*df.columns, F.col("_mb_max").alias("running_max"), "max_by_id")

