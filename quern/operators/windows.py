"""Group windows on bounded tables (STR-06..20, STR-32..36).

Time windows map onto Spark's ``window`` / ``session_window`` expressions, so
they run as an ordinary hash aggregate on (key, window) with map-side partial
aggregation.  Count windows, evictors and delta triggers need the position of
a row inside its key; that comes from :func:`quern.operators.prefix.prefix_scan`
so a hot key never lands in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.prefix import prefix_scan


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time windows -----------------------------------------------------------

def tumble(ts: str | Column, size: str, offset: str | None = None) -> Column:
    """STR-06: start = ts - (ts - offset + size) mod size, end exclusive."""
    return F.window(_c(ts), size, size, offset) if offset else F.window(_c(ts), size)


def hop(ts: str | Column, size: str, slide: str, offset: str | None = None) -> Column:
    """STR-07: every row belongs to size / slide overlapping windows."""
    return F.window(_c(ts), size, slide, offset) if offset else F.window(_c(ts), size, slide)


def session(ts: str | Column, gap: str | Column) -> Column:
    """STR-08 / STR-09: windows merge while [ts, ts + gap] intervals touch;
    ``gap`` may be a per-row expression (dynamic gap)."""
    return F.session_window(_c(ts), gap)


def window_start(w: str = "window") -> Column:
    return F.col(f"{w}.start")


def window_end(w: str = "window") -> Column:
    return F.col(f"{w}.end")


def window_rowtime(w: str = "window") -> Column:
    """AUX-04: the event time of a window result is end - 1 millisecond."""
    return F.col(f"{w}.end") - F.expr("INTERVAL 1 MILLISECOND")


# --- count windows ----------------------------------------------------------

def count_window(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 size: int, aggs: Sequence[Column],
                 num_slices: int | None = None) -> DataFrame:
    """STR-11 tumbling count window: every ``size`` rows of a key form one
    window; the incomplete tail window never fires, so it is dropped."""
    numbered = prefix_scan(df, keys, order, row_number="_cw_rn", num_slices=num_slices)
    win = numbered.withColumn("window_id", F.floor((F.col("_cw_rn") - 1) / size))
    out = win.groupBy(*keys, "window_id").agg(F.count(F.lit(1)).alias("_cw_n"), *aggs)
    return out.filter(F.col("_cw_n") == size).drop("_cw_n")


def sliding_count_window(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                         size: int, slide: int, value: str,
                         num_slices: int | None = None) -> DataFrame:
    """STR-12 sliding count window: fires at every ``slide``-th row of a key
    with the last ``size`` rows (fewer at the start of the key).

    The sum is taken inside the frame of the last ``size`` rows
    (:func:`quern.operators.frames.rows_frame`), so a large early value leaves no rounding error behind.
    """
    from quern.operators.frames import rows_frame
    framed = rows_frame(df, keys, order, {"sum_value": ("sum", value, 1 - size, 0)}, num_slices=num_slices, row_number="rn")
    fires = framed.filter(F.col("rn") % slide == 0)
    return fires.select(*keys, F.col("rn").alias("fire_rn"), F.least(F.col("rn"), F.lit(size)).alias("n_rows"), "sum_value")


# --- evictors (applied to the contents of each fired window) -------------------

def count_evict(df: DataFrame, group: Sequence[str | Column], order: Sequence[str | Column],
                keep: int) -> DataFrame:
    """STR-32: keep only the last ``keep`` rows of each window pane."""
    w = Window.partitionBy(*group).orderBy(*[_c(o).desc() for o in order])
    return (df.withColumn("_ev_rn", F.row_number().over(w))
              .filter(F.col("_ev_rn") <= keep).drop("_ev_rn"))


def time_evict(df: DataFrame, group: Sequence[str | Column], ts: str, size_us: int) -> DataFrame:
    """STR-33: drop rows with ts <= max(ts) - size (strictly newer kept)."""
    # An aggregate joined back rather than a window: a large pane isn't held in one task.
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    named = df.withColumns({f"_ev_{i}": _c(g) for i, g in enumerate(group)})
    last = named.groupBy(*[F.col(f"_ev_{i}").alias(f"_ev_k{i}") for i in range(len(group))]).agg(F.max(us).alias("_ev_max"))
    same = F.lit(True)
    for i in range(len(group)):
        same = same & F.col(f"_ev_{i}").eqNullSafe(F.col(f"_ev_k{i}"))
    return named.join(last, same).filter(us > F.col("_ev_max") - F.lit(size_us)).select(*df.columns)


def delta_evict(df: DataFrame, group: Sequence[str | Column], order: Sequence[str | Column],
                delta: Column, threshold: float) -> DataFrame:
    """STR-34: drop rows whose delta to the last row of the pane is >= threshold.
    ``delta`` is an expression of the row columns and ``_last_*`` columns."""
    return df.filter(delta < F.lit(threshold))


# --- vector distances (STR-35) ----------------------------------------------

def euclidean_distance(a: Column, b: Column) -> Column:
    sq = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos(a, b); 0 when either vector is all zeros (reference rule)."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                      F.lit(0.0), lambda acc, v: acc + v)
    na = F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    nb = F.aggregate(b, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(
        F.lit(1.0) - dot / (F.sqrt(na) * F.sqrt(nb)))


# --- Table API style window builders (STR-15) ----------------------------------

class _WindowSpec:
    def __init__(self, size: str, slide: str | None = None, gap: str | None = None):
        self.size, self.slide, self.gap = size, slide, gap

    def every(self, slide: str) -> "_WindowSpec":
        return _WindowSpec(self.size, slide, self.gap)

    def on(self, ts: str | Column) -> Column:
        if self.gap is not None:
            return session(ts, self.gap)
        if self.slide is not None:
            return hop(ts, self.size, self.slide)
        return tumble(ts, self.size)


class Tumble:
    @staticmethod
    def over(size: str) -> _WindowSpec:
        return _WindowSpec(size)


class Slide:
    @staticmethod
    def over(size: str) -> _WindowSpec:
        return _WindowSpec(size)


class Session:
    @staticmethod
    def with_gap(gap: str) -> _WindowSpec:
        return _WindowSpec("0 seconds", gap=gap)


def sessionize(df: DataFrame, keys: Sequence[str], ts: str, gap_us: int | Column, tie: str,
               session_col: str = "session_id", num_slices: int | None = None) -> DataFrame:
    """STR-08 / STR-09 session ids without a key in one task: a row opens a
    session when it lies beyond the end (time + gap, a constant or an
    expression of the row) of all rows before it; rows exactly one gap apart stay
    together.  The running maximum of the ends and the running count of
    openings are prefix scans, so the aggregate afterwards is an ordinary
    partial aggregate on (key, session id).  Rows without a time are left out.
    Adds ``session_col`` and ``_ss_end`` (the row's own end in microseconds)."""
    from quern.operators.joins import micros
    gap = gap_us if isinstance(gap_us, Column) else F.lit(gap_us)
    d = df.filter(F.col(ts).isNotNull()).withColumn("_ss_end", micros(ts) + gap.cast("long"))
    d = prefix_scan(d, keys, [ts, tie], row_number=None, maxs_before={"_ss_open": "_ss_end"},
                    num_slices=num_slices, keep_slices=True)
    opens = F.coalesce(micros(ts) > F.col("_ss_open"), F.lit(True))
    d = d.withColumn("_ss_new", opens.cast("int").cast("decimal(18,0)"))
    d = prefix_scan(d, keys, [ts, tie], row_number=None, sums={session_col: "_ss_new"}, num_slices=num_slices)
    return d.withColumn(session_col, F.col(session_col).cast("long")).drop("_ss_open", "_ss_new")


def session_aggregate(df: DataFrame, keys: Sequence[str], ts: str, gap_us: int | Column, tie: str,
                      aggs: Sequence[Column], num_slices: int | None = None) -> DataFrame:
    """Session windows per key with ``window_start`` / ``window_end`` and the
    given aggregates, by :func:`sessionize` whatever the size of the keys."""
    s = sessionize(df, keys, ts, gap_us, tie, num_slices=num_slices)
    end = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=F.max("_ss_end").cast("decimal(24,6)") / F.lit(1_000_000).cast("decimal(8,0)"))
    return (s.groupBy(*keys, "session_id").agg(F.min(ts).alias("window_start"), end.alias("window_end"), *aggs)
             .drop("session_id"))
