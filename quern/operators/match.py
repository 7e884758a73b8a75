"""MATCH_RECOGNIZE (STR-50..52): row pattern matching per key.

Contract: ``match_recognize(df, partition_by, order_by, pattern, define, measures, measure_schema, after, within_ms, subset, back)``.

* ``pattern``: list of ``Var(name, min, max, greedy)`` matched with strict contiguity (``A B+ C?``); ``max=None`` is unbounded.  Reluctant is
  allowed except on ``?``.  The last variable can't be optional, nor greedy of open length: its end couldn't be told.  Alternation,
  PERMUTE and groups are not supported (reference limits).
* ``define``: variable -> boolean Column over the row, computed by Spark beforehand, or a function of the :class:`MatchSoFar`, evaluated
  while the match grows (``LAST(A.price, 1)``, ``SUM(A.price)`` and the like); an undefined variable matches every row.
* ``subset``: name -> variables, usable wherever a variable's rows are asked for.
* ``measures``: name -> ``(fn, var, column)`` with fn in first, last (a fourth entry is the offset), count, sum, min, max, avg; plus
  ``match_rowtime`` (time of the last row) and ``classifier`` (variable of the last row).  ``var`` None means all rows.  Conditions see the
  match so far (RUNNING), measures the whole match (FINAL).
* ``after``: ``"PAST LAST ROW"``, ``"TO NEXT ROW"``, ``("TO FIRST", X)``, ``("TO LAST", X)``.
* ``within_ms``: a match may span at most this much event time.
* ``back``: the largest offset that a condition gives to ``prev``.

Of all matches that start at a row the preferred one counts (greedy variables take as many rows as they can); of the starts, the earliest one.

Executions:
* fixed-length patterns without quantifiers and skip to next row compile to ``lead`` columns and a filter (:func:`match_fixed_length`);
* the general case moves all live runs of a key on by one row at a time (:class:`Matcher`): in batch over partitions sorted by (key, order),
  which keep only the rows that a live run can still use; on a stream a row waits until the watermark has passed it, so rows may
  come in any order within the watermark's delay.

Rows without a time match nothing.  Rows of a null key are a key like any other.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Var:
    name: str
    min: int = 1
    max: int | None = 1
    greedy: bool = True

    def __post_init__(self):
        if self.min == 0 and self.max == 1 and not self.greedy:
            raise ValueError("reluctant '?' is not supported")


def prev(c: str, offset: int = 1, partition_by=None, order_by=None) -> Column:
    """PREV(c, n) inside DEFINE (window lag over the match's key order)."""
    return F.lag(F.col(c), offset).over(Window.partitionBy(*partition_by).orderBy(*order_by))


def next_(c: str, offset: int = 1, partition_by=None, order_by=None) -> Column:
    return F.lead(F.col(c), offset).over(Window.partitionBy(*partition_by).orderBy(*order_by))


# --- the matcher ------------------------------------------------------------------


class MatchSoFar:
    """A match up to the row ``at``, that row included: what a condition sees of it, taken as mapped to the variable in question.

    Rows of a match are consecutive, so a match is its variables' first places (``bounds``) in the rows that all runs share."""

    __slots__ = ("rows", "base", "members", "bounds", "at", "known")

    def __init__(self, rows, base, members, bounds, at, known):
        self.rows, self.base, self.members, self.bounds, self.at, self.known = rows, base, members, bounds, at, known

    def _blocks(self, var) -> list[tuple[int, int]]:
        b, n = self.bounds, len(self.bounds)
        return [(b[p], b[p + 1] if p + 1 < n else self.at + 1) for p in self.members[var] if p < n]

    @property
    def row(self) -> dict:
        return self.rows[self.at - self.base]

    def prev(self, col: str, offset: int = 1):
        """PREV: the row ``offset`` places before, mapped or not."""
        i = self.at - offset - self.base
        return self.rows[i][col] if i >= 0 else None

    def first(self, var, col: str, offset: int = 0):
        for a, b in self._blocks(var):
            if offset < b - a:
                return self.rows[a + offset - self.base][col]
            offset -= b - a
        return None

    def last(self, var, col: str, offset: int = 0):
        for a, b in reversed(self._blocks(var)):
            if offset < b - a:
                return self.rows[b - 1 - offset - self.base][col]
            offset -= b - a
        return None

    def size(self, var) -> int:
        return sum(b - a for a, b in self._blocks(var))

    def _folded(self, var, col: str) -> tuple:
        """(rows folded up to, count, sum, min, max) of the values that are there; goes on from where the run's last call ended."""
        upto, n, total, low, high = self.known.get((var, col), (0, 0, None, None, None))
        for a, b in self._blocks(var):
            for i in range(max(a, upto), b):
                v = self.rows[i - self.base][col]
                if v is not None and v == v:
                    n, total = n + 1, v if total is None else total + v
                    low, high = v if low is None or v < low else low, v if high is None or v > high else high
        out = self.known[var, col] = (self.at + 1, n, total, low, high)
        return out

    def count(self, var, col: str) -> int:
        return self._folded(var, col)[1]

    def sum(self, var, col: str):
        return self._folded(var, col)[2]

    def min(self, var, col: str):
        return self._folded(var, col)[3]

    def max(self, var, col: str):
        return self._folded(var, col)[4]

    def avg(self, var, col: str):
        _, n, total, _, _ = self._folded(var, col)
        return total / n if n else None


class Run:
    """A way to match from ``start``: each variable's first place, folded values, and the last row once it is complete."""

    __slots__ = ("start", "bounds", "known", "end")

    def __init__(self, start, bounds, known, end=None):
        self.start, self.bounds, self.known, self.end = start, bounds, known, end


class Matcher:
    """Run the pattern over one key's rows, which come in order, incrementally.

    ``live`` holds the runs in order of preference: by start, then by the quantifiers' wishes.  A complete run waits there until those
    before it have ended.  Two runs in the same place of the pattern have the same future, so the later one goes, unless conditions
    look at the match so far, or the two starts differ and both count (time limit, or a skip that starts inside a match)."""

    def __init__(self, pattern: Sequence[Var], measures: dict, after, within_ms, time_col, tie_col,
                 conditions: dict[str, Callable] | None = None, subset: dict[str, Sequence[str]] | None = None, back: int = 0):
        self.pattern = list(pattern)
        self.names = [v.name for v in pattern]
        last = self.pattern[-1]
        if last.min == 0 or (last.greedy and last.max != last.min):
            raise ValueError(f"the last variable {last.name} can't be optional or greedy of open length")
        self.measures, self.after, self.within = measures, after, within_ms
        self.time_col, self.tie_col, self.back = time_col, tie_col, back
        self.conditions = conditions or {}
        self.flags = [f"_mr_{n}" for n in self.names]
        self.tests = [self.conditions.get(n) for n in self.names]
        place = {n: p for p, n in enumerate(self.names)}
        self.members = {n: (p,) for n, p in place.items()} | {None: tuple(range(len(self.names)))}
        for name, of in (subset or {}).items():
            if name in place:
                raise ValueError(f"{name} is a variable already")
            self.members[name] = tuple(sorted(place[v] for v in of))
        self.enough = [v.min if v.max is None else v.max for v in self.pattern]  # from here on, more rows make no difference
        self.past_last = after == "PAST LAST ROW"
        self.one_future = self.past_last and within_ms is None and not self.conditions
        self.ways: dict = {}
        self.rows: list = []
        self.base = 0  # place of rows[0] among all rows of the key
        self.live: list[Run] = []

    def _ways(self, p: int, k: int) -> list[int]:
        """The variables that can take the next row when ``p`` has taken ``k``, the preferred one first."""
        v = self.pattern[p]
        stay = [p] if v.max is None or k < v.max else []
        go = self._ways(p + 1, 0) if k >= v.min and p + 1 < len(self.pattern) else []
        return stay + go if v.greedy else go + stay

    def _step(self, i: int, row: dict) -> None:
        last, rows, base = len(self.pattern) - 1, self.rows, self.base
        out, seen, matched, floor = [], set(), -1, -1
        self.live.append(Run(i, (), {}))
        for run in self.live:
            if run.start == matched or run.start < floor:
                continue  # a preferred run has just matched these rows
            if run.end is not None:
                out.append(run)
                continue
            if self.within is not None and row["_mr_t"] - rows[run.start - base]["_mr_t"] > self.within:
                continue
            bounds, p = run.bounds, len(run.bounds) - 1
            at = (0, 0) if p < 0 else (p, min(i - bounds[p], self.enough[p]))
            ways = self.ways.get(at)
            if ways is None:
                ways = self.ways[at] = self._ways(*at)
            for q in ways:
                known = run.known
                if self.tests[q] is None:
                    if not row[self.flags[q]]:
                        continue
                    new = bounds if q == p else bounds + (i,) * (q - p)
                else:
                    new = bounds if q == p else bounds + (i,) * (q - p)
                    known = dict(known)
                    if not self.tests[q](MatchSoFar(rows, base, self.members, new, i, known)):
                        continue
                taken = i - new[q] + 1
                if q == last and taken >= self.pattern[q].min:
                    out.append(Run(run.start, new, known, i))
                    matched = run.start
                    if self.past_last:
                        floor = i + 1
                    break
                if not self.conditions:
                    future = (q, min(taken, self.enough[q]), None if self.one_future else run.start)
                    if future in seen:
                        continue
                    seen.add(future)
                out.append(Run(run.start, new, known))
        self.live = out

    def _matches(self) -> Iterator[dict]:
        """The complete runs that nothing before can overtake any more."""
        at, floor = 0, -1
        while at < len(self.live):
            run = self.live[at]
            if run.start >= floor:
                if run.end is None:
                    break
                yield self._measures(run)
                floor = self._next_start(run)
            at += 1
        if at:
            self.live = [r for r in self.live[at:] if r.start >= floor]

    def push(self, rows: list, final: bool) -> list[dict]:
        out = []
        for r in rows:
            self.rows.append(r)
            self._step(self.base + len(self.rows) - 1, r)
            if self.live and self.live[0].end is not None:
                out.extend(self._matches())
        if final:
            self.live = [r for r in self.live if r.end is not None]
            out.extend(self._matches())
        self._forget()
        return out

    def expire(self, now: int) -> list[dict]:
        """No row up to the time ``now`` comes any more: runs that are out of time end."""
        if self.within is None:
            return []
        self.live = [r for r in self.live if r.end is not None or now - self.rows[r.start - self.base]["_mr_t"] <= self.within]
        out = list(self._matches())
        self._forget()
        return out

    def dump(self) -> bytes:
        """What the rest of the rows has to be matched with."""
        return pickle.dumps((self.rows, self.base, [(r.start, r.bounds, r.known, r.end) for r in self.live]))

    def load(self, state: bytes) -> None:
        self.rows, self.base, live = pickle.loads(state)
        self.live = [Run(*r) for r in live]

    def _forget(self) -> None:
        """Drops the rows that no run and no ``prev`` can reach."""
        first = min((r.start for r in self.live), default=self.base + len(self.rows)) - self.back
        if first > self.base:
            del self.rows[:first - self.base]
            self.base = first

    def _next_start(self, run: Run) -> int:
        a = self.after
        if a == "PAST LAST ROW":
            return run.end + 1
        if a == "TO NEXT ROW":
            return run.start + 1
        kind, var = a
        places = [p for p in MatchSoFar(self.rows, self.base, self.members, run.bounds, run.end, {})._blocks(var) if p[0] < p[1]]
        if not places:
            raise ValueError(f"AFTER MATCH SKIP {kind} {var}: {var} is not in the match")
        nxt = places[0][0] if kind == "TO FIRST" else places[-1][1] - 1
        if nxt == run.start:
            raise ValueError("AFTER MATCH SKIP would repeat the same match (infinite loop)")
        return nxt

    def _measures(self, run: Run) -> dict:
        whole, out = MatchSoFar(self.rows, self.base, self.members, run.bounds, run.end, {}), {}
        for name, spec in self.measures.items():
            if spec == "match_rowtime":
                out[name] = whole.row[self.time_col]
            elif spec == "classifier":
                out[name] = self.names[-1]
            elif spec[0] in ("first", "last"):
                out[name] = getattr(whole, spec[0])(*spec[1:])
            elif spec[0] in ("count", "sum", "min", "max", "avg"):
                out[name] = getattr(whole, spec[0])(spec[1], spec[2])
            else:
                raise ValueError(f"unknown measure function {spec[0]}")
        return out


def _prepare(df, order_by, pattern, define, measures, columns):
    """The input with a flag for each variable that a Column defines, the functions of the others, and the columns that rows carry."""
    names = [v.name for v in pattern]
    if len(set(names)) != len(names):
        raise ValueError("pattern variable names must be unique")
    conditions = {v: d for v, d in define.items() if not isinstance(d, Column)}
    flags = {f"_mr_{v}": define.get(v, F.lit(True)) for v in names if v not in conditions}
    t = F.unix_millis(F.col(order_by[0]).cast("timestamp"))
    need = {spec[2] for spec in measures.values() if isinstance(spec, tuple)} | set(order_by) | set(columns)
    prepared = df.withColumns(flags).withColumn("_mr_t", t).filter(F.col("_mr_t").isNotNull())
    return prepared, conditions, [*sorted(need), "_mr_t", *flags]


def match_recognize(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                    pattern: Sequence[Var], define: dict, measures: dict,
                    measure_schema: str, after="PAST LAST ROW", within_ms: int | None = None,
                    subset: dict[str, Sequence[str]] | None = None, columns: Sequence[str] = (), back: int = 0) -> DataFrame:
    """Batch execution: each task reads its keys in order, one after another, and holds only the rows that a live run of the present key
    can use.  ``columns``: what functions in ``define`` read."""
    keys, meas = list(partition_by), dict(measures)
    prepared, conditions, cols = _prepare(df, order_by, pattern, define, meas, columns)
    out_schema = T.StructType([prepared.schema[k] for k in keys] + list(T._parse_datatype_string(measure_schema).fields))
    args = (list(pattern), meas, after, within_ms, order_by[0], order_by[-1], conditions, subset, back)

    def per_partition(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema
        arrow_schema = to_arrow_schema(out_schema)
        now, matcher = None, Matcher(*args)
        for batch in batches:
            found, rows = [], batch.to_pylist()
            at = 0
            while at < len(rows):
                key, end = tuple(rows[at][f"_mk_{i}"] for i in range(len(keys))), at
                while end < len(rows) and all(rows[end][f"_mk_{i}"] == k for i, k in enumerate(key)):
                    end += 1
                if key != now:
                    found += [(now, m) for m in matcher.push([], True)]
                    now, matcher = key, Matcher(*args)
                found += [(now, m) for m in matcher.push(rows[at:end], False)]
                at = end
            if found:
                yield pa.RecordBatch.from_pylist([dict(zip(keys, k)) | m for k, m in found], arrow_schema)
        found = [dict(zip(keys, now)) | m for m in matcher.push([], True)]
        if found:
            yield pa.RecordBatch.from_pylist(found, arrow_schema)

    named = [F.col(k).alias(f"_mk_{i}") for i, k in enumerate(keys)]
    mk = [f"_mk_{i}" for i in range(len(keys))]
    parted = prepared.select(*named, *cols).repartition(*mk) if keys else prepared.select(*cols).coalesce(1)
    return parted.sortWithinPartitions(*mk, *order_by).mapInArrow(per_partition, out_schema)


def match_fixed_length(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                       variables: Sequence[str], define: dict, keep: dict[str, tuple[str, str]],
                       num_slices: int | None = None) -> DataFrame:
    """PATTERN (A B C ...) without quantifiers, AFTER MATCH SKIP TO NEXT ROW:
    every start row is independent, so the match is a filter over the rows
    that follow it.  The look-ahead (LEAD of the DEFINE flags and of the kept
    columns) comes from :func:`quern.operators.frames.rows_frame`, so a hot
    key is spread over many tasks.  ``keep``: name -> (var, numeric column);
    a timestamp column is carried as microseconds and turned back."""
    from quern.operators.frames import rows_frame
    from quern.operators.joins import micros
    tie = order_by[-1]
    flags = {f"_mf_{v}": F.when(define.get(v, F.lit(True)), 1.0).otherwise(0.0) for v in variables}
    d = df.withColumns(flags)
    ts_cols = {c for _, c in keep.values() if isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType))}
    d = d.withColumns({f"_mf_us_{c}": micros(c).cast("double") for c in ts_cols})
    src = {c: (f"_mf_us_{c}" if c in ts_cols else c) for _, c in keep.values()}
    aggs = {}
    for i, v in enumerate(variables):
        if i:
            aggs[f"_mf_{v}_at"] = ("shift", f"_mf_{v}", i)
    for name, (v, c) in keep.items():
        i = list(variables).index(v)
        if i:
            aggs[f"_mf_k_{name}"] = ("shift", src[c], i)
    cols = [*partition_by, *order_by, *flags, *{src[c] for _, c in keep.values()}]
    d = d.select(*dict.fromkeys(cols))
    out = rows_frame(d, partition_by, order_by, aggs, num_slices=num_slices) if aggs else d
    cond = F.col(f"_mf_{variables[0]}") == 1.0
    for i, v in enumerate(variables):
        if i:
            cond = cond & (F.coalesce(F.col(f"_mf_{v}_at"), F.lit(0.0)) == 1.0)
    sel = []
    for name, (v, c) in keep.items():
        i = list(variables).index(v)
        val = F.col(f"_mf_k_{name}") if i else F.col(src[c])
        if c in ts_cols:
            # zone-independent: epoch + interval (microsecond exact)
            val = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
                secs=(val / F.lit(1_000_000.0)).cast("decimal(20,6)"))
        elif isinstance(df.schema[c].dataType, (T.LongType, T.IntegerType)):
            val = val.cast("long")
        sel.append(val.alias(name))
    return out.filter(cond).select(*partition_by, *sel)


def lag_column(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], col: str,
               out: str, offset: int = 1, num_slices: int | None = None) -> DataFrame:
    """PREV(col, offset) for DEFINE conditions, hot-key safe (see rows_frame)."""
    from quern.operators.frames import rows_frame
    return rows_frame(df, partition_by, order_by, {out: ("shift", col, -offset)}, num_slices=num_slices)


# --- streaming execution -------------------------------------------------------


def _match_processor_cls():
    from pyspark.sql.streaming import StatefulProcessor

    class MatchProcessor(StatefulProcessor):
        """Pattern matching on a stream.  A row waits in list state until the watermark has passed its time; then the key's matcher, whose
        live runs and rows are kept as one value, takes it.  Timers: when the first waiting row can go, and when the oldest run is
        out of time.  A complete run that one without a time limit could still overtake waits for it, however long."""

        def __init__(self, args, key_name, order_by):
            self.args, self.key_name, self.order_by = args, key_name, list(order_by)

        def init(self, handle):
            self.handle = handle
            self.waiting = handle.getListState("waiting", "t long, row binary")
            self.matcher = handle.getValueState("matcher", "live binary")
            self.armed = handle.getValueState("armed", "t long")

        def _arm(self, t, armed, stored):
            """Sets the key's timer for ``t``, if there is something to wait for, unless it goes off before; ``stored`` is what the state says."""
            if t is not None and (armed is None or t < armed):
                self.handle.registerTimer(t)
                armed = t
            if armed != stored:
                self.armed.clear() if armed is None else self.armed.update((armed,))

        def _armed(self):
            found = self.armed.get()
            return found[0] if found else None

        def handleInputRows(self, key, rows, timerValues):
            new = [(r["_mr_t"], pickle.dumps(r.asDict())) for r in rows]
            if new:
                self.waiting.appendList(new)
                armed = self._armed()
                self._arm(min(t for t, _ in new) + 1, armed, armed)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            armed, now = self._armed(), timerValues.getCurrentWatermarkInMs()
            if armed is None or armed > max(now, expiredTimerInfo.getExpiryTimeInMs()):
                return  # an earlier timer did what there was to do
            held = [(w[0], w[1]) for w in self.waiting.get()]
            free = [pickle.loads(r) for t, r in held if t < now]
            stay = [(t, r) for t, r in held if t >= now]
            m, live = Matcher(*self.args), self.matcher.get()
            if live:
                m.load(live[0])
            free.sort(key=lambda r: [(r[c] is not None, r[c]) for c in self.order_by])
            for found in [*m.push(free, False), *m.expire(now)]:
                yield Row(**{self.key_name: key[0], **found})
            if free and stay:
                self.waiting.put(stay)
            elif free:
                self.waiting.clear()
            if m.rows:
                self.matcher.update((m.dump(),))
            elif live:
                self.matcher.clear()
            due = [min(t for t, _ in stay) + 1] if stay else []
            if m.within is not None and m.live:
                due.append(max(now, m.rows[m.live[0].start - m.base]["_mr_t"] + m.within) + 1)
            self._arm(min(due, default=None), None, armed)

        def close(self):
            pass

    return MatchProcessor


def match_recognize_stream(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                           pattern: Sequence[Var], define: dict, measures: dict, measure_schema: str,
                           after="PAST LAST ROW", within_ms: int | None = None,
                           subset: dict[str, Sequence[str]] | None = None, columns: Sequence[str] = (), back: int = 0,
                           groups: int | None = None) -> DataFrame:
    """Streaming execution (input must carry an event-time watermark on the first column of ``order_by``).  ``groups``: keep the state in
    so many groups of keys (:mod:`quern.streaming.groups`), for many small keys."""
    if len(partition_by) != 1:
        raise ValueError("one partition key column is supported")
    prepared, conditions, cols = _prepare(df, order_by, pattern, define, measures, columns)
    key = partition_by[0]
    schema = T.StructType([prepared.schema[key]] + list(T._parse_datatype_string(measure_schema).fields))
    args = (list(pattern), dict(measures), after, within_ms, order_by[0], order_by[-1], conditions, subset, back)
    rows, processor = prepared.select(*dict.fromkeys([key, *cols])), _match_processor_cls()(args, key, order_by)
    if groups:
        from quern.streaming.groups import transform_by_groups
        return transform_by_groups(rows, [key], processor, schema, "Append", "EventTime", groups)
    return rows.groupBy(key).transformWithState(processor, schema, "Append", "EventTime")
