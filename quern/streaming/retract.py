"""Aggregates of a changelog (AGG-03, AGG-16, UDF-03): rows are added (``+``) and taken back (``-``), results follow.

COUNT, SUM and AVG take back a row by subtracting it; MIN, MAX, LISTAGG and COUNT(DISTINCT) can't, so a key keeps the multiset of its values
(value -> copies) in map state.  The extremes are kept beside it: the multiset is read whole only after one of them has gone,
at most once a micro-batch.  Sums of doubles are kept as non-overlapping parts, so that taking back is exact.

Changes of a key commute: within a micro-batch equal rows are netted before the shuffle, Arrow batch by Arrow batch, and a row that is
taken back before it is added has a negative count until then.  A multiset that is small beside the changes of a micro-batch is read
at once instead of value by value.  The output is a changelog too: for each key whose result changed
in a micro-batch ``-`` with the old row, if there was one, and ``+`` with the new one, if the key still has rows.
Nulls and NaN are no values; a key of nulls only has a row of nulls (count 0).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

COUNTED = ("min", "max", "count_distinct", "listagg")
#: A multiset of at most so many values for each changed one is read whole; so is that of LISTAGG, which needs it anyway.
WHOLE = 8
#: Types whose values come back from the state as they went in.
PLAIN = (T.IntegralType, T.DoubleType, T.StringType, T.BooleanType)


@dataclass(frozen=True)
class Agg:
    """``fn`` of ``column``: count (of rows without a column), sum, avg, min, max, count_distinct, listagg (values in order of ``order``,
    then by value, equal ones as often as they are there)."""

    fn: str
    column: str | None = None
    order: str | None = None
    delimiter: str = ","

    def __post_init__(self):
        if self.fn not in ("count", "sum", "avg", *COUNTED) or (self.column is None and self.fn != "count"):
            raise ValueError(f"not an aggregate: {self.fn}({self.column})")

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(c for c in (self.order, self.column) if c is not None))


def plus(parts: list, x) -> list:
    """``parts`` with ``x`` added: doubles that don't overlap, whose sum is exact; other numbers add up as they are."""
    if not isinstance(x, float):
        return [parts[0] + x if parts else x]
    out = []
    for y in parts:
        if abs(x) < abs(y):
            x, y = y, x
        high = x + y
        low = y - (high - x)
        if low:
            out.append(low)
        x = high
    return [*out, x] if x else out


class RetractAggregates(StatefulProcessor):
    def __init__(self, aggs: dict[str, Agg], schema: T.StructType, make: Sequence[str]):
        self.aggs, self.make = list(aggs.values()), Row(*make)
        self.types = [T.StructType([schema[c] for c in a.columns]) for a in self.aggs]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "sums binary")
        self.values = {i: handle.getMapState(f"values{i}", self.types[i], "copies long") for i, a in enumerate(self.aggs) if a.fn in COUNTED}

    def _result(self, kept: list, i: int):
        a, s = self.aggs[i], kept[i]
        if a.fn in ("count", "count_distinct"):
            return s["n"]
        if a.fn in ("min", "max"):
            return s.get("top")
        if a.fn == "listagg":
            return s.get("text")
        total = sum(s["parts"]) if s["n"] else None
        return total if a.fn == "sum" or total is None else total / s["n"]

    def _count(self, i: int, s: dict, changes: dict) -> None:
        """Brings the multiset up to date, and what is kept beside it."""
        a, state, gone = self.aggs[i], self.values[i], False
        best = min if a.fn == "min" else max
        whole = (a.fn == "listagg" or s["n"] <= WHOLE * len(changes)) and all(isinstance(f.dataType, PLAIN) for f in self.types[i])
        held = {tuple(k): (tuple(k), n[0]) for k, n in state.iterator()} if whole else {}
        for v, by in changes.items():
            if whole:
                v, old = held.get(v, (v, 0))
                held[v] = v, old + by
            else:
                old = state.getValue(v)[0] if state.containsKey(v) else 0
            if old + by:
                state.updateValue(v, (old + by,))
            elif old:
                state.removeKey(v)
            came, left = old <= 0 < old + by, old + by <= 0 < old
            s["n"] += came - left
            if a.fn in ("min", "max"):
                if came:
                    s["top"] = v[-1] if s.get("top") is None else best(s["top"], v[-1])
                gone |= left and v[-1] == s["top"]
        now = lambda: (kn for kn in (held.values() if whole else ((tuple(k), n[0]) for k, n in state.iterator())) if kn[1] > 0)
        if gone:
            s["top"] = best((k[0] for k, _ in now()), default=None)
        if a.fn == "listagg":
            kept = sorted(now(), key=lambda x: [(y is not None, y) for y in x[0]])
            s["text"] = a.delimiter.join(str(k[-1]) for k, n in kept for _ in range(n)) if kept else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.sums.get()
        before = pickle.loads(stored[0]) if stored else None
        n, kept, old = before or (0, [{"n": 0, "parts": []} for _ in self.aggs], None)
        changes: dict[int, dict] = {i: {} for i in self.values}
        for r in rows:
            by = r["_by"]
            n += by
            for i, a in enumerate(self.aggs):
                v = r[f"_v_{a.column}"] if a.column else True
                if v is None or v != v:
                    continue
                if i in changes:
                    held = tuple(r[f"_v_{c}"] for c in a.columns)
                    changes[i][held] = changes[i].get(held, 0) + by
                    continue
                s = kept[i]
                s["n"] += by
                if a.fn != "count":
                    copies, v = (by, v) if by > 0 else (-by, -v)
                    while copies:  # v times a power of two loses no digit
                        if copies % 2:
                            s["parts"] = plus(s["parts"], v)
                        copies, v = copies // 2, v * 2
        for i, c in changes.items():
            c = {v: by for v, by in c.items() if by}
            if c:
                self._count(i, kept[i], c)
        new = tuple(self._result(kept, i) for i in range(len(self.aggs))) if n > 0 else None
        if new != old:
            if old is not None:
                yield self.make("-", *key, *old)
            if new is not None:
                yield self.make("+", *key, *new)
        if n or any(s["n"] for s in kept) or any(next(iter(m.iterator()), None) for m in self.values.values()):
            self.sums.update((pickle.dumps((n, kept, new)),))
        elif stored:
            self.sums.clear()

    def close(self) -> None:
        pass


class Held(dict):
    """Map state of one key in memory."""

    containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.__getitem__, dict.__setitem__, dict.__delitem__

    def iterator(self) -> Iterator:
        return iter(list(self.items()))


class PartAggregates(RetractAggregates):
    """Of a part of a key, which is small: its multisets are one value, read and written once a micro-batch, as each call to the
    state store costs far more than a row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "sums binary")
        self.stored = handle.getValueState("multisets", "multisets binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = self.stored.get()
        held = pickle.loads(found[0]) if found else {}
        self.values = {i: Held(held.get(i, {})) for i, a in enumerate(self.aggs) if a.fn in COUNTED}
        yield from super().handleInputRows(key, rows, timerValues)
        if any(self.values.values()):
            self.stored.update((pickle.dumps({i: dict(m) for i, m in self.values.items()}),))
        elif found:
            self.stored.clear()


def netted(changes: DataFrame, keys: Sequence[str], columns: Sequence[str], op: str) -> DataFrame:
    """Keys, ``_v_`` columns and ``_by``: equal rows of an Arrow batch as one, with the number added less the number taken back.
    It keeps no state, so it may stand in a stream before the shuffle."""
    names = [*[f"_k{i}" for i in range(len(keys))], *[f"_v_{c}" for c in columns]]
    named = changes.select(*[F.col(k).alias(n) for k, n in zip([*keys, *columns], names)],
                           F.when(F.col(op) == "+", F.lit(1)).otherwise(F.lit(-1)).cast("long").alias("_by"))

    def net(batches):
        import pyarrow as pa
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(names).aggregate([("_by", "sum")])
            t = t.filter(pa.compute.not_equal(t["_by_sum"], 0)).select([*names, "_by_sum"]).rename_columns([*names, "_by"])
            yield from t.cast(b.schema).to_batches()

    return named.mapInArrow(net, named.schema)


def retract_aggregate(changes: DataFrame, keys: Sequence[str], aggs: dict[str, Agg], op: str = "op", parts: int = 1,
                      groups: int | None = None) -> DataFrame:
    """Changelog of the aggregates, by name, of the changelog ``changes`` for each combination of ``keys``: op, the keys, the aggregates.

    ``parts`` is for few keys that hold very many rows, each of which else is one task's: a key's rows are dealt by their values over so many
    parts (:class:`PartAggregates`), and the changelogs of the parts, a row or two each, are aggregated in turn.  COUNT, MIN and MAX can be put
    together so; rows that are taken back must have been added, or come to be.  ``groups`` is for many small keys: their state is kept in so many
    groups of them (:mod:`quern.streaming.groups`)."""
    return _aggregates(changes, keys, aggs, op, parts, RetractAggregates, groups)


def _aggregates(changes: DataFrame, keys: Sequence[str], aggs: dict[str, Agg], op: str, parts: int, kind_of: type,
                groups: int | None = None) -> DataFrame:
    columns = list(dict.fromkeys(c for a in aggs.values() for c in a.columns))
    if parts > 1:
        if odd := [a.fn for a in aggs.values() if a.fn not in ("count", "min", "max")]:
            raise ValueError(f"not an aggregate of parts: {', '.join(odd)}")
        # Equal doubles are one value, and a row is taken back where it was added.
        same = [F.col(c) + F.lit(0.0) if isinstance(changes.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c) for c in columns]
        dealt = changes.withColumn("_part", F.pmod(F.xxhash64(*same), F.lit(parts)) if same else F.lit(0))
        each = _aggregates(dealt, [*keys, "_part"], aggs, op, 1, PartAggregates)
        return retract_aggregate(each, keys, {n: Agg("sum" if a.fn == "count" else a.fn, n) for n, a in aggs.items()}, op, groups=groups)
    rows = netted(changes, keys, columns, op)

    def kind(a: Agg) -> T.DataType:
        if a.fn in ("count", "count_distinct"):
            return T.LongType()
        if a.fn == "listagg":
            return T.StringType()
        of = changes.schema[a.column].dataType
        if a.fn in ("min", "max"):
            return of
        if isinstance(of, T.DecimalType):
            return T.DecimalType(38, of.scale) if a.fn == "sum" else T.DecimalType(38, min(38, of.scale + 4))
        return T.LongType() if a.fn == "sum" and isinstance(of, T.IntegralType) else T.DoubleType()

    out = T.StructType([T.StructField(op, T.StringType()), *[T.StructField(k, changes.schema[k].dataType) for k in keys],
                        *[T.StructField(n, kind(a)) for n, a in aggs.items()]])
    processor = kind_of(aggs, changes.schema, out.fieldNames())
    by = [f"_k{i}" for i in range(len(keys))]
    if groups:
        from quern.streaming.groups import transform_by_groups
        return transform_by_groups(rows, by, processor, out, "Append", "None", groups)
    return rows.groupBy(*by).transformWithState(processor, out, "Append", "None")
