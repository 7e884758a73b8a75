"""Reducing and aggregating state (STR-40), and state that goes when its key is idle (STR-41).

An accumulator is what the state holds, one value of a fixed schema for each key: ``create`` begins it, ``add`` takes a row,
``merge`` joins two of them, ``result`` is what is emitted.  ``accumulate`` merges the rows of a key within each Arrow batch before
the shuffle, so that a hot key sends a row a batch, and merges what arrives into the state.

``accumulate_until_idle`` clears a key that is idle.  A key's clean-up time is set to ``longest`` after its first row and moved to
``longest`` after a later row only if it would otherwise be less than ``shortest`` away: so a key is kept for at least
``shortest`` and at most ``longest`` after its last row, and a busy key renews its timer once in ``longest - shortest``, not with
every row.  Time is event time: rows of a micro-batch are taken in its order, and a row at the clean-up time or later finds no
state, whether the watermark has fired the timer yet or not.  There, rows can't be merged before the shuffle, because the gaps
between them count; a key's rows of one micro-batch are in memory at once.  A row without a time is left out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quern.streaming.processors import _sorted, to_ms


@dataclass(frozen=True)
class Accumulator:
    """``schema``: fields of the state (DDL); ``type``: of the result (DDL)."""
    schema: str
    type: str
    create: Callable[[], tuple | None]
    add: Callable[[tuple | None, Any], tuple | None]
    merge: Callable[[tuple | None, tuple | None], tuple | None]
    result: Callable[[tuple | None], Any]


def aggregating(schema: str, result_type: str, create, add, merge, result) -> Accumulator:
    return Accumulator(schema, result_type, create, add, merge, result)


def reducing(schema: str, value: Callable[[Any], tuple | None], reduce: Callable[[tuple, tuple], tuple]) -> Accumulator:
    """The values of the rows (tuples of ``schema``; ``None``: the row has none) reduced two at a time; the result is the
    value itself, null without any."""
    def merge(a, b):
        return b if a is None else a if b is None else reduce(a, b)

    return Accumulator(schema, f"struct<{schema}>", lambda: None, lambda acc, row: merge(acc, value(row)), merge, lambda acc: acc)


def _plain(value):
    """A struct as a tuple; Spark hands columns over as dicts, state as rows."""
    return None if value is None else tuple(value.values()) if isinstance(value, dict) else tuple(value)


class Accumulate(StatefulProcessor):
    """One value state an accumulator.  ``idle`` is (shortest, longest, time column, tie column), or None for merged rows."""

    def __init__(self, keys: Sequence[str], accs: dict[str, Accumulator], idle: tuple | None = None):
        self.keys, self.accs, self.idle = list(keys), accs, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = {n: handle.getValueState(n, a.schema) for n, a in self.accs.items()}
        if self.idle:
            self.due = handle.getValueState("_due", "due long")

    def _load(self) -> dict:
        return {n: _plain(s.get()) if s.exists() else self.accs[n].create() for n, s in self.states.items()}

    def _store(self, held: dict) -> None:
        for n, s in self.states.items():
            if held[n] is None:
                s.clear()
            else:
                s.update(tuple(held[n]))

    def _row(self, key, held: dict) -> Row:
        return Row(**dict(zip(self.keys, key)), **{n: a.result(held[n]) for n, a in self.accs.items()})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._load()
        if not self.idle:
            for r in rows:
                for n, a in self.accs.items():
                    held[n] = a.merge(held[n], _plain(r[n]))
            self._store(held)
            yield self._row(key, held)
            return
        shortest, longest, ts, tie = self.idle
        timer = due = self.due.get()[0] if self.due.exists() else None
        for r in _sorted(rows, ts, tie):
            now = to_ms(r[ts])
            if due is not None and now >= due:
                yield self._row(key, held)
                held, due = {n: a.create() for n, a in self.accs.items()}, None
            if due is None or now + shortest > due:
                due = now + longest
            for n, a in self.accs.items():
                held[n] = a.add(held[n], r)
        self._store(held)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.due.update((due,))
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.due.exists() and self.due.get()[0] <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._row(key, self._load())
            for s in (*self.states.values(), self.due):
                s.clear()

    def close(self) -> None:
        pass


def _output(df: DataFrame, keys, accs) -> T.StructType:
    return T.StructType([df.schema[k] for k in keys]
                        + [T.StructField(n, T._parse_datatype_string(a.type)) for n, a in accs.items()])


def _keyed(df: DataFrame, keys, processor: Accumulate, schema: T.StructType, output_mode: str, time_mode: str, groups: int | None) -> DataFrame:
    if groups:
        from quern.streaming.groups import transform_by_groups
        return transform_by_groups(df, keys, processor, schema, output_mode, time_mode, groups)
    return df.groupBy(*keys).transformWithState(processor, schema, output_mode, time_mode)


def accumulate(df: DataFrame, keys: Sequence[str], accs: dict[str, Accumulator], groups: int | None = None) -> DataFrame:
    """The results of each key a micro-batch touches (update mode).  ``df`` should hold no other columns than are used.  ``groups``: keep the
    state in so many groups of keys (:mod:`quern.streaming.groups`)."""
    keys = list(keys)
    state = {n: T._parse_datatype_string(a.schema) for n, a in accs.items()}
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(n, s) for n, s in state.items()])
    names = {n: s.names for n, s in state.items()}

    def partials(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            held: dict[tuple, dict] = {}
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key not in held:
                    held[key] = {n: a.create() for n, a in accs.items()}
                cur = held[key]
                for n, a in accs.items():
                    cur[n] = a.add(cur[n], row)
            if held:
                yield pa.RecordBatch.from_pylist(
                    [{**dict(zip(keys, key)), **{n: None if v is None else dict(zip(names[n], v)) for n, v in cur.items()}}
                     for key, cur in held.items()], schema=arrow)

    merged = df.mapInArrow(partials, schema)
    return _keyed(merged, keys, Accumulate(keys, accs), _output(df, keys, accs), "Update", "None", groups)


def accumulate_until_idle(df: DataFrame, keys: Sequence[str], accs: dict[str, Accumulator], ts: str, tie: str | None = None, *,
                          shortest_ms: int, longest_ms: int, groups: int | None = None) -> DataFrame:
    """One row whenever a key's state is cleared.  ``df`` needs a watermark on ``ts``."""
    if not 0 < shortest_ms <= longest_ms:
        raise ValueError("0 < shortest <= longest")
    return _keyed(df, list(keys), Accumulate(keys, accs, (shortest_ms, longest_ms, ts, tie)), _output(df, keys, accs), "Append", "EventTime", groups)
