"""Keyed state by groups of keys: the ``transformWithState`` processors of many small keys, at a cost that goes with the rows.

Spark serves a Python processor key by key: every key that a micro-batch touches costs a call to set it, a call over a socket for each look
at its state or timers, and an Arrow batch for its output, however few rows it has.  Here Spark's key is a *group* of keys (a hash of the
key, a fixed number of groups, as many as the stream needs to keep them small): the state of a group's keys is one value, read and written at most once a
micro-batch, and the processor finds its value, list and map state and its timers in memory, one key at a time, as it would in Spark.
A key stays in its group, so nothing else changes: rows of a key meet in one task, in a micro-batch the rows come before the timers, and a timer
goes off when the watermark has reached it.  The keys of a group are stored one by one inside the value: one that a micro-batch doesn't touch
isn't decoded, and a group of which nothing changed isn't written.

A group's state and its rows of one micro-batch are in memory at once."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo

#: Rows of the whole stream for each group, and the least number of groups: enough to spread over the state partitions.
GROUP_ROWS, LEAST_GROUPS = 4_096, 256


def groups_for(rows: int) -> int:
    """The number of groups for a stream of ``rows`` rows."""
    return max(LEAST_GROUPS, -(-rows // GROUP_ROWS))


class Fields(dict):
    """A row by the names of its columns; Spark's rows look a name up among all of theirs each time."""

    def asDict(self) -> dict:
        return dict(self)


class _State:
    """A state variable of the key at hand: its part of the key's cell."""

    def __init__(self, held: GroupedHandle, name: str):
        self.held, self.name = held, name

    def exists(self) -> bool:
        return self.name in self.held.cell

    def clear(self) -> None:
        self.held.cell.pop(self.name, None)


class ValueInGroup(_State):
    def get(self) -> tuple | None:
        return self.held.cell.get(self.name)

    def update(self, value: Sequence) -> None:
        self.held.cell[self.name] = tuple(value)


class ListInGroup(_State):
    def exists(self) -> bool:
        return bool(self.held.cell.get(self.name))

    def get(self) -> Iterator[tuple]:
        return iter(list(self.held.cell.get(self.name, ())))

    def put(self, values: Iterable[Sequence]) -> None:
        self.held.cell[self.name] = [tuple(v) for v in values]

    def appendValue(self, value: Sequence) -> None:
        self.appendList([value])

    def appendList(self, values: Iterable[Sequence]) -> None:
        self.held.cell.setdefault(self.name, []).extend(tuple(v) for v in values)


class MapInGroup(_State):
    def exists(self) -> bool:
        return bool(self.held.cell.get(self.name))

    def containsKey(self, key: Sequence) -> bool:
        return tuple(key) in self.held.cell.get(self.name, ())

    def getValue(self, key: Sequence) -> tuple | None:
        return self.held.cell.get(self.name, {}).get(tuple(key))

    def updateValue(self, key: Sequence, value: Sequence) -> None:
        self.held.cell.setdefault(self.name, {})[tuple(key)] = tuple(value)

    def removeKey(self, key: Sequence) -> None:
        self.held.cell.get(self.name, {}).pop(tuple(key), None)

    def iterator(self) -> Iterator[tuple[tuple, tuple]]:
        return iter(list(self.held.cell.get(self.name, {}).items()))

    def keys(self) -> Iterator[tuple]:
        return iter(list(self.held.cell.get(self.name, {})))

    def values(self) -> Iterator[tuple]:
        return iter(list(self.held.cell.get(self.name, {}).values()))


class GroupedHandle:
    """What a processor gets for Spark's handle: state and timers of the key at hand."""

    def __init__(self):
        self.cell: dict = {}
        self.timers: set[int] = set()

    def _variable(self, kind: type, name: str, ttl_ms: int | None):
        if ttl_ms:
            raise ValueError(f"{name}: state by groups of keys has no time to live")
        return kind(self, name)

    def getValueState(self, stateName: str, schema, ttlDurationMs: int | None = None) -> ValueInGroup:
        return self._variable(ValueInGroup, stateName, ttlDurationMs)

    def getListState(self, stateName: str, schema, ttlDurationMs: int | None = None) -> ListInGroup:
        return self._variable(ListInGroup, stateName, ttlDurationMs)

    def getMapState(self, stateName: str, userKeySchema, valueSchema, ttlDurationMs: int | None = None) -> MapInGroup:
        return self._variable(MapInGroup, stateName, ttlDurationMs)

    def registerTimer(self, expiryTimestampMs: int) -> None:
        self.timers.add(expiryTimestampMs)

    def deleteTimer(self, expiryTimestampMs: int) -> None:
        self.timers.discard(expiryTimestampMs)

    def listTimers(self) -> Iterator[int]:
        return iter(sorted(self.timers))


class KeyGroups(StatefulProcessor):
    """``processor`` for every key of a group.  A group's value is (its timer in Spark, key -> (first timer, pickled cell and timers)).  It has one
    timer, for the first of its keys'; those that the watermark has reached when the group has rows go off right after the rows."""

    def __init__(self, processor: StatefulProcessor, keys: Sequence[str], timed: bool):
        self.processor, self.keys, self.timed = processor, list(keys), timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.own = handle, GroupedHandle()
        self.group = handle.getValueState("group", "held binary")
        self.processor.init(self.own)

    def _load(self) -> tuple[int | None, dict]:
        found = self.group.get()
        return pickle.loads(found[0]) if found else (None, {})

    def _enter(self, held: dict, key: tuple) -> None:
        found = held.get(key)
        self.own.cell, timers = pickle.loads(found[1]) if found else ({}, ())
        self.own.timers = set(timers)

    def _leave(self, held: dict, key: tuple) -> bool:
        """Puts the key's state back; tells whether it changed."""
        cell, timers = {n: v for n, v in self.own.cell.items() if v or isinstance(v, tuple)}, sorted(self.own.timers)
        found = held.get(key)
        if not cell and not timers:
            return held.pop(key, None) is not None
        new = timers[0] if timers else None, pickle.dumps((cell, timers), pickle.HIGHEST_PROTOCOL)
        held[key] = new
        return new != found

    def _expire(self, held: dict, timerValues) -> Iterator:
        """Sets off the timers that the watermark has reached; returns whether anything changed."""
        mark, changed = timerValues.getCurrentWatermarkInMs(), False
        for key in [k for k, (first, _) in held.items() if first is not None and first <= mark]:
            self._enter(held, key)
            for at in sorted(t for t in self.own.timers if t <= mark):
                if at in self.own.timers:  # not deleted by one before
                    yield from self.processor.handleExpiredTimer(key, timerValues, ExpiredTimerInfo(at)) or ()
                    self.own.timers.discard(at)
            changed |= self._leave(held, key)
        return changed

    def _store(self, armed: int | None, fired: int | None, held: dict, changed: bool) -> None:
        first = min((t for t, _ in held.values() if t is not None), default=None) if self.timed else None
        if first != armed:
            if armed is not None and armed != fired:
                self.handle.deleteTimer(armed)
            if first is not None:
                self.handle.registerTimer(first)
        if changed or first != armed:
            if held:
                self.group.update((pickle.dumps((first, held), pickle.HIGHEST_PROTOCOL),))
            else:
                self.group.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        armed, held = self._load()
        changed, of_key = False, {}
        for r in rows:
            row = Fields(zip(r.__fields__, r))
            of_key.setdefault(tuple([row[k] for k in self.keys]), []).append(row)
        for k, mine in of_key.items():
            self._enter(held, k)
            yield from self.processor.handleInputRows(k, iter(mine), timerValues) or ()
            changed |= self._leave(held, k)
        if self.timed:
            changed |= yield from self._expire(held, timerValues)
        self._store(armed, None, held, changed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        armed, held = self._load()
        now = expiredTimerInfo.getExpiryTimeInMs()
        if armed != now:
            return  # replaced since
        changed = yield from self._expire(held, timerValues)
        self._store(armed, now, held, changed)

    def close(self) -> None:
        self.processor.close()


def _plain(kind: T.DataType) -> bool:
    """Values of the type are equal in Python when they are in Spark."""
    return isinstance(kind, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)) or kind.simpleString() == "string"


def transform_by_groups(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema, output_mode: str, time_mode: str,
                        groups: int) -> DataFrame:
    """``df.groupBy(keys).transformWithState(processor, ...)`` with the state in ``groups`` groups of keys.  ``df`` should hold no other columns than are
    used.  Keys of types that Python compares otherwise than Spark (floats, arrays, structs) are Spark's own."""
    from quern.session import ship_package
    ship_package(df.sparkSession)
    if time_mode == "ProcessingTime" or not all(_plain(df.schema[k].dataType) for k in keys):
        return df.groupBy(*keys).transformWithState(processor, schema, output_mode, time_mode)
    of = F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("_group")
    return df.select(of, *df.columns).groupBy("_group").transformWithState(KeyGroups(processor, keys, time_mode == "EventTime"), schema, output_mode, time_mode)
