"""Keyed stateful operators on ``transformWithState`` (STR-27..43, OVR-05,
SET-02, STR-23).

Each processor keeps only per-key state in the state store (RocksDB) and sees
one micro-batch of a key at a time, so memory is bounded by the batch, not by
the history of the key.  Within a micro-batch the rows of a key are put in
event-time order first (arrival order inside a batch is not defined after the
shuffle).  The same processors run on bounded tables: a batch
``transformWithState`` is one big micro-batch.
"""

from __future__ import annotations

import datetime as _dt
import pickle
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_EPOCH = _dt.datetime(1970, 1, 1)


def to_ms(ts) -> int:
    if ts is None:
        return 0
    if ts.tzinfo is not None:
        ts = ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return (ts - _EPOCH) // _dt.timedelta(milliseconds=1)


def from_ms(ms: int) -> _dt.datetime:
    return _EPOCH + _dt.timedelta(milliseconds=ms)


def _sorted(rows, ts: str, tie: str | None):
    """Rows of a key and micro-batch in event-time order; rows without a time are left out."""
    key = (lambda r: (r[ts], r[tie])) if tie else (lambda r: r[ts])
    return sorted((r for r in rows if r[ts] is not None), key=key)


class CountTrigger(StatefulProcessor):
    """STR-27 / STR-29: GlobalWindow + CountTrigger(n): fire after every n-th
    row of a key with the window's count and sum; ``purge`` clears the window
    after firing (PurgingTrigger)."""

    def __init__(self, n: int, value: str, ts: str, tie: str | None = None, purge: bool = False):
        self.n, self.value, self.ts, self.tie, self.purge = n, value, ts, tie, purge

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.st = handle.getValueState("acc", "seen long, cnt long, total double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen, cnt, total = self.st.get() or (0, 0, 0.0)
        for r in _sorted(rows, self.ts, self.tie):
            seen += 1
            cnt += 1
            total += r[self.value] or 0.0
            fire = (cnt == self.n) if self.purge else (cnt % self.n == 0)
            if fire:
                yield Row(key=key[0], fire_seq=seen, cnt=cnt, total=round(total, 2))
                if self.purge:
                    cnt, total = 0, 0.0
        self.st.update((seen, cnt, total))

    def close(self) -> None:
        pass


class DeltaTrigger(StatefulProcessor):
    """STR-28: fire when |value - value of the last fired row| > threshold.
    The first row of a key only sets the reference value.  Emits the firing
    row and the number of rows in the (non-purged) window so far."""

    def __init__(self, threshold: float, value: str, ts: str, tie: str | None = None):
        self.threshold, self.value, self.ts, self.tie = threshold, value, ts, tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.st = handle.getValueState("last", "has boolean, last double, cnt long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        has, last, cnt = self.st.get() if self.st.exists() else (False, 0.0, 0)
        for r in _sorted(rows, self.ts, self.tie):
            v = r[self.value]
            cnt += 1
            if not has:
                has, last = True, v
            elif abs(v - last) > self.threshold:
                last = v
                yield Row(key=key[0], event_id=r[self.tie] if self.tie else None, value=v, cnt=cnt)
        self.st.update((has, last, cnt))

    def close(self) -> None:
        pass


class CustomTrigger(StatefulProcessor):
    """STR-31: a user trigger: fire on a row with value > ``limit`` and purge;
    emits the number and sum of rows since the previous firing (inclusive)."""

    def __init__(self, limit: float, value: str, ts: str, tie: str | None = None):
        self.limit, self.value, self.ts, self.tie = limit, value, ts, tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.st = handle.getValueState("pane", "cnt long, total double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        cnt, total = self.st.get() if self.st.exists() else (0, 0.0)
        for r in _sorted(rows, self.ts, self.tie):
            cnt += 1
            total += r[self.value]
            if r[self.value] > self.limit:
                yield Row(key=key[0], fired_by=r[self.tie], cnt=cnt, total=round(total, 2))
                cnt, total = 0, 0.0
        self.st.update((cnt, total))

    def close(self) -> None:
        pass


class InactivityTimeout(StatefulProcessor):
    """STR-37 / STR-39 keyed process function with event-time timers, and STR-31 merging windows: a burst
    of activity ends when no row follows within ``gap_ms``; the timer at last + gap emits (key, start, end = last + gap, count).

    A key's bursts are an interval set (start, last, count), in order and further than the gap from each other, so those that are open are no more
    than the watermark's delay has gaps; they are stored as one value.  A row, in whatever order it comes, joins
    every burst that it touches, so one that lies between two makes them one, their counts added; a burst leaves when the
    watermark reaches its end, not before.  A key has one timer, for the end that comes first.
    ``held_back_ms`` says by how much Spark's watermark lies behind the one meant:
    with a gap or more, rows that still touch an open burst's end aren't dropped by Spark."""

    def __init__(self, gap_ms: int, ts: str, tie: str | None = None, held_back_ms: int = 0):
        self.gap, self.ts, self.tie, self.held_back = gap_ms, ts, tie, held_back_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bursts = handle.getMapState("bursts", "part int", "held binary")

    def _held(self) -> tuple[int | None, list]:
        """When the timer goes off, if one is set, and the bursts."""
        found = [pickle.loads(v[0]) for _, v in self.bursts.iterator()]
        return found[0] if found else (None, [])

    def _due(self, key, held: list, mark: int) -> Iterator[Row]:
        n = 0
        for start, last, cnt in held:
            if last + self.gap > mark:
                break
            n += 1
            yield Row(key=key[0], session_start=from_ms(start), session_end=from_ms(last + self.gap), cnt=cnt)
        del held[:n]

    def _settle(self, armed: int | None, held: list, before: tuple) -> None:
        if held:
            first = held[0][1] + self.gap - self.held_back
            if armed is None or first < armed:
                self.handle.registerTimer(first)
                armed = first
            if (armed, held) != before:
                self.bursts.updateValue((0,), (pickle.dumps((armed, held)),))
        elif before[1]:
            self.bursts.removeKey((0,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() + self.held_back
        armed, held = self._held()
        before = armed, [*held]
        yield from self._due(key, held, mark)
        for r in _sorted(rows, self.ts, self.tie):
            t = to_ms(r[self.ts])
            low = high = bisect_right(held, t + self.gap, key=lambda b: b[0])
            while low and t <= held[low - 1][1] + self.gap:
                low -= 1
            touched = held[low:high]
            if not touched and t + self.gap < mark:
                continue  # too late to open a burst
            held[low:high] = [(min(t, touched[0][0]), max(t, touched[-1][1]), 1 + sum(n for _, _, n in touched)) if touched else (t, t, 1)]
        self._settle(armed, held, before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        armed, held = self._held()
        before = armed, [*held]
        yield from self._due(key, held, max(timerValues.getCurrentWatermarkInMs(), now) + self.held_back)
        self._settle(None if armed is None or armed <= now else armed, held, before)

    def close(self) -> None:
        pass


class PendingTimeout(StatefulProcessor):
    """STR-39 timers registered and deleted: a ``start`` row arms a timer at
    ts + timeout, a ``stop`` row of the key disarms every pending one; an
    alert is emitted for each start whose timer goes off."""

    def __init__(self, timeout_ms: int, kind: str, start: str, stop: str, ts: str, tie: str):
        self.timeout, self.kind, self.start, self.stop, self.ts, self.tie = timeout_ms, kind, start, stop, ts, tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "t long, id long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pend = list(self.pending.get()) if self.pending.exists() else []
        pend = [(p[0], p[1]) for p in pend]
        for r in _sorted(rows, self.ts, self.tie):
            t = to_ms(r[self.ts])
            # timers that would have gone off before this row
            due = [p for p in pend if p[0] + self.timeout < t]
            for p in due:
                self.handle.deleteTimer(p[0] + self.timeout)
                yield Row(key=key[0], start_id=p[1], start_ts=from_ms(p[0]))
            pend = [p for p in pend if p not in due]
            if r[self.kind] == self.start:
                pend.append((t, r[self.tie]))
                self.handle.registerTimer(t + self.timeout)
            elif r[self.kind] == self.stop:
                for p in pend:
                    self.handle.deleteTimer(p[0] + self.timeout)
                pend = []
        self.pending.clear()
        if pend:
            self.pending.put(pend)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        exp = expiredTimerInfo.getExpiryTimeInMs()
        pend = [(p[0], p[1]) for p in self.pending.get()] if self.pending.exists() else []
        keep = []
        for p in pend:
            if p[0] + self.timeout <= exp:
                yield Row(key=key[0], start_id=p[1], start_ts=from_ms(p[0]))
            else:
                keep.append(p)
        self.pending.clear()
        if keep:
            self.pending.put(keep)

    def close(self) -> None:
        pass


class StateKinds(StatefulProcessor):
    """STR-40 value, list and map state of one key: total count (value), the
    last three ids (list), count per category (map).  Emits the changed
    categories with their counts (update mode)."""

    def __init__(self, category: str, ts: str, tie: str, ttl_ms: int | None = None,
                 retention_ms: int | None = None):
        self.category, self.ts, self.tie, self.ttl = category, ts, tie, ttl_ms
        self.retention = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.ttl:
            # processing-time TTL of the state store (ProcessingTime mode)
            self.total = handle.getValueState("total", "n long", self.ttl)
        else:
            self.total = handle.getValueState("total", "n long")
        self.last_seen = handle.getValueState("last_seen", "t long")
        self.recent = handle.getListState("recent", "id long")
        self.per = handle.getMapState("per", "category string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = self.total.get()[0] if self.total.exists() else 0
        recent = [x[0] for x in self.recent.get()] if self.recent.exists() else []
        changed = {}
        rows_seen_last = None
        for r in _sorted(rows, self.ts, self.tie):
            rows_seen_last = to_ms(r[self.ts])
            n += 1
            recent = (recent + [r[self.tie]])[-3:]
            c = r[self.category]
            cur = changed.get(c)
            if cur is None:
                cur = self.per.getValue((c,))[0] if self.per.containsKey((c,)) else 0
            changed[c] = cur + 1
        for c, v in changed.items():
            self.per.updateValue((c,), (v,))
        self.total.update((n,))
        if self.retention and rows_seen_last is not None:
            # STR-41 idle-state retention in event time: a timer one retention
            # period after the key's latest row clears its state
            if self.last_seen.exists():
                self.handle.deleteTimer(self.last_seen.get()[0] + self.retention)
            self.last_seen.update((rows_seen_last,))
            self.handle.registerTimer(rows_seen_last + self.retention)
        self.recent.clear()
        self.recent.put([(x,) for x in recent])
        for c, v in changed.items():
            yield Row(key=key[0], category=c, cnt=v, total=n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last_seen.exists() and self.last_seen.get()[0] + self.retention <= expiredTimerInfo.getExpiryTimeInMs():
            self.total.clear()
            self.recent.clear()
            self.per.clear()
            self.last_seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def partial_totals(df, keys: list[str], value: str, count: str):
    """The rows of a stream added up by key before the shuffle, an Arrow batch at a time: the keys, the sum of ``value`` and in ``count``
    the number of rows.  A key that most rows have reaches its one task as a few rows of every read task.  No state is kept."""
    def added(batches):
        import pyarrow as pa
        for b in batches:
            sums = pa.Table.from_batches([b]).group_by(keys).aggregate([(value, "sum"), ([], "count_all")])
            yield from sums.select([*keys, f"{value}_sum", "count_all"]).rename_columns([*keys, value, count]).combine_chunks().to_batches()

    rows = df.select(*keys, F.col(value).cast("double").alias(value))
    kinds = ", ".join(f"`{c}` {k}" for c, k in rows.dtypes)
    return rows.mapInArrow(added, f"{kinds}, `{count}` long")


class Changelog(StatefulProcessor):
    """STR-23 retract stream of a keyed count / sum: for every change of a
    key's result, ``-`` with the old row (if any) and ``+`` with the new one.
    ``count`` names the column of rows that stand for several (:func:`partial_totals`)."""

    def __init__(self, value: str, count: str | None = None):
        self.value, self.count = value, count

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.st = handle.getValueState("agg", "cnt long, total double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.st.get()
        cnt, total = old if old else (0, 0.0)
        for r in rows:
            cnt += r[self.count] if self.count else 1
            total += r[self.value] or 0.0
        if old is not None:
            yield Row(op="-", key=key[0], cnt=old[0], total=old[1])
        yield Row(op="+", key=key[0], cnt=cnt, total=total)
        self.st.update((cnt, total))

    def close(self) -> None:
        pass


class EventTimeOrdered(StatefulProcessor):
    """SET-02 temporal sort and OVR-05 streaming OVER: rows are buffered
    until the watermark passes their time, then released in event-time order
    with a per-key sequence number and running sum (ROWS UNBOUNDED PRECEDING
    to CURRENT ROW).  A key has one timer, for the first row that waits; it
    releases all that the watermark has passed."""

    #: No timer is set.
    UNSET = -(1 << 63)

    def __init__(self, ts: str, tie: str, value: str):
        self.ts, self.tie, self.value = ts, tie, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", "t long, id long, v double")
        self.acc = handle.getValueState("acc", "seq long, total double, armed long")

    def _release(self, key, upto: int):
        seq, total, armed = self.acc.get() or (0, 0.0, self.UNSET)
        if armed == self.UNSET or armed > upto:
            return
        keep = []
        for t, i, v in sorted((b[0], b[1], b[2]) for b in self.buf.get()):
            if t <= upto:
                seq += 1
                total += v or 0.0
                yield Row(key=key[0], seq=seq, event_id=i, ts=from_ms(t), running_sum=round(total, 2))
            else:
                keep.append((t, i, v))
        if keep:
            self.buf.put(keep)
            self.handle.registerTimer(keep[0][0])
        else:
            self.buf.clear()
        self.acc.update((seq, total, keep[0][0] if keep else self.UNSET))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(to_ms(r[self.ts]), r[self.tie], r[self.value]) for r in rows if r[self.ts] is not None]
        if new:
            self.buf.appendList(new)
            seq, total, armed = self.acc.get() or (0, 0.0, self.UNSET)
            first = min(t for t, _, _ in new)
            if armed == self.UNSET or first < armed:
                self.handle.registerTimer(first)
                self.acc.update((seq, total, first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._release(key, max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()))

    def close(self) -> None:
        pass


class LatestOfOther(StatefulProcessor):
    """STR-38 two-input keyed process over a tagged union: side ``ref`` rows
    update the key's state, side ``probe`` rows are emitted with the latest
    ``ref`` id seen before them."""

    def __init__(self, tag: str, ref: str, probe: str, ts: str, tie: str):
        self.tag, self.ref, self.probe, self.ts, self.tie = tag, ref, probe, ts, tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.st = handle.getValueState("latest", "id long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        latest = self.st.get()[0] if self.st.exists() else None
        for r in _sorted(rows, self.ts, self.tie):
            if r[self.tag] == self.ref:
                latest = r[self.tie]
            elif r[self.tag] == self.probe:
                yield Row(key=key[0], probe_id=r[self.tie], ref_id=latest)
        if latest is not None:
            self.st.update((latest,))

    def close(self) -> None:
        pass


def partial_top(df, keys: list[str], n: int, value: str, tie: str):
    """The rows of a stream that can be among the first ``n`` of their key, by falling ``value`` and rising ``tie``: an Arrow batch at a time,
    before the shuffle, no more than ``n`` of a key.  Rows without a tie or a finite value are not put in that order; they all stay."""
    def first(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            t = pa.Table.from_batches([b])
            placed = pc.fill_null(pc.and_(pc.is_finite(t[value]), pc.is_valid(t[tie])), False)
            yield from t.filter(pc.invert(placed)).combine_chunks().to_batches()
            t = t.filter(placed)
            t = t.take(pc.sort_indices(t, sort_keys=[(value, "descending"), (tie, "ascending")]))
            t = t.append_column("_row", pa.array(range(len(t)), pa.int64()))
            of_key = t.group_by(keys, use_threads=False).aggregate([("_row", "list")])["_row_list"]
            kept = t.take(pc.list_flatten(pc.list_slice(of_key, 0, n)))
            yield from kept.drop_columns("_row").combine_chunks().to_batches()

    rows = df.select(*keys, value, tie)
    return rows.mapInArrow(first, rows.schema)


class TopN(StatefulProcessor):
    """OVR-14 on a stream: keyed top-N kept in list state; every change emits
    the key's current top-N (update mode, rank is part of the output key)."""

    def __init__(self, n: int, value: str, tie: str):
        self.n, self.value, self.tie = n, value, tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getListState("top", "v double, id long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        cur = [(t[0], t[1]) for t in self.top.get()] if self.top.exists() else []
        cand = cur + [(r[self.value], r[self.tie]) for r in rows]
        best = sorted(cand, key=lambda x: (-x[0], x[1]))[: self.n]
        if best != cur:
            self.top.clear()
            self.top.put(best)
            for i, (v, ident) in enumerate(best, 1):
                yield Row(key=key[0], rank_num=i, event_id=ident, value=v)

    def close(self) -> None:
        pass


# --- STR-43: keyed state machine ------------------------------------------------

# Transition table of the study's state machine (fixed values):
#   Initial: a -> W, c -> X;  W: b -> Y;  X: b -> Y, d -> Z;  Y: e -> Z;  Z: g -> Terminal
STATE_MACHINE = {
    "Initial": {"a": "W", "c": "X"},
    "W": {"b": "Y"},
    "X": {"b": "Y", "d": "Z"},
    "Y": {"e": "Z"},
    "Z": {"g": "Terminal"},
}


class StateMachine(StatefulProcessor):
    """Per-key state machine: an event without a transition from the current
    state raises an alert (key, state, event) and leaves the state as it
    was; reaching a terminal state clears the key's state."""

    def __init__(self, event: str, ts: str, tie: str, table: dict | None = None,
                 initial: str = "Initial"):
        self.event, self.ts, self.tie = event, ts, tie
        self.table, self.initial = table or STATE_MACHINE, initial

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.st = handle.getValueState("state", "s string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.st.get()[0] if self.st.exists() else self.initial
        for r in _sorted(rows, self.ts, self.tie):
            ev = r[self.event]
            nxt = self.table.get(state, {}).get(ev)
            if nxt is None:
                yield Row(address=key[0], state=state, transition=ev, event_id=r[self.tie])
            elif nxt not in self.table:       # terminal: no outgoing transitions
                state = self.initial
            else:
                state = nxt
        if state == self.initial:
            self.st.clear()
        else:
            self.st.update((state,))

    def close(self) -> None:
        pass
