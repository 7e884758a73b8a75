"""STR-21, STR-26, STR-30: event-time windows that fire early, on time and for every late row.

A tumbling window of a key fires

* early, at the points ``start + j * early`` that the watermark passes before the end, if rows came since the last firing,
* on time, when the watermark passes the end,
* late, for each row that comes after that and before the end of the allowed lateness; then the window is forgotten
  and later rows are dropped.

The watermark is the largest event time of earlier micro-batches less ``bound``.  Spark itself drops rows older than
its own watermark, so that one is held back by the lateness and a window's size besides (:func:`timed_windows`), and the
processor adds both again: no row that a window still waits for is lost.  A new watermark acts before the rows
of its micro-batch do, in the row handler for keys with rows and by timers for all others.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quern.streaming.processors import from_ms, to_ms

_OUT = ("key", "window_start", "firing", "at", "cnt", "total")


class TimedWindows(StatefulProcessor):
    def __init__(self, size_ms: int, lateness_ms: int, early_ms: int | None, ts: str, value: str, order: str):
        self.size, self.lateness, self.early = size_ms, lateness_ms, early_ms
        self.ts, self.value, self.order = ts, value, order
        self.held_back = size_ms + lateness_ms  # of Spark's watermark
        self.make = Row(*_OUT)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start long", "cnt long, total double, fired boolean, point long, told long")

    def _advance(self, key, start: int, w: list, mark: int) -> Iterator[Row]:
        """What the watermark ``mark`` does to a window: w is [cnt, total, fired, early points passed, cnt when last told]."""
        end = start + self.size - 1
        if not w[2] and mark >= end:
            w[2] = True
            yield self._row(key, start, "on time", end, w)
        elif not w[2] and self.early:
            point = (mark - start) // self.early
            if point > w[3]:
                w[3] = point
                if w[0] > w[4]:
                    yield self._row(key, start, "early", start + point * self.early, w)

    def _row(self, key, start: int, firing: str, at: int, w: list) -> Row:
        w[4] = w[0]
        return self.make(key[0], from_ms(start), firing, from_ms(at), w[0], round(w[1], 2))

    def _next(self, start: int, w: list) -> int:
        """When the watermark has something to do with a window next."""
        end = start + self.size - 1
        if w[2]:
            return end + self.lateness
        return min(end, start + (w[3] + 1) * self.early) if self.early else end

    def _settle(self, held: dict, before: dict, mark: int) -> None:
        """Stores what changed.  A key has one timer, for the first thing to do, as whichever goes off acts on all its windows."""
        due = []
        for start, w in held.items():
            if mark >= start + self.size - 1 + self.lateness:
                if start in before:
                    self.windows.removeKey((start,))
                continue
            if w != before.get(start):
                self.windows.updateValue((start,), tuple(w))
            due.append(self._next(start, w))
        if due:
            self.handle.registerTimer(min(due) - self.held_back)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() + self.held_back
        before = {k[0]: list(v) for k, v in self.windows.iterator()}
        held = {start: list(w) for start, w in before.items()}
        for start in sorted(held):
            yield from self._advance(key, start, held[start], mark)
        for r in sorted((r for r in rows if r[self.ts] is not None), key=lambda r: r[self.order]):
            t = to_ms(r[self.ts])
            start = t - t % self.size
            end = start + self.size - 1
            if mark >= end + self.lateness:
                continue
            w = held.setdefault(start, [0, 0.0, mark >= end, max(0, (mark - start) // self.early) if self.early else 0, 0])
            w[0], w[1] = w[0] + 1, w[1] + (r[self.value] or 0.0)
            if w[2]:
                yield self._row(key, start, "late", t, w)
        self._settle(held, before, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() + self.held_back
        before = {k[0]: list(v) for k, v in self.windows.iterator()}
        held = {start: list(w) for start, w in before.items()}
        for start, w in held.items():
            yield from self._advance(key, start, w, mark)
        self._settle(held, before, mark)

    def close(self) -> None:
        pass


def timed_windows(df: DataFrame, key: str, ts: str, value: str, order: str, *, size_ms: int, bound_ms: int, lateness_ms: int = 0,
                  early_ms: int | None = None, drop=None, groups: int | None = None) -> DataFrame:
    """Every firing of the windows of a stream: key, window_start, firing (early, on time, late), at (the point, the
    window's last millisecond or the late row's time), cnt and total so far.

    ``order`` puts the rows of a micro-batch in order.  ``drop`` (frame -> frame) takes out rows that are there for the
    watermark alone, after it has seen them.  ``groups``: keep the state in so many groups of keys (:mod:`quern.streaming.groups`)."""
    delay = bound_ms + lateness_ms + size_ms
    marked = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{delay} milliseconds")
    marked = drop(marked) if drop else marked
    kind = marked.schema[key].dataType.simpleString()
    out = f"key {kind}, window_start timestamp, firing string, at timestamp, cnt long, total double"
    windows = TimedWindows(size_ms, lateness_ms, early_ms, ts, value, order)
    if groups:
        from quern.streaming.groups import transform_by_groups
        return transform_by_groups(marked.select(*dict.fromkeys([key, ts, value, order])), [key], windows, out, "Append", "EventTime", groups)
    return marked.groupBy(key).transformWithState(windows, out, "Append", "EventTime")
