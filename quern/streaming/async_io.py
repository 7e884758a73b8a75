"""STR-45 async I/O: each row asks a service, many calls of a task in flight at once.

A task runs its calls on one event loop, in a thread of its own, for all of its partition: up to ``capacity`` rows are in
flight whatever batch they came in, and calls go on while Spark takes rows that are done.  ``ordered`` gives rows back in
the order in which they came (a row that is done waits for those before it and keeps its place among the ``capacity``); unordered, a
row leaves as soon as its call is done.  A call that takes longer than ``timeout_s`` fails the task, which Spark runs again; with
``on_timeout`` that function's result stands in.  A failing call fails the task.  Rows of any value, nulls too, are passed to the call;
a task run again, or run twice, calls again, so calls should be repeatable.
"""

from __future__ import annotations

import asyncio
import queue
import threading
from collections.abc import Awaitable, Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FLUSH_ROWS = 1_000  # rows that are done leave in batches of this size


async def _lookup(value):
    """Stand-in for a remote lookup: the enrichment is the text length."""
    await asyncio.sleep(0)
    return None if value is None else len(value)


class _Calls:
    """The calls of one task."""

    def __init__(self, fn, timeout_s: float, on_timeout, ordered: bool):
        self.fn, self.timeout, self.on_timeout, self.ordered = fn, timeout_s, on_timeout, ordered
        self.loop = asyncio.new_event_loop()
        self.thread = threading.Thread(target=self.loop.run_forever, daemon=True)
        self.thread.start()
        # ordered: every call as it is made; unordered: every call as it is done
        self.line: queue.SimpleQueue = queue.SimpleQueue()
        self.in_flight = 0

    async def _one(self, value):
        call = asyncio.ensure_future(self.fn(value))
        done, _ = await asyncio.wait([call], timeout=self.timeout)
        if done:
            return call.result()
        call.cancel()
        if self.on_timeout is None:
            raise TimeoutError(f"a call took longer than {self.timeout} s")
        return self.on_timeout(value)

    def submit(self, value, place) -> None:
        self.in_flight += 1
        future = asyncio.run_coroutine_threadsafe(self._one(value), self.loop)
        if self.ordered:
            self.line.put((future, place))
        else:
            future.add_done_callback(lambda f: self.line.put((f, place)))

    def take(self):
        """(place, result) of the next call: waits for it."""
        future, place = self.line.get()
        result = future.result()
        self.in_flight -= 1
        return place, result

    def close(self) -> None:
        async def cancel():
            tasks = [t for t in asyncio.all_tasks() if t is not asyncio.current_task()]
            for t in tasks:
                t.cancel()
            await asyncio.gather(*tasks, return_exceptions=True)

        asyncio.run_coroutine_threadsafe(cancel(), self.loop).result()
        self.loop.call_soon_threadsafe(self.loop.stop)
        self.thread.join()
        self.loop.close()


def async_flat_map(df: DataFrame, col: str, out: str, out_type: str, fn: Callable[[Any], Awaitable[list]], *, ordered: bool = True,
                   capacity: int = 100, timeout_s: float = 10.0, on_timeout: Callable[[Any], list] | None = None) -> DataFrame:
    """A row for each element of the list that ``fn`` gives for the row's ``col``, with the element as ``out``."""
    if capacity < 1 or timeout_s <= 0:
        raise ValueError("capacity must be 1 or more, the time-out above 0")
    added = T.StructField(out, T._parse_datatype_string(out_type))
    schema = T.StructType(list(df.schema.fields) + [added])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type
        arrow = to_arrow_type(added.dataType)
        calls = _Calls(fn, timeout_s, on_timeout, ordered)

        def rows(done):
            """Batches of what is done: runs of rows of the same input batch, with the results beside them."""
            start = 0
            for i in range(1, len(done) + 1):
                if i == len(done) or done[i][0][0] is not done[start][0][0]:
                    batch = done[start][0][0]
                    at = [place for (_, place), result in done[start:i] for _ in result]
                    values = [v for _, result in done[start:i] for v in result]
                    if at:
                        part = batch.take(pa.array(at, pa.int64()))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, arrow)], names=schema.names)
                    start = i

        try:
            done = []
            for batch in batches:
                for place, value in enumerate(batch.column(df_names.index(col)).to_pylist()):
                    if calls.in_flight >= capacity:
                        done.append(calls.take())
                    calls.submit(value, (batch, place))
                    if len(done) >= FLUSH_ROWS:
                        yield from rows(_together(done, ordered))
                        done = []
            while calls.in_flight:
                done.append(calls.take())
                if len(done) >= FLUSH_ROWS:
                    yield from rows(_together(done, ordered))
                    done = []
            yield from rows(_together(done, ordered))
        finally:
            calls.close()

    df_names = df.columns
    return df.mapInArrow(run, schema)


def _together(done: list, ordered: bool) -> list:
    """Rows without an order are put together by their batch, so that each is cut once."""
    return done if ordered else sorted(done, key=lambda d: id(d[0][0]))


def async_map(df: DataFrame, col: str, out: str, out_type: str, *, ordered: bool = True, capacity: int = 100,
              timeout_s: float = 10.0, fn: Callable[[Any], Awaitable[Any]] = _lookup,
              on_timeout: Callable[[Any], Any] | None = None) -> DataFrame:
    """Each row with what ``fn`` gives for its ``col`` as ``out``."""
    async def one(value):
        return [await fn(value)]

    return async_flat_map(df, col, out, out_type, one, ordered=ordered, capacity=capacity, timeout_s=timeout_s,
                          on_timeout=None if on_timeout is None else lambda value: [on_timeout(value)])
