"""Firings of event-time windows and merging sessions against plain folds over the rows in order of arrival."""

import random
from datetime import datetime

import pytest

from quern.streaming.processors import InactivityTimeout, from_ms, to_ms
from quern.streaming.windows import TimedWindows
from tests.test_regular_join import Store

MIN = 60_000
T0 = to_ms(datetime(2024, 1, 1))


class Clock:
    """Timers and watermark of one key."""

    def __init__(self):
        self.now, self.timers, self.store = 0, set(), Store()

    def getMapState(self, *_):
        return self.store

    def registerTimer(self, t):
        self.timers.add(t)

    def getCurrentWatermarkInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.expiry


def run(processor, batches, delay):
    """The processor over the micro-batches of one key, as Spark calls it; (t, id, value) rows."""
    clock, out, top = Clock(), [], 0
    processor.init(clock)
    for rows in [*batches, []]:
        rows = [{"ts": from_ms(t), "id": i, "v": v} for t, i, v in rows if t >= clock.now]
        if rows:
            out += list(processor.handleInputRows((7,), rows, clock))
        for t in sorted(x for x in clock.timers if x <= clock.now):
            clock.timers.discard(t)
            clock.expiry = t
            out += list(processor.handleExpiredTimer((7,), clock, clock))
        top = max([top, *(to_ms(r["ts"]) for r in rows)])
        clock.now = max(clock.now, top - delay)
    clock.now = T0 * 2
    for t in sorted(clock.timers):
        clock.expiry = t
        out += list(processor.handleExpiredTimer((7,), clock, clock))
    assert not clock.store.rows  # nothing is kept beyond its time
    return [tuple(r) for r in out]


def batches_of(seed, n=80, behind=90):
    rng = random.Random(seed)
    rows = [(T0 + (i * 4 - rng.randrange(behind)) * MIN + rng.randrange(1, 999), i, rng.randrange(5) / 2) for i in range(n)]
    cuts = sorted(rng.sample(range(1, n), 7))
    return [rows[a:b] for a, b in zip([0, *cuts], [*cuts, n])]


def plain_firings(batches, size, bound, lateness, early):
    windows, out, top, mark = {}, [], 0, 0
    for rows in [*batches, None]:
        for start, w in sorted(windows.items()):
            end = start + size - 1
            if not w["fired"] and mark >= end:
                w["fired"] = True
                out.append((7, start, "on time", end, len(w["rows"])))
            elif not w["fired"] and early and (mark - start) // early > w["point"]:
                w["point"] = (mark - start) // early
                if len(w["rows"]) > w["told"]:
                    w["told"] = len(w["rows"])
                    out.append((7, start, "early", start + w["point"] * early, w["told"]))
        for t, i, _ in rows or []:
            start = t // size * size
            if mark >= start + size - 1 + lateness:
                continue
            late = mark >= start + size - 1
            w = windows.setdefault(start, {"rows": [], "fired": late, "told": 0, "point": max(0, (mark - start) // early) if early else 0})
            w["rows"].append(i)
            if w["fired"]:
                out.append((7, start, "late", t, len(w["rows"])))
        if rows:
            top = max([top, *(t for t, _, _ in rows)])
        mark = max(mark, top - bound) if rows is not None else mark
    return sorted(out + [(7, s, "on time", s + size - 1, len(w["rows"])) for s, w in windows.items() if not w["fired"]])


@pytest.mark.parametrize("seed,lateness,early", [(1, 0, None), (2, 120 * MIN, None), (3, 0, 15 * MIN), (4, 90 * MIN, 20 * MIN), (5, 30 * MIN, 7 * MIN)])
def test_firings(seed, lateness, early):
    size, bound, batches = 60 * MIN, 20 * MIN, batches_of(seed)
    got = run(TimedWindows(size, lateness, early, "ts", "v", "id"), batches, bound + lateness + size)
    assert sorted((k, to_ms(s), f, to_ms(at), n) for k, s, f, at, n, _ in got) == plain_firings(batches, size, bound, lateness, early)
    kinds = {f for _, _, f, _, _, _ in got}
    assert "on time" in kinds and ("early" in kinds) == bool(early) and ("late" in kinds) == bool(lateness)


@pytest.mark.parametrize("early", [None, 15 * MIN])
def test_a_key_has_one_timer_a_micro_batch_and_writes_changed_windows_only(early):
    processor, clock = TimedWindows(60 * MIN, 600 * MIN, early, "ts", "v", "id"), Clock()
    processor.init(clock)
    rows = [{"ts": from_ms(T0 + i * 60 * MIN), "id": i, "v": 1.0} for i in range(9)]
    list(processor.handleInputRows((7,), iter(rows), clock))
    assert len(clock.timers) == 1 and len(clock.store.rows) == 9
    written, put = [], clock.store.updateValue
    clock.store.updateValue = lambda k, v: (written.append(k), put(k, v))
    list(processor.handleInputRows((7,), iter(rows[3:4]), clock))
    assert len(clock.timers) == 1 and written == [(T0 + 180 * MIN,)]


def plain_sessions(times, gap):
    out = []
    for t in sorted(times):
        if out and t - out[-1][1] <= gap:
            out[-1] = (out[-1][0], t, out[-1][2] + 1)
        else:
            out.append((t, t, 1))
    return [(7, from_ms(a), from_ms(b + gap), n) for a, b, n in out]


@pytest.mark.parametrize("seed", range(6))
def test_sessions_of_shuffled_rows_are_those_of_the_ordered_table(seed):
    batches, gap = batches_of(seed, behind=300), (5 + seed) * MIN
    got = run(InactivityTimeout(gap, "ts", "id", held_back_ms=gap), batches, 400 * MIN + gap)
    assert sorted(got) == plain_sessions([t for b in batches for t, _, _ in b], gap)


def test_a_late_row_joins_the_burst_that_it_touches():
    at = lambda h, m: T0 + (h * 60 + m) * MIN
    got = run(InactivityTimeout(60 * MIN, "ts", "id"), [[(at(10, 0), 1, 0)], [(at(12, 0), 2, 0)], [(at(10, 30), 3, 0)]], 180 * MIN)
    assert [(to_ms(s) - T0, to_ms(e) - T0, n) for _, s, e, n in got] == [(600 * MIN, 690 * MIN, 2), (720 * MIN, 780 * MIN, 1)]
    bridge = run(InactivityTimeout(60 * MIN, "ts", "id"), [[(at(10, 0), 1, 0), (at(11, 50), 2, 0)], [(at(10, 55), 3, 0)]], 180 * MIN)
    assert [r[3] for r in bridge] == [3]


def test_a_key_has_one_timer_and_one_value_for_its_bursts():
    processor, clock = InactivityTimeout(10 * MIN, "ts", "id"), Clock()
    processor.init(clock)
    list(processor.handleInputRows((7,), [{"ts": from_ms(T0 + i * 60 * MIN), "id": i} for i in range(9)], clock))
    assert clock.timers == {T0 + 10 * MIN} and len(clock.store.rows) == 1
    clock.now = clock.expiry = T0 + 70 * MIN
    out = list(processor.handleExpiredTimer((7,), clock, clock))
    assert [to_ms(r[1]) - T0 for r in out] == [0, 60 * MIN] and clock.timers == {T0 + 10 * MIN, T0 + 130 * MIN}


def test_rows_in_event_time_order_need_one_timer_a_key():
    from quern.streaming.processors import EventTimeOrdered

    class State:
        def __init__(self):
            self.v = None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    class Rows(list):
        get = list.__iter__
        appendList = list.extend

        def put(self, rows):
            self[:] = rows

    p, clock = EventTimeOrdered("ts", "id", "v"), Clock()
    clock.getListState, clock.getValueState = lambda *_: Rows(), lambda *_: State()
    p.init(clock)
    list(p.handleInputRows((7,), [{"ts": from_ms(T0 + i * MIN), "id": i, "v": 1.0} for i in (5, 3, 9)], clock))
    list(p.handleInputRows((7,), [{"ts": from_ms(T0 + i * MIN), "id": i, "v": 1.0} for i in (4, 12)], clock))
    assert clock.timers == {T0 + 3 * MIN}
    clock.now, clock.expiry = T0 + 9 * MIN, T0 + 3 * MIN
    out = list(p.handleExpiredTimer((7,), clock, clock))
    assert [(r.seq, r.event_id) for r in out] == [(1, 3), (2, 4), (3, 5), (4, 9)] and clock.timers == {T0 + 3 * MIN, T0 + 12 * MIN}
    clock.expiry = T0 + 5 * MIN
    assert not list(p.handleExpiredTimer((7,), clock, clock))
    clock.now = clock.expiry = T0 + 12 * MIN
    assert [tuple(r) for r in p.handleExpiredTimer((7,), clock, clock)] == [(7, 5, 12, from_ms(T0 + 12 * MIN), 5.0)] and not p.buf


def test_slices_of_several_files_stay_micro_batches(spark, monkeypatch):
    from quern.streaming import arrival
    monkeypatch.setattr(arrival, "FILE_ROWS", 50)
    df = spark.range(1000).selectExpr("id", "(id * 7) % 1000 AS arrival")
    end = df.limit(1).selectExpr("CAST(NULL AS BIGINT) AS id", "CAST(5000 AS BIGINT) AS arrival")
    out = arrival.arrive(df, "arrival", [3, 400, 400, 700], end)
    seen = []
    q = out.writeStream.foreachBatch(lambda b, i: seen.append((b.rdd.getNumPartitions(), [r.arrival for r in b.collect()]))).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert [sorted(a) for _, a in seen] == [list(range(3)), list(range(3, 400)), [], list(range(400, 700)), list(range(700, 1000)), [5000], [5000]]
    assert max(n for n, _ in seen) > 1
