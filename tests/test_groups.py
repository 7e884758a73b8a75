"""State by groups of keys: the same rows as with Spark's keys, at a few calls to the state store a group."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from quern.plans import REGISTRY
from quern.streaming import groups as G
from quern.streaming import processors as P
from quern.streaming.arrival import arrive
from quern.streaming.runner import run_to_table

BASE = dt.datetime(2024, 1, 1)
GROUPED = "str_50_match_out_of_order agg_03_retract_aggregates str_41_state_ttl str_50_match_recognize str_40_keyed_state_kinds set_02_streaming_temporal_sort str_30_early_and_late_firings str_21_late_firings str_26_interval_firings ovr_05_streaming_over str_41_idle_state_retention str_37_keyed_process_function str_40_reducing_aggregating_state".split()


class Store:
    """Spark's side of one group: a value and timers, with a count of the calls."""

    def __init__(self):
        self.v, self.timers, self.calls = None, set(), 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.v

    def update(self, v):
        self.calls += 1
        self.v = v

    def clear(self):
        self.calls += 1
        self.v = None

    def registerTimer(self, t):
        self.calls += 1
        self.timers.add(t)

    def deleteTimer(self, t):
        self.calls += 1
        self.timers.discard(t)


class Group:
    def __init__(self, processor, timed=True):
        self.store, self.processor = Store(), G.KeyGroups(processor, ["k"], timed)
        self.processor.init(self.store)

    def batch(self, rows, mark):
        times, out = TimerValues(0, mark), []
        if rows:
            out += self.processor.handleInputRows((0,), iter(rows), times)
        for t in sorted(x for x in self.store.timers if x <= mark):
            out += self.processor.handleExpiredTimer((0,), times, ExpiredTimerInfo(t))
            self.store.timers.discard(t)
        return out


def rows_of(*data):
    return [Row(k=k, ts=BASE + dt.timedelta(seconds=s), id=i, c=c) for k, s, i, c in data]


def ms(seconds):
    return P.to_ms(BASE + dt.timedelta(seconds=seconds))


def test_calls_go_with_the_groups_not_with_the_keys():
    calls = []
    for n in (3, 300):
        g = Group(P.StateKinds("c", "ts", "id", retention_ms=1_000_000))
        for b in range(4):
            out = g.batch(rows_of(*[(k, 10 * b + k % 10, b * n + k, "xy"[k % 2]) for k in range(n)]), ms(10 * b))
            assert sorted((r.key, r.cnt, r.total) for r in out) == [(k, b + 1, b + 1) for k in range(n)]
        calls.append(g.store.calls)
    assert calls[0] == calls[1] <= 4 * 4


def test_value_list_map_and_timers_of_many_keys():
    g = Group(P.StateKinds("c", "ts", "id", retention_ms=60_000))
    g.batch(rows_of(("a", 0, 1, "x"), ("b", 1, 2, "x"), ("a", 2, 3, "y"), (None, 3, 4, "x")), 0)
    assert g.store.timers == {ms(61)}  # the first of three
    g.batch(rows_of(("b", 30, 5, "x")), ms(61))  # b's timer moves on before it can go off
    assert g.store.timers == {ms(62)}
    assert g.batch([], ms(62)) == [] and g.store.timers == {ms(63)}  # a is gone, the null key's is due at 63
    out = g.batch(rows_of(("a", 65, 6, "x"), ("b", 66, 7, "x"), (None, 67, 8, "x")), ms(64))
    assert sorted((str(r.key), r.cnt, r.total) for r in out) == [("None", 2, 2), ("a", 1, 1), ("b", 3, 3)]
    # rows come before timers: the null key's was moved by its row
    assert g.batch([], ms(1000)) == [] and g.store.v is None and not g.store.timers


def test_a_group_without_a_change_is_not_written():
    g = Group(P.InactivityTimeout(10_000, "ts", "id", held_back_ms=10_000))
    g.batch(rows_of(("a", 100, 1, "x")), 0)
    before = g.store.calls
    g.batch(rows_of(("b", 1, 2, "x")), ms(90))  # too late to open a burst
    assert g.store.calls == before + 1


def test_groups_are_many_enough_and_small():
    assert G.groups_for(0) == G.groups_for(100_000) == G.LEAST_GROUPS
    assert G.groups_for(36_000_000) == -(-36_000_000 // G.GROUP_ROWS)
    with pytest.raises(ValueError, match="time to live"):
        G.GroupedHandle().getValueState("n", "n long", 1000)


class Probe(StatefulProcessor):
    """Counts by key in all kinds of state, and tells when its timers go off."""

    def init(self, handle):
        self.handle = handle
        self.n, self.ids, self.per = handle.getValueState("n", "n long"), handle.getListState("ids", "id long"), handle.getMapState("per", "c string", "n long")

    def handleInputRows(self, key, rows, timerValues):
        for r in rows:
            n = self.n.get()[0] + 1 if self.n.exists() else 1
            self.n.update((n,))
            self.ids.appendValue((r["id"],))
            c = (r["c"],)
            self.per.updateValue(c, ((self.per.getValue(c)[0] if self.per.containsKey(c) else 0) + 1,))
            self.handle.registerTimer(P.to_ms(r["ts"]))
            self.handle.registerTimer(P.to_ms(r["ts"]) + 5_000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        per = ",".join(f"{k[0]}{v[0]}" for k, v in sorted((tuple(k), tuple(v)) for k, v in self.per.iterator()))
        at, mark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        yield Row(k=key[0], at=at, mark=mark, n=self.n.get()[0], ids=",".join(str(x) for x in sorted(i[0] for i in self.ids.get())), per=per)

    def close(self):
        pass


@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_same_rows_as_with_keys_of_their_own(spark, kind):
    from quern.session import ensure_stateful_conf
    ensure_stateful_conf(spark)
    rnd = random.Random(4)
    data = [(None if rnd.random() < 0.1 else rnd.randrange(12), BASE + dt.timedelta(seconds=60 * b + rnd.randrange(-30, 60)), 100 * b + i, rnd.choice("xyz"), b)
            for b in range(4) for i in range(60)]
    data += [(r[0], r[1], r[2], r[3], r[4]) for r in data[:20]]  # rows twice
    data += [(1, BASE + dt.timedelta(seconds=60 * b + 60), 1000 + b, "x", b) for b in range(4)]  # timers right at a watermark
    df = spark.createDataFrame(data, "k long, ts timestamp_ntz, id long, c string, b long").withColumn("k", F.col("k").cast(kind))
    end = spark.createDataFrame([(None, BASE + dt.timedelta(days=9), 0, "end", 9)], "k long, ts timestamp_ntz, id long, c string, b long").withColumn("k", F.col("k").cast(kind))
    schema, got = f"k {kind}, at long, mark long, n long, ids string, per string", []
    for grouped in (False, True):
        rows = arrive(df, "b", [1, 2, 3], closing=end).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "0 seconds")
        rows = rows.filter((F.col("c") != "end") | F.col("ts").isNull())
        out = (G.transform_by_groups(rows, ["k"], Probe(), schema, "Append", "EventTime", 3) if grouped
               else rows.groupBy("k").transformWithState(Probe(), schema, "Append", "EventTime"))
        found = run_to_table(out, "append").collect()
        got.append(sorted(map(repr, found)))
    assert sorted(set(got[0]) - set(got[1])) == sorted(set(got[1]) - set(got[0])) and got[0] == got[1] and len(got[0]) > 100


@pytest.mark.parametrize("name", GROUPED)
def test_named_queries_keep_their_state_by_groups(spark, monkeypatch, name):
    seen = []

    def by_groups(df, keys, processor, schema, output_mode, time_mode, groups):
        seen.append((keys, df.columns, groups))
        raise InterruptedError

    monkeypatch.setattr(G, "transform_by_groups", by_groups)
    monkeypatch.setattr("quern.plans.streaming.transform_by_groups", by_groups)
    with pytest.raises(InterruptedError):
        REGISTRY[name].fn(spark, "/root/testdata/sf0.001")
    (keys, columns, n), = seen
    assert n >= G.LEAST_GROUPS and len(keys) == 1 and keys[0] in columns and "props" not in columns
