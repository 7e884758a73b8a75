"""Aggregates of changelogs against plain recomputation after every micro-batch."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from quern.streaming.arrival import arrive
from quern.streaming.joins import folded
from quern.streaming.retract import Agg, RetractAggregates, netted, plus, retract_aggregate
from quern.streaming.runner import run_to_table

AGGS = {"n": Agg("count"), "nv": Agg("count", "v"), "s": Agg("sum", "v"), "a": Agg("avg", "v"), "lo": Agg("min", "v"), "hi": Agg("max", "v"),
        "d": Agg("count_distinct", "v"), "l": Agg("listagg", "w", order="o")}
SCHEMA = T.StructType([T.StructField("v", T.DoubleType()), T.StructField("w", T.StringType()), T.StructField("o", T.LongType())])


class Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v

    def clear(self):
        self.v = None


class Multiset(dict):
    def containsKey(self, k):
        return k in self

    def getValue(self, k):
        return self[k]

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        del self[k]

    def iterator(self):
        return iter(list(self.items()))


def plain(rows):
    if not rows:
        return None
    vs = [v for v, _, _ in rows if v is not None and v == v]
    ws = sorted((o, w) for _, w, o in rows if w is not None)
    return (len(rows), len(vs), math.fsum(vs) if vs else None, math.fsum(vs) / len(vs) if vs else None, min(vs, default=None), max(vs, default=None),
            len(set(vs)), ",".join(w for _, w in ws) if ws else None)


def test_every_micro_batch_of_one_key_equals_recomputation():
    rng = random.Random(4)
    for _ in range(60):
        p = RetractAggregates(AGGS, SCHEMA, ["op", "k", *AGGS])
        p.sums, p.values = Value(), {i: Multiset() for i, a in enumerate(AGGS.values()) if a.fn in ("min", "max", "count_distinct", "listagg")}
        live, shown = [], None
        for _ in range(rng.randrange(1, 25)):
            batch = []
            for _ in range(rng.randrange(1, 5)):
                if live and rng.random() < 0.5:
                    batch.append((live.pop(rng.randrange(len(live))), -1))
                else:
                    row = (rng.choice([None, float("nan"), 0.1, 0.2, 0.3, 1e17, -1e17, rng.random()]), rng.choice([None, "a", "b"]), rng.randrange(3))
                    live.append(row)
                    batch.append((row, 1))
            rng.shuffle(batch)  # also a row taken back before it is added
            out = list(p.handleInputRows(("k",), [{"_v_v": v, "_v_w": w, "_v_o": o, "_by": by} for (v, w, o), by in batch], None))
            new = plain(live)
            assert [tuple(r)[0] for r in out] == ([] if new == shown else ["-"] * (shown is not None) + ["+"] * (new is not None))
            for r in out:
                assert tuple(r)[2:] == (shown if r[0] == "-" else new)
            shown = new
        for row in live:
            list(p.handleInputRows(("k",), [{"_v_v": row[0], "_v_w": row[1], "_v_o": row[2], "_by": -1}], None))
        assert not p.sums.exists() and not any(p.values.values())  # nothing stays of a key without rows


def test_taken_back_in_an_earlier_micro_batch_than_added():
    p = RetractAggregates({"hi": Agg("max", "v")}, SCHEMA, ["op", "k", "hi"])
    p.sums, p.values = Value(), {0: Multiset()}
    feed = lambda v, by: [tuple(r) for r in p.handleInputRows(("k",), [{"_v_v": v, "_by": by}], None)]
    assert feed(5.0, -1) == [] and feed(3.0, 1) == [] and feed(5.0, 1) == [("+", "k", 3.0)]


def test_sums_of_doubles_take_back_exactly():
    parts = []
    for x in (1e17, 0.1, 3.7, -1e17, -0.1):
        parts = plus(parts, x)
    assert sum(parts) == 3.7 and plus(plus([], 0.1), -0.1) == []


def test_netting_leaves_only_differences(spark):
    df = spark.createDataFrame([("a", 1, "+"), ("a", 1, "-"), ("a", 2, "+"), (None, None, "+"), (None, None, "+")], "k string, v int, op string").coalesce(1)
    assert Counter(tuple(r) for r in netted(df, ["k"], ["v"], "op").collect()) == Counter([("a", 2, 1), (None, None, 2)])


def test_a_stream_with_a_hot_key_a_null_key_and_an_emptied_one(spark):
    rows = [("hot", float(i % 50), f"w{i % 3}", i, "+", i % 10) for i in range(3000)]
    rows += [("hot", v, w, o, "-", 10 + o % 5) for k, v, w, o, _, _ in rows if v > 40 or v < 3]
    rows += [(None, 1.0, "x", 1, "+", 0), (None, None, None, 2, "+", 12), ("gone", 1.0, "x", 1, "+", 3), ("gone", 1.0, "x", 1, "-", 11)]
    df = spark.createDataFrame(rows, "k string, v double, w string, o long, op string, arrival long")
    log = run_to_table(retract_aggregate(arrive(df, "arrival", [5, 10, 13]), ["k"], AGGS), "append")
    live = Counter()
    for k, v, w, o, op, _ in rows:
        live[k, v, w, o] += 1 if op == "+" else -1
    expected = {(k, *plain([x[1:] for x, n in live.items() if x[0] == k for _ in range(n)])) for k in ("hot", None)}
    assert {tuple(r) for r in folded(log).collect()} == expected
    assert log.filter("op = '-' and k = 'gone'").count() == 1


def test_unknown_aggregates_are_refused():
    for bad in (("median", "v"), ("sum", None)):
        with pytest.raises(ValueError, match="not an aggregate"):
            Agg(*bad)


def test_a_small_multiset_is_read_at_once():
    reads = []

    class Counted(Multiset):
        def containsKey(self, k):
            reads.append(k)
            return super().containsKey(k)

    p = RetractAggregates({"least": Agg("min", "v")}, T.StructType([T.StructField("v", T.DoubleType())]), ["op", "k", "least"])
    p.values, kept = {0: Counted()}, {"n": 0, "parts": []}
    p._count(0, kept, {(x / 2,): 1 for x in range(40)})
    p._count(0, kept, {(0.0,): -1, (0.5,): -1, (1.0,): 2, (7.0,): -1, (90.0,): 1})
    assert kept["top"] == 1.0 and kept["n"] == 38 and not reads
    p._count(0, kept, {(1.0,): -3})  # few changes beside the multiset: value by value
    assert kept["top"] == 1.5 and kept["n"] == 37 and reads == [(1.0,)]


def test_a_hot_key_in_parts_is_the_key_as_a_whole(spark):
    """Few keys, dealt over parts whose changelogs are put together again, equal plain recomputation after the stream."""
    rows = [("hot", float(i % 50) - 0.0, i, "+", i % 10) for i in range(2000)] + [("cold", None, 1, "+", 1), ("gone", 2.0, 5, "+", 2), ("gone", 2.0, 5, "-", 12)]
    rows += [("hot", v, o, "-", 10 + o % 5) for k, v, o, op, _ in rows if k == "hot" and (v > 40 or v < 3 or o > 1900)]
    df = spark.createDataFrame(rows, "k string, v double, o long, op string, arrival long")
    aggs = {"n": Agg("count"), "nv": Agg("count", "v"), "lo": Agg("min", "v"), "hi": Agg("max", "v"), "last": Agg("max", "o")}
    log = run_to_table(retract_aggregate(arrive(df, "arrival", [5, 10, 13]), ["k"], aggs, parts=7), "append")
    live = Counter()
    for k, v, o, op, _ in rows:
        live[k, v, o] += 1 if op == "+" else -1
    expected = set()
    for k in ("hot", "cold"):
        left = [x for x, n in live.items() if x[0] == k for _ in range(n)]
        vs = [v for _, v, _ in left if v is not None]
        expected.add((k, len(left), len(vs), min(vs, default=None), max(vs, default=None), max(o for _, _, o in left)))
    assert {tuple(r) for r in folded(log).collect()} == expected
    assert log.filter("k = 'gone'").count() == 2
    with pytest.raises(ValueError, match="not an aggregate of parts"):
        retract_aggregate(df, ["k"], {"s": Agg("sum", "v")}, parts=2)
