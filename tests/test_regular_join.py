"""JOI-11: changelogs in, changelog out, against the batch join of what the inputs leave."""

import random
from collections import Counter

import pytest

from quern.streaming.arrival import arrive
from quern.streaming.joins import KINDS, RegularJoin, folded, regular_join
from quern.streaming.runner import run_to_table
from pyspark.sql import types as T

LEFT, RIGHT = "k long, a long, op string, arrival long", "k long, b long, op string, arrival long"


def changes(seed, n=120):
    """Rows added, some twice, some taken back later, some taken back that never were there; keys with nulls."""
    rng, out, live = random.Random(seed), [], []
    for i in range(n):
        if live and rng.random() < 0.35:
            row = live.pop(rng.randrange(len(live)))
            out.append((*row, "-", i))
        elif rng.random() < 0.05:
            out.append((1, 999, "-", i))
        else:
            row = (rng.choice([None, 1, 1, 2, 3, rng.randrange(30)]), rng.randrange(6))
            live.append(row)
            out.append((*row, "+", i))
    return out, live


def on(left, right):
    return (left[0] + right[0]) % 3 != 0


def joined(how, left, right):
    match = lambda l, r: l[0] is not None and l[0] == r[0] and on(l[1:], r[1:])
    if how in ("semi", "anti"):
        return Counter(l for l in left if any(match(l, r) for r in right) == (how == "semi"))
    out = Counter((*l, r[1]) for l in left for r in right if match(l, r))
    if how in ("left", "full"):
        out.update((*l, None) for l in left if not any(match(l, r) for r in right))
    if how in ("right", "full"):
        out.update((r[0], None, r[1]) for r in right if not any(match(l, r) for l in left))
    return out


class Store:
    """Map state kept in a dict."""

    def __init__(self):
        self.rows = {}

    def iterator(self):
        return iter(list(self.rows.items()))

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        self.rows.pop(key, None)


@pytest.mark.parametrize("how", KINDS)
def test_every_prefix_of_the_changelog_is_the_batch_join(how):
    """Row by row, in a random interleaving of both sides: after each the folded output is the join so far."""
    a, b = T.StructType([T.StructField("a", T.LongType())]), T.StructType([T.StructField("b", T.LongType())])
    names = ["op", "k", "a"] if how in ("semi", "anti") else ["op", "k", "a", "b"]
    p = RegularJoin(how, names, a, b, on)
    stores, sums, live = {}, Counter(), {"L": [], "R": []}
    feed = [("L", r) for r in changes(1)[0]] + [("R", r) for r in changes(2)[0]]
    random.Random(3).shuffle(feed)
    for side, (k, v, op, _) in feed:
        p.state = stores.setdefault(k, {"L": Store(), "R": Store()})
        row = {"_order": 0, "_side": side, "_op": op, "_L0": v, "_R0": v}
        for out in p.handleInputRows((k,), [row], None):
            sums[tuple(out)[1:]] += 1 if out[0] == "+" else -1
            assert sums[tuple(out)[1:]] >= 0
        if op == "+":
            live[side].append((k, v))
        elif (k, v) in live[side]:
            live[side].remove((k, v))
        assert +sums == joined(how, live["L"], live["R"])


@pytest.mark.parametrize("how", ["full", "anti"])
def test_streams_of_files(spark, how):
    (l_rows, l_live), (r_rows, r_live) = changes(4), changes(5)
    left, right = spark.createDataFrame(l_rows, LEFT), spark.createDataFrame(r_rows, RIGHT)
    log = regular_join(arrive(left, "arrival", [30, 60, 90]), arrive(right, "arrival", [50]), ["k"], how, on)
    out = run_to_table(log, "append")
    assert Counter(tuple(r) for r in folded(out).collect()) == joined(how, l_live, r_live)
    assert out.filter("op = '-'").count() > 0


def test_bounded_tables_and_unknown_kinds(spark):
    (l_rows, l_live), (r_rows, r_live) = changes(6), changes(7)
    out = regular_join(spark.createDataFrame(l_rows, LEFT), spark.createDataFrame(r_rows, RIGHT), ["k"], "left", on)
    assert Counter(tuple(r) for r in folded(out).collect()) == joined("left", l_live, r_live)
    with pytest.raises(ValueError):
        RegularJoin("cross", [], T.StructType(), T.StructType())


def test_a_multiset_is_stored_in_chunks():
    """A key's rows are few values in the state; a change writes its own chunk alone; what is taken back leaves nothing."""
    from quern.streaming.joins import CHUNK
    a, b = T.StructType([T.StructField("a", T.LongType())]), T.StructType([T.StructField("b", T.LongType())])
    p, n = RegularJoin("left", ["op", "k", "a", "b"], a, b, lambda x, y: x[0] == y[0]), CHUNK * 2 + 5
    p.state = {"L": Store(), "R": Store()}
    feed = lambda changes: [tuple(r) for r in p.handleInputRows((1,), [{"_order": i, "_side": s, "_op": op, "_L0": v, "_R0": v} for i, (s, op, v) in enumerate(changes)], None)]
    assert len(feed([("L", "+", v) for v in range(n)])) == n and len(p.state["L"].rows) == 3
    written, put = [], p.state["L"].updateValue
    p.state["L"].updateValue = lambda k, v: (written.append(k), put(k, v))
    assert feed([("R", "+", CHUNK + 1)]) == [("-", 1, CHUNK + 1, None), ("+", 1, CHUNK + 1, CHUNK + 1)]
    assert written == [(1,)]
    feed([("L", "-", v) for v in range(n)] + [("R", "-", CHUNK + 1)])
    assert not p.state["L"].rows and not p.state["R"].rows
