"""Reducing and aggregating state (STR-40) and idle retention (STR-41) against plain folds."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quern.session import ensure_stateful_conf
from quern.streaming.accumulators import accumulate, accumulate_until_idle, aggregating, reducing
from quern.streaming.arrival import arrive
from quern.streaming.runner import final_by_key, run_to_table

HOUR = 3_600_000
T0 = dt.datetime(2024, 1, 1)


def _accs():
    longest = reducing("word string, id long", lambda r: None if r["word"] is None else (r["word"], r["id"]),
                       lambda a, b: max(a, b, key=lambda x: (len(x[0]), -x[1])))
    total = aggregating("n long, s long", "long", lambda: (0, 0), lambda acc, r: (acc[0] + 1, acc[1] + r["id"]),
                        lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda acc: acc[1])
    return {"longest": longest, "total": total}


def _fold(rows):
    words = [(r[2], r[0]) for r in rows if r[2] is not None]
    return (max(words, key=lambda x: (len(x[0]), -x[1])) if words else None, sum(r[0] for r in rows))


def _data(n, seed):
    rnd = random.Random(seed)
    # (id, key, word, hours); a key holds half of all rows, one is null, words and times are null now and then
    return [(i, rnd.choice(["hot", "hot", "hot", "a", "b", None]), rnd.choice([None, "x", "yy", "zz", ""]),
             None if rnd.random() < 0.02 else rnd.randrange(0, 2000) / 10) for i in range(n)]


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "id long, k string, word string, h double")
    return df.select("id", "k", "word", (F.lit(T0) + F.make_interval(secs=F.col("h") * 3600)).alias("ts"))


def test_accumulated_state_equals_a_fold(spark):
    ensure_stateful_conf(spark)
    rows = _data(600, 1)
    stream = arrive(_frame(spark, rows), "id", [150, 300]).select("id", "k", "word")
    out = final_by_key(run_to_table(accumulate(stream, ["k"], _accs()), "update", with_batch_id=True), ["k"])
    got = {r.k: (tuple(r.longest) if r.longest else None, r.total) for r in out.collect()}
    assert got == {k: _fold([r for r in rows if r[1] == k]) for k in {r[1] for r in rows}}


def test_a_key_without_values_has_none(spark):
    ensure_stateful_conf(spark)
    stream = arrive(_frame(spark, [(1, "a", None, 0.0), (2, "a", None, 1.0)]), "id", [2]).select("id", "k", "word")
    out = final_by_key(run_to_table(accumulate(stream, ["k"], _accs()), "update", with_batch_id=True), ["k"])
    assert [(r.k, r.longest, r.total) for r in out.collect()] == [("a", None, 3)]


def _lives(rows, shortest, longest):
    """The lives of the rows of a key in order of time, by the rule."""
    out, due = [], None
    for r in rows:
        now = r[3] * HOUR
        if due is None or now >= due:
            out.append([])
            due = None
        if due is None or now + shortest > due:
            due = now + longest
        out[-1].append(r)
    return out


@pytest.mark.parametrize("shortest,longest", [(2, 2), (1, 3), (5, 9)])
def test_idle_keys_begin_anew(spark, shortest, longest):
    ensure_stateful_conf(spark)
    rows = _data(500, shortest)
    df = _frame(spark, rows)
    timed = sorted((r for r in rows if r[3] is not None), key=lambda r: (r[3], r[0]))
    # in order of time, in four slices; the watermark fires the timers of some keys between them, rows find others due
    closing = spark.createDataFrame([(-1, "end", None, 1e6)], "id long, k string, word string, h double")
    closing = closing.select("id", "k", "word", (F.lit(T0) + F.make_interval(secs=F.col("h") * 3600)).alias("ts"))
    bounds = [T0 + dt.timedelta(hours=h) for h in (40, 90.5, 91, 160)]
    stream = arrive(df, "ts", bounds, closing).withWatermark("ts", "0 seconds")
    out = run_to_table(accumulate_until_idle(stream, ["k"], _accs(), "ts", "id", shortest_ms=shortest * HOUR, longest_ms=longest * HOUR))
    got = sorted(((r.k, tuple(r.longest) if r.longest else None, r.total) for r in out.collect() if r.k != "end"), key=repr)
    want = sorted(((k, *_fold(life)) for k in {r[1] for r in timed}
                   for life in _lives([r for r in timed if r[1] == k], shortest * HOUR, longest * HOUR)), key=repr)
    assert got == want and len(want) > 4


def test_retention_bounds_are_checked(spark):
    with pytest.raises(ValueError):
        accumulate_until_idle(spark.range(1), ["id"], _accs(), "ts", shortest_ms=5, longest_ms=4)
