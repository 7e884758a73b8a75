"""SURVEY 2.17: semantics that differ from Spark, one test each."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import scalar as S
from quern.operators import aggregates as A
from quern.operators import joins as J
from quern.operators import windows as W
from quern.operators.match import Var


def test_avg_of_integers_keeps_type(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    r = df.agg(A.avg_keep_type("x", "int").alias("a")).first()
    assert r.a == 1 and isinstance(r.a, int)


def test_single_value_errors_on_second_row(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    with pytest.raises(Exception):
        df.groupBy("k").agg(S.single_value("v")).collect()
    assert df.filter("v = 1").groupBy("k").agg(S.single_value("v").alias("s")).first().s == 1


def test_sum0_and_sum_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, v int")
    r = df.groupBy("k").agg(F.sum("v").alias("s"), A.sum0("v").alias("s0")).first()
    assert r.s is None and r.s0 == 0


def test_listagg_default_delimiter_skips_nulls(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, None, 2), (1, "b", 3)], "k int, v string, o int")
    assert df.groupBy("k").agg(A.listagg("v", ",", "o").alias("l")).first().l == "a,b"


def test_first_last_value_skip_nulls(spark):
    df = spark.createDataFrame([(1, None, 1), (1, "x", 2), (1, "y", 3), (1, None, 4)], "k int, v string, t int")
    r = df.groupBy("k").agg(A.first_value("v", "t").alias("f"), A.last_value("v", "t").alias("l")).first()
    assert (r.f, r.l) == ("x", "y")


def test_collect_is_a_multiset(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k int, v string")
    assert A.collect_multiset(df, ["k"], "v").first().multiset == {"a": 2, "b": 1}


def test_regexp_extract_null_and_split_index_zero_based(spark):
    df = spark.createDataFrame([("a-b",)], "s string")
    r = df.select(S.regexp_extract_or_null("s", "(x)", 1).alias("n"), F.regexp_extract("s", "(x)", 1).alias("e"),
                  S.split_index("s", "-", 0).alias("i0")).first()
    assert r.n is None and r.e == "" and r.i0 == "a"


def test_keyed_min_by_keeps_first_of_equal_extremes(spark):
    df = spark.createDataFrame([(1, 5.0, 1, 10), (1, 9.0, 2, 20), (1, 9.0, 3, 30), (1, 2.0, 4, 40)],
                               "k int, v double, t int, id int")
    out = {r.id: r.max_by_id for r in A.keyed_max_by(df, ["k"], ["t"], "v", "id", num_slices=2).collect()}
    assert out == {10: 10, 20: 20, 30: 20, 40: 20}


def test_interval_join_bounds_inclusive_and_exclusive(spark):
    base = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, base)], "k int, ts timestamp_ntz")
    right = spark.createDataFrame([(1, base - dt.timedelta(seconds=10), 1), (1, base, 2),
                                   (1, base + dt.timedelta(seconds=10), 3)], "k int, rts timestamp_ntz, id int")
    inc = J.interval_join(left, right, ["k"], "ts", "rts", -10_000_000, 10_000_000)
    exc = J.interval_join(left, right, ["k"], "ts", "rts", -10_000_000, 10_000_000,
                          lower_inclusive=False, upper_inclusive=False)
    assert sorted(r.id for r in inc.collect()) == [1, 2, 3]
    assert sorted(r.id for r in exc.collect()) == [2]
    # a negative-size interval matches nothing; the left outer form pads with nulls
    neg = J.interval_join(left, right, ["k"], "ts", "rts", 5_000_000, -5_000_000, how="left")
    assert [r.id for r in neg.collect()] == [None]


def test_window_lateness_drop_rule(spark):
    from quern.streaming.late import tag_late
    base = dt.datetime(2024, 1, 1)
    ts = [0, 12_000, 4_999, 9_999]   # ms; windows of 5 s, bound 0 ms, lateness 5 s
    df = spark.createDataFrame([(i, base + dt.timedelta(milliseconds=m)) for i, m in enumerate(ts)],
                               "id long, ts timestamp_ntz")
    got = {r.id: r.is_late for r in tag_late(df, "id", "ts", 0, 5_000, 5_000).collect()}
    # window [0, 5 s): maxTimestamp 4999 + 5000 = 9999 <= 12000 -> late;
    # window [5 s, 10 s): 9999 + 5000 > 12000 -> kept
    assert got == {0: False, 1: False, 2: True, 3: False}


def test_count_window_drops_incomplete_tail(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(7)], "k int, t int, v double")
    out = W.count_window(df, ["k"], ["t"], 3, [F.sum("v").alias("s")], num_slices=2).collect()
    assert sorted(r.s for r in out) == [3.0, 12.0]


def test_delta_trigger_fires_strictly_above_and_evictor_at_or_above(spark):
    from tests.brute import delta_trigger
    fired = delta_trigger([(1, i, i, v) for i, v in enumerate([0.0, 5.0, 9.0, 14.0])], 5.0)
    assert [f[2] for f in fired] == [9.0]           # deltas of exactly 5 (0->5, 9->14) do not fire
    df = spark.createDataFrame([(1, 0.0), (1, 5.0), (1, 10.0)], "k int, v double").withColumn("_last", F.lit(10.0))
    kept = W.delta_evict(df, ["k"], ["v"], F.abs(F.col("v") - F.col("_last")), 5.0).collect()
    assert sorted(r.v for r in kept) == [10.0]      # delta 5 is evicted (>=)


def test_time_evictor_keeps_strictly_newer(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, base), (1, base + dt.timedelta(seconds=5)), (1, base + dt.timedelta(seconds=10))],
                               "k int, ts timestamp_ntz")
    kept = W.time_evict(df, ["k"], "ts", 5_000_000).collect()
    assert len(kept) == 1                            # ts == max - size is evicted


def test_stream_rank_is_rejected_and_runs_in_batch(spark):
    from quern.plans.streaming import events_stream
    ev = events_stream(spark, "/root/testdata/sf0.001")
    with pytest.raises(Exception):
        ev.withColumn("r", F.rank().over(Window.partitionBy("user_id").orderBy("ts"))).writeStream \
          .format("noop").start().processAllAvailable()


def test_match_recognize_limits():
    with pytest.raises(ValueError):
        Var("A", 0, 1, greedy=False)              # reluctant '?' is not supported


def test_count_with_several_arguments_is_allowed(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "x int, y string")
    assert df.select(F.count_distinct("x", "y").alias("n")).first().n == 1
    assert df.selectExpr("count(x, y) AS n").first().n == 1


def test_session_windows_merge_at_exactly_one_gap(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, base), (1, base + dt.timedelta(minutes=30))], "k int, ts timestamp_ntz")
    out = df.groupBy("k", W.session("ts", "30 minutes")).count().collect()
    assert len(out) == 1 and out[0]["count"] == 2


def test_outer_interval_join_with_null_columns(spark):
    base = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, base, None), (2, base, "x")], "k int, ts timestamp_ntz, note string")
    right = spark.createDataFrame([(1, base, 7)], "k int, rts timestamp_ntz, id int")
    out = J.interval_join(left, right, ["k"], "ts", "rts", 0, 0, how="left").collect()
    assert sorted((r.k, r.id) for r in out) == [(1, 7), (2, None)]


def test_session_aggregate_same_result_on_both_paths(spark):
    import numpy as np
    base = dt.datetime(2024, 1, 1)
    rng = np.random.default_rng(3)
    # key 0 holds most rows (hot); gaps of 0..40 minutes
    rows, t0 = [], {}
    for i in range(600):
        k = 0 if rng.random() < 0.7 else int(rng.integers(1, 6))
        t0[k] = t0.get(k, 0) + int(rng.integers(0, 40 * 60))
        rows.append((k, base + dt.timedelta(seconds=t0[k]), i, 1.0))
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id long, v double")
    df = df.withColumn("k", F.when(F.col("k") > 0, F.col("k")))  # the hot key is null
    aggs = [F.count(F.lit(1)).alias("n")]
    sliced = W.session_aggregate(df, ["k"], "ts", 30 * 60 * 1_000_000, "id", aggs, num_slices=8)
    native = (df.groupBy("k", W.session("ts", "30 minutes").alias("w")).agg(*aggs)
                .select("k", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n"))
    norm = lambda d: sorted((r.k or 0, r.window_start, r.window_end, r.n) for r in d.collect())
    assert norm(sliced) == norm(native)


def test_iteration_keeps_rows_with_a_null_condition_and_runs_until_empty(spark):
    import pytest
    from quern.operators.iteration import iterate
    df = spark.createDataFrame([(1, 100.0), (2, None), (3, 2.0**70)], "id int, v double")
    halve = lambda d: d.withColumn("v", F.col("v") / 2)
    assert sorted(r.id for r in iterate(df, halve, F.col("v") > 1).collect()) == [1, 2, 3]
    with pytest.raises(RuntimeError, match="after 3 rounds"):
        iterate(df, halve, F.col("v") > 1, max_rounds=3)


def test_asof_join_takes_one_version_of_a_time(spark):
    t0 = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, t0, 10)], "k int, ts timestamp_ntz, id int")
    versions = spark.createDataFrame([(1, t0, 1, "old"), (1, t0, 2, "new")], "k int, vts timestamp_ntz, n int, price string")
    assert [r.price for r in J.asof_join(left, versions, ["k"], "ts", "vts", num_slices=2, arrival=["n"]).collect()] == ["new"]


def test_not_in_with_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    for values, want in (([], [1, 2, None]), ([1], [2]), ([1, None], []), ([None], [])):
        right = spark.createDataFrame([(v,) for v in values], "b int")
        assert sorted((r.a for r in J.not_in(left, "a", right, "b").collect()), key=repr) == sorted(want, key=repr)


def test_interval_join_kinds_against_all_pairs(spark):
    import random
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    at = lambda: None if rng.random() < .1 else t0 + dt.timedelta(seconds=rng.randint(0, 100))
    ls = [(rng.choice([1, 2, None]), at(), i) for i in range(40)]
    rs = [(rng.choice([1, 2, None]), at(), i) for i in range(40)]
    left = spark.createDataFrame(ls, "k int, ts timestamp_ntz, lid int")
    right = spark.createDataFrame(rs, "k int, rts timestamp_ntz, rid int")
    pairs = {(a[2], b[2]) for a in ls for b in rs if None not in (a[0], a[1], b[0], b[1]) and a[0] == b[0]
             and -5 <= (b[1] - a[1]).total_seconds() < 7}
    seen_l, seen_r = {p[0] for p in pairs}, {p[1] for p in pairs}
    only_l, only_r = {(i, None) for i in range(40) if i not in seen_l}, {(None, i) for i in range(40) if i not in seen_r}
    for how, want in (("inner", pairs), ("left", pairs | only_l), ("right", pairs | only_r), ("full", pairs | only_l | only_r)):
        out = J.interval_join(left, right, ["k"], "ts", "rts", -5_000_000, 7_000_000, upper_inclusive=False, how=how).collect()
        assert len(out) == len(want) and {(r.lid, r.rid) for r in out} == want, how
