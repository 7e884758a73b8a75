"""Sequential (per-key automaton) operators against brute-force folds."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quern.streaming.processors import STATE_MACHINE
from tests.brute import delta_trigger, regex_match, state_machine
from tests.conftest import SF_SMALL


def _events():
    return pq.read_table(f"{SF_SMALL}/events.parquet").to_pandas()


def test_state_machine_matches_fold(spark):
    from quern.plans.streaming import EVENT_LETTERS
    from quern.plans import REGISTRY
    got = sorted(tuple(r) for r in REGISTRY["str_43_state_machine"].fn(spark, SF_SMALL)
                 .select("address", "state", "transition", "event_id").collect())
    ev = _events()
    exp = state_machine([(r.user_id, r.ts, EVENT_LETTERS[r.event_type], r.event_id) for r in ev.itertuples()],
                        STATE_MACHINE)
    assert got == sorted(exp)


def test_delta_trigger_matches_fold(spark):
    from quern.plans import REGISTRY
    got = sorted(tuple(r) for r in REGISTRY["str_28_delta_trigger"].fn(spark, SF_SMALL)
                 .select("key", "event_id", "value", "cnt").collect())
    ev = _events()
    exp = delta_trigger([(r.user_id, r.ts, r.event_id, r.value) for r in ev.itertuples()], 200.0)
    assert got == sorted(exp)


def test_match_recognize_stream_matches_regex(spark):
    from quern.plans import REGISTRY
    got = REGISTRY["str_50_match_recognize"].fn(spark, SF_SMALL).collect()
    got = sorted((r.user_id, r.first_view, r.purchase_id, r.n_views) for r in got)
    ev = _events().sort_values(["user_id", "ts", "event_id"])
    exp = []
    for uid, g in ev.groupby("user_id"):
        syms = [{"V"} if t == "view" else {"P"} if t == "purchase" else set() for t in g.event_type]
        times = [int(x.value // 1_000_000) for x in g.ts]
        ids = list(g.event_id)
        for s, e in regex_match(syms, [("V", 1, None, True), ("P", 1, 1, True)], 86_400_000, times):
            exp.append((uid, ids[s], ids[e - 1], e - 1 - s))
    assert got == sorted(exp)


def test_batch_matcher_reluctant_and_skip(spark):
    from quern.operators.match import Matcher, Var
    rows = [{"_mr_A": t == "a", "_mr_B": t == "b", "_mr_t": i, "ts": i, "id": i} for i, t in enumerate("aabab")]
    m = Matcher([Var("A", 1, None, False), Var("B")], {"n": ("count", "A", "id"), "first": ("first", "A", "id")},
                "TO NEXT ROW", None, "ts", "id")
    res = m.push(rows, final=True)
    assert [(r["first"], r["n"]) for r in res] == [(0, 2), (1, 1), (3, 1)]


def _hot_events(spark, path, n=30_000):
    """Events nearly all of one type, some without a type or value, the largest values three times."""
    rows = spark.range(n).selectExpr(
        "id AS event_id", "timestamp_seconds(id) AS ts", "id % 7 AS user_id",
        "CASE WHEN id % 1000 = 1 THEN NULL WHEN id % 1000 = 2 THEN 'rare' ELSE 'hot' END AS event_type", "CAST(id % 10000 AS double) AS value")
    rows.coalesce(1).write.parquet(f"{path}/events.parquet")
    return rows.collect()


def test_rows_are_added_up_by_key_before_they_are_shuffled(spark, tmp_path):
    import __spark_entry__
    from quern.streaming.processors import partial_totals
    rows = _hot_events(spark, tmp_path)
    ev = spark.read.parquet(f"{tmp_path}/events.parquet").withColumn("value", F.expr("nullif(value, 5)"))
    parts = partial_totals(ev, ["event_type"], "value", "n").collect()
    assert len(parts) < 100
    for kind in ("hot", "rare", None):
        own = [p for p in parts if p.event_type == kind]
        assert sum(p.n for p in own) == sum(r.event_type == kind for r in rows)
        assert sum(p.value for p in own) == sum(r.value for r in rows if r.event_type == kind and r.value != 5)
    assert partial_totals(ev.filter("user_id < 0"), ["event_type"], "value", "n").collect() == []
    assert [p.value for p in partial_totals(ev.filter("value IS NULL"), ["event_type"], "value", "n").collect()] == [None]
    found = __spark_entry__.queries()["snk_18_retract_sink"](spark, str(tmp_path)).collect()
    assert {r.key: r.cnt for r in found} == {k: sum(r.event_type == k for r in rows) for k in ("hot", "rare", None)}


def test_only_rows_that_can_be_in_the_top_are_shuffled(spark, tmp_path):
    import __spark_entry__
    from quern.streaming.processors import partial_top
    rows = _hot_events(spark, tmp_path)
    ev = spark.read.parquet(f"{tmp_path}/events.parquet")
    odd = spark.createDataFrame([("odd", None, 1), ("odd", float("nan"), 2), ("odd", 3.0, None), ("odd", float("inf"), 4)] * 2
                                + [("odd", 1.0, 5)] * 5, "event_type string, value double, event_id long").coalesce(1)
    kept = partial_top(ev.select("event_type", "value", "event_id").unionByName(odd), ["event_type"], 3, "value", "event_id").collect()
    assert len(kept) < 100
    assert sum(k.event_type == "odd" for k in kept) == 8 + 3
    best = {}
    for kind in ("hot", "rare", None):
        best[kind] = sorted(((-r.value, r.event_id) for r in rows if r.event_type == kind))[:3]
        assert sorted((-k.value, k.event_id) for k in kept if k.event_type == kind)[:3] == best[kind]
    found = __spark_entry__.queries()["ovr_14_streaming_top_n"](spark, str(tmp_path)).collect()
    assert {(r.key, r.rank_num, r.event_id, r.value) for r in found} == {
        (k, i, e, -v) for k, b in best.items() for i, (v, e) in enumerate(b, 1)}


@pytest.mark.parametrize("query", ["snk_18_retract_sink", "ovr_14_streaming_top_n", "str_23_retract_stream"])
def test_a_hot_key_is_reduced_before_its_state(spark, tmp_path, monkeypatch, query):
    import __spark_entry__
    from quern.plans import io_udf, streaming
    _hot_events(spark, tmp_path, 100)

    class Seen(Exception):
        pass

    def caught(df, *args, **kwargs):
        raise Seen(df._jdf.queryExecution().logical().toString())

    for module in (io_udf, streaming):
        monkeypatch.setattr(module, "run_to_table", caught)
    with pytest.raises(Seen) as seen:
        __spark_entry__.queries()[query](spark, str(tmp_path))
    assert "MapInArrow" in str(seen.value)
