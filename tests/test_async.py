"""Asynchronous calls (STR-45)."""

import asyncio

import pytest

from quern.streaming.async_io import async_flat_map, async_map


@pytest.fixture()
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10")
    yield
    spark.conf.set(key, before)


def test_calls_of_several_batches_are_in_flight_at_once(spark, small_batches):
    live = [0]

    async def call(_):
        live[0] += 1
        await asyncio.sleep(0.02)
        seen = live[0]
        live[0] -= 1
        return seen

    for ordered in (True, False):
        out = async_map(spark.range(0, 400, 1, 1), "id", "seen", "long", fn=call, ordered=ordered, capacity=50).collect()
        assert 10 < max(r.seen for r in out) <= 50 and sorted(r.id for r in out) == list(range(400))


def test_ordered_waits_for_the_slow_row_and_unordered_does_not(spark, small_batches):
    async def call(i):
        await asyncio.sleep(0.5 if i == 0 else 0)
        return i * 2

    rows = spark.range(0, 40, 1, 1)
    a = [(r.id, r.x) for r in async_map(rows, "id", "x", "long", fn=call, capacity=30).collect()]
    b = [(r.id, r.x) for r in async_map(rows, "id", "x", "long", fn=call, capacity=30, ordered=False).collect()]
    assert a == [(i, 2 * i) for i in range(40)]
    assert sorted(b) == a and b[0] != (0, 0)


def test_a_time_out_fails_the_task_or_is_handled(spark):
    async def call(i):
        await asyncio.sleep(60 if i == 3 else 0)
        return i

    rows = spark.range(0, 10, 1, 2)
    with pytest.raises(Exception, match="a call took longer"):
        async_map(rows, "id", "x", "long", fn=call, timeout_s=0.2).collect()
    got = async_map(rows, "id", "x", "long", fn=call, timeout_s=0.2, on_timeout=lambda i: -i).collect()
    assert [r.x for r in got] == [0, 1, 2, -3, 4, 5, 6, 7, 8, 9]


def test_a_failing_call_fails_the_task(spark):
    async def call(i):
        raise KeyError("no such thing")

    with pytest.raises(Exception, match="no such thing"):
        async_map(spark.range(5), "id", "x", "long", fn=call).collect()


def test_lists_of_results_other_columns_and_nulls_are_kept(spark):
    async def call(v):
        return [] if v is None else list(v)

    df = spark.sql("SELECT * FROM VALUES (1, 'ab', TIMESTAMP_NTZ'2024-01-01', array(1, 2)), (2, NULL, NULL, NULL), (3, '', NULL, array()),"
                   "(4, 'z', NULL, array(3)) AS t(id, v, ts, l)")
    out = async_flat_map(df, "v", "c", "string", call)
    assert out.select("id", "c", "l").collect() == [(1, "a", [1, 2]), (1, "b", [1, 2]), (4, "z", [3])]
    assert out.schema["ts"].dataType == df.schema["ts"].dataType
    assert async_flat_map(df.filter("id > 9"), "v", "c", "string", call).count() == 0


@pytest.mark.parametrize("kw", [{"capacity": 0}, {"timeout_s": 0}])
def test_bounds_are_checked(spark, kw):
    with pytest.raises(ValueError):
        async_map(spark.range(1), "id", "x", "long", **kw)
