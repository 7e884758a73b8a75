from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"event_type", "window_start", "window_end", "cnt", "sum_value"}


def test_every_query_has_a_callable_and_sql_names_match(spark):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 250


def test_idempotent_writer_skips_replayed_batch(spark):
    from quern.session import scratch_path
    from quern.sinks.files import IdempotentBatchWriter
    w = IdempotentBatchWriter(scratch_path(spark, "t_2pc"))
    df = spark.range(10).withColumnRenamed("id", "x")
    w(df, 0)
    w(df, 0)            # replay of the same batch id: nothing written twice
    w(df.filter("x < 3"), 1)
    assert w.read(spark).count() == 13


def test_scan_pushes_filters_and_prunes_columns(spark):
    from quern.plans import REGISTRY
    plan = REGISTRY["src_14_table_scan"].fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan
