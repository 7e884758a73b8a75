import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quern.sources.replay import FLUSH_BATCHES, replay
from quern.streaming.watermarks import parse_watermark
from tests.conftest import SF_SMALL


def test_parse_watermark_clause():
    assert parse_watermark("WATERMARK FOR ts AS ts - INTERVAL '5' SECOND") == ("ts", "5 seconds")
    assert parse_watermark("watermark for rt as rt - interval '2' minutes") == ("rt", "2 minutes")
    assert parse_watermark("WATERMARK FOR ts AS ts") == ("ts", "0 seconds")


def test_replay_source_batch_read_is_the_table(spark):
    path = f"{SF_SMALL}/events.parquet"
    got = replay(spark, path, streaming=False, partition_rows=97)
    base = spark.read.parquet(path)
    assert got.drop("_eoi").exceptAll(base).count() == 0 and got.count() == base.count()


def test_replay_stream_batches_and_flush(spark):
    from quern.session import scratch_path
    path = f"{SF_SMALL}/events.parquet"
    n = spark.read.parquet(path).count()
    seen = []

    def sink(b, i):
        seen.append((i, b.filter("_eoi IS NULL OR NOT _eoi").count(), b.filter("_eoi").count()))

    s = replay(spark, path, rows_per_batch=300, flush=True, time_column="ts")
    q = s.writeStream.foreachBatch(sink).option("checkpointLocation", scratch_path(spark, "t_replay")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    data = [d for _, d, _ in seen]
    flush = [f for _, _, f in seen]
    assert sum(data) == n and max(data) <= 300
    assert sum(flush) == FLUSH_BATCHES and all(f <= 1 for f in flush)


def test_replay_reads_a_table_of_several_files(spark, tmp_path):
    from pyspark.sql import functions as F
    from quern.sources.replay import replay
    path = str(tmp_path / "t.parquet")
    df = spark.range(1000).withColumn("v", F.when(F.col("id") % 7 > 0, F.col("id") * 1.5)).withColumn("ts", F.timestamp_seconds("id").cast("timestamp_ntz"))
    df.repartition(3).write.parquet(path)
    back = replay(spark, path, streaming=False, partition_rows=130, repeat=2)
    assert sorted(map(tuple, back.drop("_eoi").collect()), key=repr) == sorted(list(map(tuple, df.collect())) * 2, key=repr)


def test_a_repeated_micro_batch_replaces_its_rows(spark):
    from quern.plans.streaming import stream_rows
    from quern.streaming.runner import run_to_table
    from tests.conftest import SF_SMALL
    ev = stream_rows(spark, SF_SMALL, repeat=3).dropDuplicates(["event_id"]).select("event_id")
    assert run_to_table(ev).count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    nothing = run_to_table(stream_rows(spark, SF_SMALL).filter("event_id < 0"))
    assert nothing.count() == 0


def test_a_longer_table_comes_in_larger_batches_not_in_more(spark, tmp_path):
    from quern.plans.streaming import BATCH_ROWS, BATCHES, stream_rows
    n = BATCH_ROWS * BATCHES * 3 + 17
    spark.range(n).selectExpr("id AS event_id").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    stream = stream_rows(spark, str(tmp_path))
    q = stream.writeStream.foreachBatch(lambda b, i: seen.append(b.agg({"event_id": "sum", "*": "count"}).first())).option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert len(seen) == BATCHES
    assert sum(r["count(1)"] for r in seen) == n and sum(r["sum(event_id)"] for r in seen) == n * (n - 1) // 2


def test_replay_ends_a_table_whose_columns_are_required(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from quern.streaming.runner import drop_flush, run_to_table
    from quern.streaming.watermarks import bounded_out_of_orderness
    path = str(tmp_path / "t.parquet")
    schema = pa.schema([pa.field("ts", pa.timestamp("us"), nullable=False), pa.field("kind", pa.string(), nullable=False)])
    pq.write_table(pa.table({"ts": [0, 1_000_000], "kind": ["a", "b"]}, schema=schema), path)
    df = bounded_out_of_orderness(replay(spark, path, flush=True, time_column="ts"), "ts", "0 seconds")
    assert {r.kind for r in run_to_table(drop_flush(df, "ts").select("kind")).collect()} == {"a", "b"}


def test_streams_open_few_state_partitions_a_core(spark):
    from quern.streaming.runner import PARTITIONS_A_CORE, state_partitions
    key, own = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    most = PARTITIONS_A_CORE * spark.sparkContext.defaultParallelism
    try:
        for given in (most + 100, 1):
            spark.conf.set(key, given)
            with state_partitions(spark):
                assert int(spark.conf.get(key)) == min(given, most)
            assert int(spark.conf.get(key)) == given
    finally:
        spark.conf.set(key, own)


@pytest.mark.parametrize("name", ["ovr_16_streaming_dedup", "set_03_streaming_full_sort", "snk_19_upsert_sink", "src_11_ack_source_dedup",
                                  "str_01_time_characteristic", "str_05_sql_watermark", "str_08_session_window_stream", "str_25_event_time_trigger"])
def test_a_stream_has_one_state_partition_a_core(spark, monkeypatch, tmp_path, name):
    from quern.plans import REGISTRY
    from quern.streaming import runner
    monkeypatch.setattr(runner, "scratch_path", lambda spark, kind: str(tmp_path / kind))
    pq.write_table(pq.read_table(f"{SF_SMALL}/events.parquet").slice(0, 200), str(tmp_path / "events.parquet"))
    key, own = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, 100)
    try:
        assert REGISTRY[name].fn(spark, str(tmp_path)).count() > 0
    finally:
        spark.conf.set(key, own)
    stores = [d.name for d in (tmp_path / "stream_ck" / "state" / "0").iterdir() if d.name.isdigit()]
    assert len(stores) == spark.sparkContext.defaultParallelism


def test_a_sorted_aggregate_opens_its_state_once_a_batch(spark):
    from quern.plans.streaming import stream_rows
    from quern.streaming.runner import order_by, run_to_table
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        calls.add(1)
        return n

    agg = stream_rows(spark, SF_SMALL).groupBy("event_type").count().withColumn("count", counted.asNondeterministic()("count"))
    rows = run_to_table(order_by(agg, "count", ascending=False), "complete", with_batch_id=True).collect()
    assert rows and calls.value == len(rows)


def test_a_read_task_opens_only_the_files_of_its_rows(tmp_path, monkeypatch):
    import pyarrow as pa
    from pyspark.sql.types import BooleanType, LongType, StructField, StructType
    from quern.sources import replay as R
    (tmp_path / "t").mkdir()
    for i, n in enumerate([7, 0, 5, 9, 4]):
        pq.write_table(pa.table({"id": pa.array(range(100 * i, 100 * i + n), pa.int64())}), str(tmp_path / "t" / f"{i}.parquet"), row_group_size=3)
    rows = [r for i, n in enumerate([7, 0, 5, 9, 4]) for r in range(100 * i, 100 * i + n)] * 2
    opened, whole, metadata = [], pq.ParquetFile, pq.read_metadata
    schema = StructType([StructField("id", LongType()), StructField("_eoi", BooleanType())])
    reader = R._BatchReader(schema, {"path": str(tmp_path / "t"), "repeat": "2", "partitionRows": "4"})
    monkeypatch.setattr(pq, "ParquetFile", lambda f, *a, **k: opened.append(str(f)) or whole(f, *a, **k))
    monkeypatch.setattr(pq, "read_metadata", lambda f, *a, **k: opened.append(str(f)) or metadata(f, *a, **k))
    got = []
    for part in reader.partitions():
        opened.clear()
        ids = [i for b in reader.read(part) for i in b["id"].to_pylist()]
        assert set(opened) == {str(tmp_path / "t" / f"{i // 100}.parquet") for i in ids} and len(opened) <= 3
        got += ids
    assert got == rows
    assert R._BatchReader(schema, {"path": str(tmp_path / "t"), "repeat": "0"}).partitions() == []
