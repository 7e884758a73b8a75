"""SRC-* (bounded), SNK-*, UDF-*: sources, sinks and user functions.

Every sink query writes the data it derives from the given tables to a fresh
folder under the shared checkpoint folder and returns what reading it back
gives, so the written content is what is checked.
"""

from __future__ import annotations


import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators import aggregates as A
from quern.plans.common import r2, t
from quern.plans.registry import register
from quern.session import ensure_stateful_conf, scratch_path
from quern.sinks import files as S
from quern.sources import tables as SRC
from quern.sources.replay import replay
from quern.streaming.runner import drop_flush, run_to_table

# --- sources ------------------------------------------------------------------

_LABELS = [("view", "browse"), ("click", "browse"), ("purchase", "revenue"), ("signup", "growth"), ("error", "ops")]


@register("src_01_from_elements", """
WITH l(event_type, label) AS (VALUES ('view', 'browse'), ('click', 'browse'), ('purchase', 'revenue'),
                                     ('signup', 'growth'), ('error', 'ops'))
SELECT label, count(*) AS cnt FROM events JOIN l USING (event_type) GROUP BY label
""")
def src_01_from_elements(spark, sf):
    labels = SRC.from_elements(spark, _LABELS, "event_type string, label string")
    ev = t(spark, sf, "events")
    return ev.join(F.broadcast(labels), "event_type").groupBy("label").agg(F.count(F.lit(1)).alias("cnt"))


@register("src_02_from_collection", """
WITH p(o_orderpriority, weight) AS (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3),
                                           ('4-NOT SPECIFIED', 2), ('5-LOW', 1))
SELECT o_orderstatus, sum(weight)::BIGINT AS weight FROM orders JOIN p USING (o_orderpriority) GROUP BY o_orderstatus
""")
def src_02_from_collection(spark, sf):
    pdf = pd.DataFrame({"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
                        "weight": [5, 4, 3, 2, 1]})
    w = spark.createDataFrame(pdf)
    o = t(spark, sf, "orders")
    return o.join(F.broadcast(w), "o_orderpriority").groupBy("o_orderstatus") \
            .agg(F.sum("weight").cast("long").alias("weight"))


@register("src_03_from_parallel_collection", """
SELECT count(*) AS ids, count(e.event_id) AS present
FROM range((SELECT min(event_id) FROM events), (SELECT max(event_id) FROM events) + 1) r(id)
LEFT JOIN events e ON e.event_id = r.id
""")
def src_03_from_parallel_collection(spark, sf):
    # a partitioned generator over the id range of the table: gaps check
    ev = t(spark, sf, "events")
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()   # two scalars
    ids = SRC.generate_sequence(spark, lo, hi, num_partitions=max(1, spark.sparkContext.defaultParallelism))
    j = ids.join(ev.select("event_id"), ids.value == ev.event_id, "left")
    return j.agg(F.count(F.lit(1)).alias("ids"), F.count("event_id").alias("present"))


@register("src_04_generate_sequence", """
WITH d AS (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS day
           FROM events),
     c AS (SELECT date_trunc('day', ts) AS day, count(*) AS cnt FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT d.day, coalesce(c.cnt, 0) AS cnt FROM d LEFT JOIN c USING (day)
""")
def src_04_generate_sequence(spark, sf):
    # calendar spine from the table's own bounds: days without errors get 0
    ev = t(spark, sf, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    spine = ev.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    c = ev.filter("event_type = 'error'").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("cnt"))
    return spine.join(c, "day", "left").select("day", F.coalesce("cnt", F.lit(0)).alias("cnt"))


@register("src_05_read_text_file", """
SELECT split_part(url, ':', 1) AS scheme, count(*) AS cnt FROM pages GROUP BY 1
""")
def src_05_read_text_file(spark, sf):
    path = scratch_path(spark, "text")
    S.write_as_text(t(spark, sf, "pages").select("url"), path)
    lines = SRC.read_text_file(spark, path)
    return lines.groupBy(F.split_part("value", F.lit(":"), F.lit(1)).alias("scheme")) \
                .agg(F.count(F.lit(1)).alias("cnt"))


@register("src_06_read_file", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def src_06_read_file(spark, sf):
    # once: one bounded read; the continuous mode is the next query
    df = spark.read.format("parquet").load(SRC.table_path(sf, "events"))
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


@register("src_06_read_file_continuous", """
SELECT event_type, sum(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END) AS readings,
       round(sum(CASE WHEN event_id % 2 = 0 THEN 3 * value ELSE value END), 2) AS total
FROM events GROUP BY event_type
""")
def src_06_read_file_continuous(spark, sf):
    # even events come first, the odd ones as further files, then the first files change (values doubled) and are
    # read again whole; each step is a watch of its own that goes on from the state of the one before
    from quern.sources.monitor import monitor
    folder, state = scratch_path(spark, "watched"), scratch_path(spark, "watch_state")
    writer = S.IdempotentBatchWriter(scratch_path(spark, "watch_out"))
    n = spark.sparkContext.defaultParallelism
    ev = t(spark, sf, "events").select("event_id", "event_type", "value").repartition(n, "event_id")
    even, odd = ev.filter("event_id % 2 = 0"), ev.filter("event_id % 2 <> 0")

    def look():
        monitor(spark, folder, "parquet", ev.schema, writer, state, pattern="*.parquet", rounds=1)

    even.write.parquet(f"{folder}/first")
    look()
    odd.write.parquet(f"{folder}/second")
    look()
    changed = scratch_path(spark, "watched_changed")
    even.withColumn("value", F.col("value") * 2).write.parquet(changed)
    S.replace_files(spark, changed, f"{folder}/first")
    look()
    look()  # nothing new
    back = writer.read(spark, ev.schema)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("readings"), r2(F.sum("value")).alias("total"))


@register("src_09_create_input", "SELECT o_orderstatus, count(*) AS cnt FROM orders GROUP BY o_orderstatus")
def src_09_create_input(spark, sf):
    df = SRC.connect(spark, "parquet", SRC.table_path(sf, "orders"), options={"mergeSchema": "false"})
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("cnt"))


@register("src_10_custom_source", """
SELECT event_type, count(*) AS cnt, round(sum(value), 2) AS total FROM events GROUP BY event_type
""")
def src_10_custom_source(spark, sf):
    path = SRC.table_path(sf, "events")
    df = replay(spark, path, streaming=False, partition_rows=100_000)
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("total"))


@register("src_14_table_scan", "SELECT event_id, value FROM events WHERE event_type = 'purchase' AND value > 200")
def src_14_table_scan(spark, sf):
    # the filter and projection reach the parquet scan (PushedFilters, ReadSchema)
    return t(spark, sf, "events").filter("event_type = 'purchase' AND value > 200").select("event_id", "value")


@register("src_16_rowtime_extractor", """
SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS rowtime FROM events
""")
def src_16_rowtime_extractor(spark, sf):
    # ExistingField on a long epoch-millis field -> event time
    ev = t(spark, sf, "events").withColumn("ts_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return ev.select("event_id", SRC.millis_to_ts("ts_ms").cast("timestamp_ntz").alias("rowtime"))


@register("src_17_values", """
SELECT o_orderstatus, s.label, count(*) AS cnt
FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) s(o_orderstatus, label) USING (o_orderstatus)
GROUP BY ALL
""")
def src_17_values(spark, sf):
    return spark.sql("""SELECT o_orderstatus, s.label, count(*) AS cnt FROM {o}
                        JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) AS s(o_orderstatus, label)
                        USING (o_orderstatus) GROUP BY o_orderstatus, s.label""", o=t(spark, sf, "orders"))


@register("src_18_connect_descriptor", "SELECT n_regionkey, count(*) AS cnt FROM nation GROUP BY n_regionkey")
def src_18_connect_descriptor(spark, sf):
    schema = "n_nationkey int, n_name string, n_regionkey int"
    SRC.connect(spark, "parquet", SRC.table_path(sf, "nation"), schema=schema, view="q_nation_desc")
    return spark.table("q_nation_desc").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("cnt"))


@register("src_19_stream_to_table", "SELECT id, kind, amount FROM (SELECT event_id AS id, event_type AS kind, value AS amount FROM events) WHERE amount > 450")
def src_19_stream_to_table(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "event_type", "value", "ts")
    tbl = SRC.as_table(ev, ["id", "kind", "amount", "rowtime"], rowtime="rowtime", view="q_events_tbl")
    return spark.sql("SELECT id, kind, amount FROM q_events_tbl WHERE amount > 450")


@register("src_20_partition_discovery", """
SELECT event_type, count(*) AS cnt FROM events WHERE event_type IN ('click', 'error') GROUP BY event_type
""")
def src_20_partition_discovery(spark, sf):
    path = scratch_path(spark, "parts")
    t(spark, sf, "events").write.partitionBy("event_type").parquet(path)
    back = spark.read.parquet(path).filter(F.col("event_type").isin("click", "error"))  # PartitionFilters
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


@register("src_21_lookup_source", """
SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def src_21_lookup_source(spark, sf):
    from quern.operators.joins import lookup_join
    s, n = t(spark, sf, "supplier"), t(spark, sf, "nation")
    return lookup_join(s, n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name")


# --- sinks --------------------------------------------------------------------

@register("snk_02_write_as_text", "SELECT r_name AS value FROM region")
def snk_02_write_as_text(spark, sf):
    path = scratch_path(spark, "snk_text")
    S.write_as_text(t(spark, sf, "region").select("r_name"), path)
    S.write_as_text(t(spark, sf, "region").select("r_name"), path, overwrite=True)  # OVERWRITE mode
    return spark.read.text(path)


@register("snk_03_write_as_csv", "SELECT n_nationkey, n_name FROM nation")
def snk_03_write_as_csv(spark, sf):
    path = scratch_path(spark, "snk_csv")
    S.write_as_csv(t(spark, sf, "nation").select("n_nationkey", "n_name"), path, field_delimiter="|",
                   row_delimiter="\n")
    return spark.read.schema("n_nationkey int, n_name string").option("sep", "|").csv(path)


@register("snk_06_write_using_output_format", "SELECT c_custkey, c_mktsegment FROM customer")
def snk_06_write_using_output_format(spark, sf):
    path = scratch_path(spark, "snk_json")
    t(spark, sf, "customer").select("c_custkey", "c_mktsegment").write.format("json").save(path)
    return spark.read.schema("c_custkey long, c_mktsegment string").json(path)


def _events_stream(spark, sf, delay="0 seconds"):
    from quern.plans.streaming import events_stream
    return events_stream(spark, sf, delay=delay)


@register("snk_07_add_sink", "SELECT event_id, event_type FROM events WHERE event_type = 'signup'")
def snk_07_add_sink(spark, sf):
    ev = _events_stream(spark, sf).filter("event_type = 'signup'").select("event_id", "event_type")
    return run_to_table(ev, "append")   # foreachBatch sink


@register("snk_09_collect", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def snk_09_collect(spark, sf):
    # collect to the client: the result is small by construction (5 rows);
    # the caller decides when to collect
    return t(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


def _file_stream_sink(spark, sf, fmt):
    ev = _events_stream(spark, sf).filter("value > 300").select("event_id", "event_type", "value")
    path, ck = scratch_path(spark, f"snk_{fmt}"), scratch_path(spark, f"snk_{fmt}_ck")
    q = ev.writeStream.format(fmt).option("path", path).option("checkpointLocation", ck).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema("event_id long, event_type string, value double").format(fmt).load(path)


@register("snk_10_streaming_file_sink_row", "SELECT event_id, event_type, value FROM events WHERE value > 300")
def snk_10_streaming_file_sink_row(spark, sf):
    return _file_stream_sink(spark, sf, "json")


@register("snk_11_streaming_file_sink_bulk", "SELECT event_id, event_type, value FROM events WHERE value > 300")
def snk_11_streaming_file_sink_bulk(spark, sf):
    return _file_stream_sink(spark, sf, "parquet")


@register("snk_12_bucket_assigner", """
SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, count(*) AS cnt FROM events GROUP BY 1
""")
def snk_12_bucket_assigner(spark, sf):
    path = scratch_path(spark, "snk_buckets")
    S.write_bucketed(t(spark, sf, "events").select("event_id", "ts"), path, "ts")
    return spark.read.parquet(path).groupBy(F.col("bucket").cast("string").alias("bucket")) \
                .agg(F.count(F.lit(1)).alias("cnt"))


@register("snk_13_rolling_policy", "SELECT count(*) AS cnt, count(DISTINCT event_id) AS ids FROM events")
def snk_13_rolling_policy(spark, sf):
    path = scratch_path(spark, "snk_roll")
    (t(spark, sf, "events").write.option("maxRecordsPerFile", 1_000).parquet(path))
    back = spark.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("cnt"), F.countDistinct("event_id").alias("ids"))


@register("snk_13_rolling_parts", """
SELECT event_type, count(*) AS cnt, round(sum(value), 2) AS total, TRUE AS rolled FROM events GROUP BY event_type
""")
def snk_13_rolling_parts(spark, sf):
    # parts of at most 500 rows in a folder for each event type, visible batch by batch
    path = scratch_path(spark, "snk_parts")
    ev = SRC.stream_table(spark, sf, "events").select("event_id", "event_type", "value")
    _to_parts(ev, path, scratch_path(spark, "snk_parts_ck"), bucket="event_type", maxRows=500)
    back = spark.read.schema("event_id long, value double, event_type string").parquet(path)
    per = back.groupBy("event_type", "_metadata.file_path").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    return per.groupBy("event_type").agg(F.sum("n").alias("cnt"), r2(F.sum("v")).alias("total"),
                                         (F.max("n") <= 500).alias("rolled"))


def _to_parts(stream, path, checkpoint, **options):
    from quern.sinks import parts
    parts.register(stream.sparkSession)
    (stream.writeStream.format("quern_parts").options(path=path, **{k: str(v) for k, v in options.items()})
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


@register("snk_15_transactional_parts", """
SELECT event_id, value FROM events WHERE event_type = 'purchase'
""")
def snk_15_transactional_parts(spark, sf):
    # a job whose last rows fail: its batch is taken back whole; started again from the checkpoint, it commits each row once
    from pyspark.errors import StreamingQueryException
    from quern.streaming.arrival import arrive
    path, ck = scratch_path(spark, "snk_txn"), scratch_path(spark, "snk_txn_ck")
    bought = t(spark, sf, "events").filter("event_type = 'purchase'").select("event_id", "value")
    half = bought.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0] or 0
    read = arrive(bought, "event_id", [half])
    failing = read.withColumn("value", F.when(F.col("event_id") >= half, F.raise_error(F.lit("lost")).cast("double"))
                                        .otherwise(F.col("value")))
    try:
        _to_parts(failing, path, ck, maxRows=500)
    except StreamingQueryException:
        pass
    _to_parts(read, path, ck, maxRows=500)
    return spark.read.schema("event_id long, value double").parquet(path)


@register("snk_15_two_phase_commit", "SELECT event_id, value FROM events WHERE event_type = 'purchase'")
def snk_15_two_phase_commit(spark, sf):
    ev = _events_stream(spark, sf).filter("event_type = 'purchase'").select("event_id", "value")
    writer = S.IdempotentBatchWriter(scratch_path(spark, "snk_2pc"))
    ck = scratch_path(spark, "snk_2pc_ck")
    q = ev.writeStream.foreachBatch(writer).option("checkpointLocation", ck).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return writer.read(spark, "event_id long, value double")


@register("snk_16_write_ahead", "SELECT event_id, value FROM events WHERE event_type = 'click'")
def snk_16_write_ahead(spark, sf):
    # buffered until the batch is complete, published by the committer
    ev = _events_stream(spark, sf).filter("event_type = 'click'").select("event_id", "value")
    writer = S.IdempotentBatchWriter(scratch_path(spark, "snk_wal"), fmt="json")
    ck = scratch_path(spark, "snk_wal_ck")
    q = ev.writeStream.foreachBatch(writer).option("checkpointLocation", ck).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return writer.read(spark, "event_id long, value double")


@register("snk_17_append_sink", "SELECT event_id, user_id FROM events WHERE event_type = 'error'")
def snk_17_append_sink(spark, sf):
    ev = _events_stream(spark, sf).filter("event_type = 'error'").select("event_id", "user_id")
    return run_to_table(ev, "append")


@register("snk_18_retract_sink", """
SELECT event_type AS key, count(*) AS cnt FROM events GROUP BY event_type
""")
def snk_18_retract_sink(spark, sf):
    # (flag, row) stream of a grouped count, applied to a table: + inserts, - deletes
    from quern.streaming.processors import Changelog, partial_totals
    ensure_stateful_conf(spark)
    # five keys have all rows: they are added up before they meet
    sums = partial_totals(_events_stream(spark, sf), ["event_type"], "value", "n")
    log = sums.groupBy("event_type").transformWithState(Changelog("value", "n"), "op string, key string, cnt long, total double",
                                                         "Append", "None")
    out = run_to_table(log, "append")
    sign = F.when(F.col("op") == "+", 1).otherwise(-1)
    return out.groupBy("key").agg(F.sum(sign * F.col("cnt")).cast("long").alias("cnt"))


@register("snk_19_upsert_sink", "SELECT user_id, max(ts) AS last_ts, count(*) AS cnt FROM events GROUP BY user_id")
def snk_19_upsert_sink(spark, sf):
    from quern.streaming.runner import final_by_key
    ev = _events_stream(spark, sf)
    agg = ev.groupBy("user_id").agg(F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("cnt"))
    up = final_by_key(run_to_table(agg, "update", with_batch_id=True), ["user_id"])  # upsert by key
    return up.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz"))


@register("snk_20_batch_sink_insert", """
SELECT o_orderkey, o_totalprice, 'F' AS o_orderstatus FROM orders WHERE o_orderstatus = 'F'
""")
def snk_20_batch_sink_insert(spark, sf):
    # INSERT INTO t PARTITION (o_orderstatus = 'F') SELECT ...
    path = scratch_path(spark, "snk_insert")
    spark.sql(f"CREATE TABLE q_orders_by_status (o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING) "
              f"USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{path}'")
    try:
        t(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice") \
            .createOrReplaceTempView("q_orders_f")
        spark.sql("INSERT INTO q_orders_by_status PARTITION (o_orderstatus = 'F') SELECT * FROM q_orders_f")
    finally:
        spark.sql("DROP TABLE IF EXISTS q_orders_by_status")
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice",
                                           F.col("o_orderstatus").cast("string").alias("o_orderstatus"))


@register("snk_21_insert_into_multi", """
SELECT 'high' AS sink, count(*) AS cnt FROM orders WHERE o_totalprice >= 200000
UNION ALL SELECT 'low', count(*) FROM orders WHERE o_totalprice < 200000
""")
def snk_21_insert_into_multi(spark, sf):
    # two INSERTs from one source in one streaming job: each micro-batch is read once (persisted) and written to both sinks
    # under its id, so a batch that is run again after a failure writes nothing twice
    hi_w, lo_w = S.IdempotentBatchWriter(scratch_path(spark, "snk_hi")), S.IdempotentBatchWriter(scratch_path(spark, "snk_lo"))

    def both(batch, batch_id):
        batch.persist()
        try:
            hi_w(batch.filter("o_totalprice >= 200000"), batch_id)
            lo_w(batch.filter("o_totalprice < 200000"), batch_id)
        finally:
            batch.unpersist()

    o = SRC.stream_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    q = o.writeStream.foreachBatch(both).option("checkpointLocation", scratch_path(spark, "snk_ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    both(t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 0)  # the first batch once more, as after a failure
    hi = hi_w.read(spark).agg(F.count(F.lit(1)).alias("cnt")).select(F.lit("high").alias("sink"), "cnt")
    lo = lo_w.read(spark).agg(F.count(F.lit(1)).alias("cnt")).select(F.lit("low").alias("sink"), "cnt")
    return hi.unionByName(lo)


# --- user-defined functions --------------------------------------------------------

@register("udf_01_scalar_function", "SELECT p_partkey, upper(p_brand) || '/' || p_size AS label FROM part")
def udf_01_scalar_function(spark, sf):
    from quern.functions.udf import brand_label
    p = t(spark, sf, "part")
    return p.select("p_partkey", brand_label("p_brand", "p_size").alias("label"))


@register("udf_02_table_function", """
SELECT page_id, seg, length(seg) AS n FROM pages, unnest(string_split(url, '/')) AS u(seg) WHERE seg <> ''
""")
def udf_02_table_function(spark, sf):
    from quern.functions.udf import register_segments
    register_segments(spark)
    return spark.sql("SELECT p.page_id, s.seg, CAST(s.n AS BIGINT) AS n FROM {p} p, LATERAL segments(p.url) s",
                     p=t(spark, sf, "pages"))


@register("udf_03_aggregate_function", """
SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'F' THEN -l_quantity ELSE l_quantity END) AS signed_qty
FROM lineitem GROUP BY l_returnflag
""")
def udf_03_aggregate_function(spark, sf):
    # accumulate / retract: rows flagged as retractions subtract
    signed = A.Udaf(partials={"s": lambda x, retract: F.sum(F.when(retract, -x).otherwise(x))},
                    result=lambda p: p["s"])
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(signed(F.col("l_quantity"), F.col("l_linestatus") == "F").alias("signed_qty"))


@register("udf_04_table_aggregate_function", """
SELECT o_custkey, o_totalprice, rank_num FROM (SELECT o_custkey, o_totalprice,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank_num FROM orders)
WHERE rank_num <= 2
""")
def udf_04_table_aggregate_function(spark, sf):
    # emitValue per group: top 2 prices.  The candidates are cut to 2 per
    # group by the partial top-k first, so the Python step sees tiny groups.
    from quern.operators.over import top_n
    o = t(spark, sf, "orders")
    cand = top_n(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 2).select(
        "o_custkey", "o_orderkey", "o_totalprice")

    def emit(pdf):
        pdf = pdf.sort_values(["o_totalprice", "o_orderkey"], ascending=[False, True]).head(2)
        return pd.DataFrame({"o_custkey": pdf["o_custkey"], "o_totalprice": pdf["o_totalprice"],
                             "rank_num": range(1, len(pdf) + 1)})
    return cand.groupBy("o_custkey").applyInPandas(emit, "o_custkey long, o_totalprice double, rank_num long")


@register("udf_05_python_scalar_udf", """
SELECT doc_id, len(list_filter(string_split(text, ' '), lambda w: w <> ''))::BIGINT AS n_tokens FROM documents
""")
def udf_05_python_scalar_udf(spark, sf):
    from quern.functions.udf import token_count
    return t(spark, sf, "documents").select("doc_id", token_count("text").alias("n_tokens"))


@register("udf_08_stream_aggregate_function", """
SELECT l_returnflag, count(*) FILTER (WHERE l_linenumber > 0 AND l_extendedprice > 0) AS cnt,
       round(coalesce(sum(l_linenumber * l_extendedprice) FILTER (WHERE l_linenumber > 0 AND l_extendedprice > 0), 0), 2) AS account
FROM lineitem GROUP BY l_returnflag
""")
def udf_08_stream_aggregate_function(spark, sf):
    li = t(spark, sf, "lineitem")
    agg = li.groupBy("l_returnflag").agg(A.ROW_COUNT_SUM(F.col("l_linenumber"), F.col("l_extendedprice")).alias("r"))
    return agg.select("l_returnflag", F.col("r.cnt").alias("cnt"), r2("r.account").alias("account"))
