"""STR-06..20, 32..36 and AUX-03..06: group windows over bounded tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import windows as W
from quern.plans.common import r2, r6, t
from quern.plans.registry import register


@register("str_06_tumbling_window", """
SELECT event_type, date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS cnt, round(sum(value), 2) AS sum_value
FROM events GROUP BY ALL
""", bench=True)
def str_06_tumbling_window(spark, sf):
    ev = t(spark, sf, "events")
    return (ev.groupBy("event_type", W.tumble("ts", "1 hour").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value"))
              .select("event_type", W.window_start("w").alias("window_start"),
                      W.window_end("w").alias("window_end"), "cnt", "sum_value"))


@register("str_06_tumbling_window_offset", """
SELECT event_type, date_trunc('hour', ts - INTERVAL 15 MINUTE) + INTERVAL 15 MINUTE AS window_start,
       count(*) AS cnt, round(sum(value), 2) AS sum_value
FROM events GROUP BY ALL
""")
def str_06_tumbling_window_offset(spark, sf):
    ev = t(spark, sf, "events")
    return (ev.groupBy("event_type", W.tumble("ts", "1 hour", "15 minutes").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value"))
              .select("event_type", W.window_start("w").alias("window_start"), "cnt", "sum_value"))


@register("str_07_sliding_window", """
WITH w AS (
  SELECT e.*, time_bucket(INTERVAL 30 MINUTE, ts) - to_minutes(30 * k) AS window_start
  FROM events e, range(0, 4) r(k))
SELECT event_type, window_start, window_start + INTERVAL 2 HOUR AS window_end,
       count(*) AS cnt, round(sum(value), 2) AS sum_value
FROM w GROUP BY ALL
""", bench=True)
def str_07_sliding_window(spark, sf):
    ev = t(spark, sf, "events")
    return (ev.groupBy("event_type", W.hop("ts", "2 hours", "30 minutes").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value"))
              .select("event_type", W.window_start("w").alias("window_start"),
                      W.window_end("w").alias("window_end"), "cnt", "sum_value"))


@register("str_08_session_window", """
WITH f AS (
  SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                   OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE
                 THEN 1 ELSE 0 END AS nw FROM events),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end,
       count(*) AS cnt, round(sum(value), 2) AS sum_value
FROM g GROUP BY user_id, sid
""", bench=True)
def str_08_session_window(spark, sf):
    ev = t(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return W.session_aggregate(ev, ["user_id"], "ts", 30 * 60 * 1_000_000, "event_id",
                               [F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value")])


@register("str_09_dynamic_session_gap", """
WITH a AS (
  SELECT *, ts + CASE WHEN event_type = 'purchase' THEN INTERVAL 6 HOUR ELSE INTERVAL 2 HOUR END AS e
  FROM events),
f AS (
  SELECT *, CASE WHEN max(e) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NULL
                   OR ts > max(e) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 THEN 1 ELSE 0 END AS nw FROM a),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, min(ts) AS window_start, max(e) AS window_end, count(*) AS cnt,
       round(sum(value), 2) AS sum_value
FROM g GROUP BY user_id, sid
""")
def str_09_dynamic_session_gap(spark, sf):
    ev = t(spark, sf, "events")
    hour = 3_600_000_000
    gap = F.when(F.col("event_type") == "purchase", F.lit(6 * hour)).otherwise(F.lit(2 * hour))
    return W.session_aggregate(ev.select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], "ts", gap, "event_id",
                               [F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value")])


@register("str_10_global_window", """
SELECT event_type, count(*) AS cnt, round(sum(value), 2) AS sum_value, max(ts) AS last_ts
FROM events GROUP BY event_type
""")
def str_10_global_window(spark, sf):
    # One window per key that only fires at the end of the bounded input.
    return (t(spark, sf, "events").groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value"),
                 F.max("ts").alias("last_ts")))


@register("str_11_count_window_tumbling", """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT user_id, (rn - 1) // 5 AS window_id, round(sum(value), 2) AS sum_value,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM n GROUP BY user_id, (rn - 1) // 5 HAVING count(*) = 5
""", bench=True)
def str_11_count_window_tumbling(spark, sf):
    ev = t(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    out = W.count_window(ev, ["user_id"], ["ts", "event_id"], 5,
                         [r2(F.sum("value")).alias("sum_value"),
                          F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")])
    return out.withColumn("window_id", F.col("window_id").cast("bigint"))


@register("str_12_count_window_sliding", """
WITH n AS (
  SELECT user_id, row_number() OVER w AS rn,
         sum(value) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS s
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, rn AS fire_rn, least(rn, 4) AS n_rows, round(s, 2) AS sum_value
FROM n WHERE rn % 2 = 0
""", bench=True)
def str_12_count_window_sliding(spark, sf):
    ev = t(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    out = W.sliding_count_window(ev, ["user_id"], ["ts", "event_id"], 4, 2, "value")
    return out.withColumn("sum_value", r2("sum_value"))


@register("str_13_window_all", """
SELECT date_trunc('day', ts) AS window_start, count(*) AS cnt,
       round(sum(value), 2) AS sum_value, count(DISTINCT user_id) AS users
FROM events GROUP BY 1
""")
def str_13_window_all(spark, sf):
    ev = t(spark, sf, "events")
    return (ev.groupBy(W.tumble("ts", "1 day").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value"),
                   F.countDistinct("user_id").alias("users"))
              .select(W.window_start("w").alias("window_start"), "cnt", "sum_value", "users"))


@register("str_14_sql_group_window", """
SELECT event_type,
       time_bucket(INTERVAL 10 MINUTE, ts) AS w_start,
       time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS w_end,
       time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE - INTERVAL 1 MILLISECOND AS w_rowtime,
       count(*) AS cnt, round(sum(value), 2) AS sum_value
FROM events GROUP BY ALL
""")
def str_14_sql_group_window(spark, sf):
    # TUMBLE(ts, INTERVAL '10' MINUTE) with TUMBLE_START / _END / _ROWTIME.
    return spark.sql("""
        SELECT event_type, window.start AS w_start, window.end AS w_end,
               window.end - INTERVAL 1 MILLISECOND AS w_rowtime,
               count(*) AS cnt, round(sum(value), 2) AS sum_value
        FROM {ev} GROUP BY event_type, window(ts, '10 minutes')
    """, ev=t(spark, sf, "events"))


@register("aux_03_tumble_start_end", """
SELECT o_orderpriority, time_bucket(INTERVAL 7 DAY, o_orderdate, TIMESTAMP '1970-01-01') AS w_start,
       time_bucket(INTERVAL 7 DAY, o_orderdate, TIMESTAMP '1970-01-01') + INTERVAL 7 DAY AS w_end,
       count(*) AS cnt
FROM orders GROUP BY ALL
""")
def aux_03_tumble_start_end(spark, sf):
    o = t(spark, sf, "orders")
    return (o.groupBy("o_orderpriority", W.tumble("o_orderdate", "7 days").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select("o_orderpriority", W.window_start("w").alias("w_start"),
                      W.window_end("w").alias("w_end"), "cnt"))


@register("aux_04_tumble_rowtime", """
SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS w_rowtime,
       count(*) AS cnt
FROM events GROUP BY ALL
""")
def aux_04_tumble_rowtime(spark, sf):
    ev = t(spark, sf, "events")
    return (ev.groupBy("event_type", W.tumble("ts", "1 hour").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select("event_type", W.window_rowtime("w").alias("w_rowtime"), "cnt"))


@register("aux_05_hop_start_end_rowtime", """
WITH w AS (
  SELECT e.*, time_bucket(INTERVAL 1 HOUR, ts) - to_hours(k) AS s
  FROM events e, range(0, 3) r(k))
SELECT event_type, s AS w_start, s + INTERVAL 3 HOUR AS w_end,
       s + INTERVAL 3 HOUR - INTERVAL 1 MILLISECOND AS w_rowtime, count(*) AS cnt
FROM w GROUP BY ALL
""")
def aux_05_hop_start_end_rowtime(spark, sf):
    ev = t(spark, sf, "events")
    return (ev.groupBy("event_type", W.hop("ts", "3 hours", "1 hour").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select("event_type", W.window_start("w").alias("w_start"),
                      W.window_end("w").alias("w_end"),
                      W.window_rowtime("w").alias("w_rowtime"), "cnt"))


@register("aux_06_session_start_end_rowtime", """
WITH f AS (
  SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY event_type ORDER BY ts) IS NULL
                   OR ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) > INTERVAL 10 MINUTE
                 THEN 1 ELSE 0 END AS nw FROM events),
g AS (SELECT *, sum(nw) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT event_type, min(ts) AS w_start, max(ts) + INTERVAL 10 MINUTE AS w_end,
       max(ts) + INTERVAL 10 MINUTE - INTERVAL 1 MILLISECOND AS w_rowtime, count(*) AS cnt
FROM g GROUP BY event_type, sid
""")
def aux_06_session_start_end_rowtime(spark, sf):
    ev = t(spark, sf, "events")
    s = W.session_aggregate(ev.select("event_type", "ts", "event_id"), ["event_type"], "ts", 10 * 60 * 1_000_000, "event_id",
                            [F.count(F.lit(1)).alias("cnt")])
    return s.select("event_type", F.col("window_start").alias("w_start"), F.col("window_end").alias("w_end"),
                    (F.col("window_end") - F.expr("INTERVAL 1 MILLISECOND")).alias("w_rowtime"), "cnt")


@register("str_15_table_api_windows", """
WITH w AS (
  SELECT e.*, time_bucket(INTERVAL 20 MINUTE, ts) - to_minutes(20 * k) AS s
  FROM events e, range(0, 3) r(k))
SELECT event_type, s AS w_start, count(*) AS cnt, max(value) AS max_value
FROM w GROUP BY ALL
""")
def str_15_table_api_windows(spark, sf):
    # Slide.over(1.hour).every(20.minutes).on(ts).as(w)
    ev = t(spark, sf, "events")
    w = W.Slide.over("1 hour").every("20 minutes").on("ts")
    return (ev.groupBy("event_type", w.alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"), F.max("value").alias("max_value"))
              .select("event_type", W.window_start("w").alias("w_start"), "cnt", "max_value"))


@register("str_16_batch_group_window", """
SELECT o_orderstatus, time_bucket(INTERVAL 30 DAY, o_orderdate, TIMESTAMP '1970-01-01') AS window_start,
       count(*) AS cnt, round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY ALL
""", bench=True)
def str_16_batch_group_window(spark, sf):
    o = t(spark, sf, "orders")
    return (o.groupBy("o_orderstatus", W.tumble("o_orderdate", "30 days").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("o_totalprice")).alias("revenue"))
              .select("o_orderstatus", W.window_start("w").alias("window_start"), "cnt", "revenue"))


@register("str_17_window_table_aggregate", """
WITH r AS (
  SELECT event_type, date_trunc('hour', ts) AS window_start, value,
         row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY value DESC, event_id) AS rank
  FROM events)
SELECT * FROM r WHERE rank <= 2
""")
def str_17_window_table_aggregate(spark, sf):
    # flatAggregate(Top2) over a tumbling window: the partial top-k is taken
    # before the shuffle (WindowGroupLimit), so a hot key ships 2 rows per task.
    from pyspark.sql import Window
    ev = t(spark, sf, "events").withColumn("window_start", W.tumble("ts", "1 hour").start)
    w = Window.partitionBy("event_type", "window_start").orderBy(F.col("value").desc(), "event_id")
    return (ev.withColumn("rank", F.row_number().over(w).cast("long")).filter("rank <= 2")
              .select("event_type", "window_start", "value", "rank"))


@register("str_18_window_aggregate", """
SELECT user_id, date_trunc('day', ts) AS window_start, count(*) AS cnt,
       round(sum(value), 2) AS sum_value, round(avg(value), 4) AS avg_value,
       min(value) AS min_value, max(value) AS max_value
FROM events GROUP BY ALL
""")
def str_18_window_aggregate(spark, sf):
    ev = t(spark, sf, "events")
    return (ev.groupBy("user_id", W.tumble("ts", "1 day").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value"),
                   F.round(F.avg("value"), 4).alias("avg_value"),
                   F.min("value").alias("min_value"), F.max("value").alias("max_value"))
              .select("user_id", W.window_start("w").alias("window_start"), "cnt",
                      "sum_value", "avg_value", "min_value", "max_value"))


@register("str_19_window_process", """
SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end,
       count(*) AS cnt, arg_min(event_id, ts) AS first_event, arg_max(event_id, ts) AS last_event,
       count(DISTINCT user_id) AS users, round(stddev_samp(value), 4) AS sd_value
FROM events GROUP BY ALL
""")
def str_19_window_process(spark, sf):
    # ProcessWindowFunction over the full pane: expressed with aggregates that
    # see every row of the pane but keep a bounded buffer.
    ev = t(spark, sf, "events")
    return (ev.groupBy("event_type", W.tumble("ts", "6 hours").alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"), F.min_by("event_id", "ts").alias("first_event"),
                   F.max_by("event_id", "ts").alias("last_event"),
                   F.countDistinct("user_id").alias("users"),
                   F.round(F.stddev_samp("value"), 4).alias("sd_value"))
              .select("event_type", W.window_start("w").alias("window_start"),
                      W.window_end("w").alias("window_end"), "cnt", "first_event",
                      "last_event", "users", "sd_value"))


@register("str_20_window_min_max_by", """
SELECT event_type, date_trunc('day', ts) AS window_start, round(sum(value), 2) AS sum_value,
       min(value) AS min_value, max(value) AS max_value,
       first(event_id ORDER BY value, ts) AS min_by_event,
       first(event_id ORDER BY value DESC, ts) AS max_by_event
FROM events GROUP BY ALL
""")
def str_20_window_min_max_by(spark, sf):
    # minBy / maxBy keep the first row (in time) among equal extremes.
    ev = t(spark, sf, "events")
    neg_ts = -F.unix_micros(F.col("ts").cast("timestamp"))
    return (ev.groupBy("event_type", W.tumble("ts", "1 day").alias("w"))
              .agg(r2(F.sum("value")).alias("sum_value"), F.min("value").alias("min_value"),
                   F.max("value").alias("max_value"),
                   F.min_by("event_id", F.struct("value", "ts")).alias("min_by_event"),
                   F.max_by("event_id", F.struct("value", neg_ts)).alias("max_by_event"))
              .select("event_type", W.window_start("w").alias("window_start"), "sum_value",
                      "min_value", "max_value", "min_by_event", "max_by_event"))


@register("str_32_count_evictor", """
WITH r AS (
  SELECT event_type, date_trunc('hour', ts) AS window_start, value,
         row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
SELECT event_type, window_start, count(*) AS cnt, round(sum(value), 2) AS sum_value
FROM r WHERE rn <= 3 GROUP BY ALL
""")
def str_32_count_evictor(spark, sf):
    ev = t(spark, sf, "events").withColumn("window_start", W.tumble("ts", "1 hour").start)
    kept = W.count_evict(ev, ["event_type", "window_start"], ["ts", "event_id"], 3)
    return (kept.groupBy("event_type", "window_start")
                .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value")))


@register("str_33_time_evictor", """
WITH r AS (
  SELECT event_type, date_trunc('hour', ts) AS window_start, ts, value,
         max(ts) OVER (PARTITION BY event_type, date_trunc('hour', ts)) AS mx
  FROM events)
SELECT event_type, window_start, count(*) AS cnt, round(sum(value), 2) AS sum_value
FROM r WHERE ts > mx - INTERVAL 20 MINUTE GROUP BY ALL
""")
def str_33_time_evictor(spark, sf):
    ev = t(spark, sf, "events").withColumn("window_start", W.tumble("ts", "1 hour").start)
    kept = W.time_evict(ev, ["event_type", "window_start"], "ts", 20 * 60 * 1_000_000)
    return (kept.groupBy("event_type", "window_start")
                .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value")))


@register("str_34_delta_evictor", """
WITH r AS (
  SELECT event_type, date_trunc('hour', ts) AS window_start, value,
         arg_max(value, ts) OVER (PARTITION BY event_type, date_trunc('hour', ts)) AS last_value
  FROM events)
SELECT event_type, window_start, count(*) AS cnt, round(sum(value), 2) AS sum_value
FROM r WHERE abs(value - last_value) < 100 GROUP BY ALL
""")
def str_34_delta_evictor(spark, sf):
    # DeltaEvictor: rows whose delta to the pane's last row is >= threshold go.
    ev = t(spark, sf, "events").withColumn("window_start", W.tumble("ts", "1 hour").start)
    last = (ev.groupBy("event_type", "window_start")
              .agg(F.max_by("value", "ts").alias("_last_value")))
    pane = ev.join(last, ["event_type", "window_start"])
    kept = W.delta_evict(pane, ["event_type", "window_start"], ["ts"],
                         F.abs(F.col("value") - F.col("_last_value")), 100.0)
    return (kept.groupBy("event_type", "window_start")
                .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("sum_value")))


@register("str_35_vector_delta", """
SELECT a.vec_id,
       round(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
             lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))), 6) AS euclidean,
       round(1 - list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE))
             / (sqrt(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE * x::DOUBLE)))
                * sqrt(list_sum(list_transform(b.embedding, lambda x: x::DOUBLE * x::DOUBLE)))), 6) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def str_35_vector_delta(spark, sf):
    # Delta between consecutive vectors: an equi-join on vec_id + 1, not a
    # global ordered window.
    e = t(spark, sf, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("nxt"))
    j = e.join(b, "vec_id")
    return j.select("vec_id",
                    r6(W.euclidean_distance(F.col("embedding"), F.col("nxt"))).alias("euclidean"),
                    r6(W.cosine_distance(F.col("embedding"), F.col("nxt"))).alias("cosine"))


@register("str_36_field_extractors", """
SELECT vec_id, embedding[1]::DOUBLE AS f0, embedding[3]::DOUBLE AS f2,
       embedding[1]::DOUBLE + embedding[2]::DOUBLE + embedding[3]::DOUBLE AS head3
FROM embeddings
""")
def str_36_field_extractors(spark, sf):
    e = t(spark, sf, "embeddings")
    arr = F.col("embedding")
    fields = F.array(F.get(arr, 0), F.get(arr, 1), F.get(arr, 2))  # FieldsFromArray
    return e.select("vec_id", F.get(arr, 0).cast("double").alias("f0"),
                    F.get(arr, 2).cast("double").alias("f2"),
                    F.aggregate(fields, F.lit(0.0), lambda a, x: a + x.cast("double")).alias("head3"))
