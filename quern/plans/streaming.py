"""STR-*, AGG-03, JOI-11, OVR-05, SET-02/03, SRC-11/15: streaming runs.

Every query runs a given table as an arriving stream through the real Structured Streaming operators and returns what
the stream emitted.  Most replay it in event-time order (``BATCHES`` micro-batches at most, of ``BATCH_ROWS`` rows or more, and an end of input), so each result
equals a batch query, which is the oracle.  The regular joins, the firings of windows and the merging sessions get their rows out of order,
and rows taken back, from :mod:`quern.streaming.arrival`; their SQL works out the watermark of every slice.
"""

from __future__ import annotations


import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.plans.common import r2, t
from quern.plans.registry import register
from quern.sources.replay import replay
from quern.sources.tables import stream_table, table_path
from quern.streaming import processors as P
from quern.streaming.groups import groups_for, transform_by_groups
from quern.streaming.runner import drop_flush, final_by_key, order_by, run_to_table, state_partitions
from quern.streaming.watermarks import bounded_out_of_orderness
from quern.session import ensure_stateful_conf, scratch_path

_DISORDER = "ts - to_microseconds(CAST(round(value * 60000000) AS BIGINT))"

#: Least rows of a micro-batch and most micro-batches of a table: a larger table comes in larger batches, as the fixed cost
#: of one (state stores, files, log entries) would else grow with the table.  A batch is read by tasks of ``TASK_ROWS``.
BATCH_ROWS, BATCHES, TASK_ROWS = 5_000, 20, 100_000


def events_stream(spark, sf, *, delay: str = "0 seconds", flush: bool = True, repeat: int = 1):
    """The events table as a stream with an event-time watermark on ``ts``."""
    ensure_stateful_conf(spark)
    path = table_path(sf, "events")
    df = replay(spark, path, rows_per_batch=BATCH_ROWS, most_batches=BATCHES, partition_rows=TASK_ROWS, flush=flush, time_column="ts", repeat=repeat)
    df = bounded_out_of_orderness(df, "ts", delay)
    return drop_flush(df, "ts")


def stream_rows(spark, sf, *, repeat: int = 1):
    """The events table as a stream without a watermark: no row is late."""
    return replay(spark, table_path(sf, "events"), rows_per_batch=BATCH_ROWS, most_batches=BATCHES, partition_rows=TASK_ROWS, repeat=repeat)


def _groups(spark, sf):
    """The number of groups of keys that keep the state of a stream of the events."""
    return groups_for(t(spark, sf, "events").count())


def _ts_ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


_TUMBLE_SQL = """
SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS cnt, round(sum(value), 2) AS sum_value
FROM events GROUP BY ALL
"""


def _stream_tumble(spark, sf, delay="0 seconds", mode="append"):
    ev = events_stream(spark, sf, delay=delay)
    agg = (ev.groupBy("event_type", F.window("ts", "1 hour").alias("w"))
             .agg(F.count(F.lit(1)).alias("cnt"), F.sum("value").alias("sum_value"))
             .select("event_type", F.col("w.start").alias("window_start"), "cnt", "sum_value"))
    out = run_to_table(agg, mode, with_batch_id=(mode == "update"))
    if mode == "update":
        out = final_by_key(out, ["event_type", "window_start"])
    return _ts_ntz(out, "window_start").withColumn("sum_value", r2("sum_value"))


@register("str_01_time_characteristic", _TUMBLE_SQL)
def str_01_time_characteristic(spark, sf):
    # event time: the row's own ts column is the time attribute
    return _stream_tumble(spark, sf)


@register("str_02_bounded_out_of_orderness", _TUMBLE_SQL)
def str_02_bounded_out_of_orderness(spark, sf):
    return _stream_tumble(spark, sf, delay="10 minutes")


@register("str_03_ascending_timestamps", """
SELECT count(*) FILTER (WHERE ts < prev) AS out_of_order, count(*) AS cnt
FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS prev FROM events)
""")
def str_03_ascending_timestamps(spark, sf):
    # AscendingTimestampExtractor: watermark = max - 0; violations are counted
    # with a distributed prefix max over arrival order (no single task).
    from quern.operators.prefix import prefix_scan
    ev = t(spark, sf, "events").select("event_id", "ts").withColumn(
        "_us", F.unix_micros(F.col("ts").cast("timestamp")))
    sc = prefix_scan(ev, [], ["event_id"], row_number=None, maxs={"_mx": "_us"})
    return sc.agg(F.count(F.when(F.col("_us") < F.col("_mx"), 1)).alias("out_of_order"),
                  F.count(F.lit(1)).alias("cnt"))


@register("str_05_sql_watermark", _TUMBLE_SQL)
def str_05_sql_watermark(spark, sf):
    from quern.streaming.watermarks import parse_watermark
    col, delay = parse_watermark("WATERMARK FOR ts AS ts - INTERVAL '5' SECOND")
    return _stream_tumble(spark, sf, delay=delay)


@register("str_21_allowed_lateness", _TUMBLE_SQL)
def str_21_allowed_lateness(spark, sf):
    # lateness is folded into the watermark delay; updates refine a window's
    # result and the last update per window is the final one
    return _stream_tumble(spark, sf, delay="30 minutes", mode="update")


@register("str_24_append_stream", "SELECT event_id, event_type, value FROM events WHERE value > 250")
def str_24_append_stream(spark, sf):
    ev = events_stream(spark, sf).filter("value > 250").select("event_id", "event_type", "value")
    return run_to_table(ev, "append")


@register("str_25_event_time_trigger", _TUMBLE_SQL)
def str_25_event_time_trigger(spark, sf):
    return _stream_tumble(spark, sf)


@register("str_26_continuous_trigger", _TUMBLE_SQL)
def str_26_continuous_trigger(spark, sf):
    # early firings: update mode emits every micro-batch's partial results
    return _stream_tumble(spark, sf, mode="update")


@register("str_30_early_late_fire", _TUMBLE_SQL)
def str_30_early_late_fire(spark, sf):
    return _stream_tumble(spark, sf, delay="20 minutes", mode="update")


@register("agg_03_streaming_group_aggregate", """
SELECT user_id, count(*) AS cnt, round(sum(value), 2) AS total FROM events GROUP BY user_id
""")
def agg_03_streaming_group_aggregate(spark, sf):
    ev = events_stream(spark, sf)
    agg = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"), F.sum("value").alias("total"))
    out = final_by_key(run_to_table(agg, "update", with_batch_id=True), ["user_id"])
    return out.withColumn("total", r2("total"))


def _changing_events(spark, sf, gone):
    """Events as a changelog out of order: each is added at a scattered arrival number below 1000, and those that are ``gone`` are taken back
    at one from 1000 on, so that every micro-batch but the first ones takes rows back."""
    from quern.streaming.arrival import arrive
    ensure_stateful_conf(spark)
    ev = t(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    added = ev.select("*", F.lit("+").alias("op"), F.expr(_SCATTER).alias("arrival"))
    taken = ev.filter(gone).select("*", F.lit("-").alias("op"), (F.expr(_SCATTER) + 1000).alias("arrival"))
    return arrive(added.unionByName(taken), "arrival", [500, 1000, 1300, 1600])


@register("agg_03_retract_aggregates", """
SELECT user_id, count(*) AS cnt, round(sum(value), 6) AS total, round(avg(value), 6) AS mean, min(value) AS least, max(value) AS most,
       count(DISTINCT event_type) AS kinds, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS ids
FROM events WHERE event_id % 3 <> 0 AND value <= 60 GROUP BY user_id
""")
def agg_03_retract_aggregates(spark, sf):
    from quern.streaming.joins import folded
    from quern.streaming.retract import Agg, retract_aggregate
    log = retract_aggregate(_changing_events(spark, sf, "event_id % 3 = 0 OR value > 60"), ["user_id"], {
        "cnt": Agg("count"), "total": Agg("sum", "value"), "mean": Agg("avg", "value"), "least": Agg("min", "value"), "most": Agg("max", "value"),
        "kinds": Agg("count_distinct", "event_type"), "ids": Agg("listagg", "event_id", order="event_id")}, groups=_groups(spark, sf))
    out = folded(run_to_table(log, "append"))
    return out.withColumns({c: F.round(c, 6) for c in ("total", "mean")})


@register("agg_16_min_max_retract", """
SELECT event_type, min(value) AS least, max(value) AS most, max(event_id) AS last_id FROM events WHERE value BETWEEN 5 AND 100 GROUP BY event_type
""")
def agg_16_min_max_retract(spark, sf):
    # the smallest and largest values are taken back bit by bit; a few keys hold all rows, each in 512 parts
    from quern.streaming.joins import folded
    from quern.streaming.retract import Agg, retract_aggregate
    log = retract_aggregate(_changing_events(spark, sf, "value < 5 OR value > 100"), ["event_type"],
                            {"least": Agg("min", "value"), "most": Agg("max", "value"), "last_id": Agg("max", "event_id")}, parts=512)
    return folded(run_to_table(log, "append"))


@register("agg_03_aggregate_of_join", f"""
SELECT user_id, count(*) AS pairs, count(v_id) AS matched, max(v_id) AS last_view, min(p_id) AS first_purchase FROM (
  SELECT l.user_id, l.p_id, r.v_id FROM (SELECT user_id, event_id AS p_id, value AS p_value FROM events WHERE event_type = 'purchase' AND event_id % 3 <> 0) l
  LEFT JOIN (SELECT user_id, event_id AS v_id, value AS v_value FROM events WHERE event_type = 'view' AND event_id % 3 <> 0) r
    ON l.user_id = r.user_id AND r.v_value >= l.p_value) GROUP BY user_id
""")
def agg_03_aggregate_of_join(spark, sf):
    # a changelog through the plan: the left join takes padded rows back, the aggregate of it follows
    from quern.streaming.joins import folded, regular_join
    from quern.streaming.retract import Agg, retract_aggregate
    from quern.streaming.arrival import arrive
    ensure_stateful_conf(spark)
    left = arrive(_changes(spark, sf, "purchase", {"event_id": "p_id", "value": "p_value"}), "arrival", [500, 1000, 1500])
    right = arrive(_changes(spark, sf, "view", {"event_id": "v_id", "value": "v_value"}), "arrival", [300, 1200])
    log = regular_join(left, right, ["user_id"], "left", on=lambda p, v: p[1] is not None and v[1] is not None and v[1] >= p[1])
    out = retract_aggregate(log, ["user_id"], {"pairs": Agg("count"), "matched": Agg("count", "v_id"), "last_view": Agg("max", "v_id"),
                                               "first_purchase": Agg("min", "p_id")})
    return folded(run_to_table(out, "append"))


@register("str_08_session_window_stream", """
WITH f AS (
  SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                   OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE
                 THEN 1 ELSE 0 END AS nw FROM events),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS cnt
FROM g GROUP BY user_id, sid
""")
def str_08_session_window_stream(spark, sf):
    ev = events_stream(spark, sf)
    agg = (ev.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w"))
             .agg(F.count(F.lit(1)).alias("cnt"))
             .select("user_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cnt"))
    return _ts_ntz(run_to_table(agg, "append"), "window_start", "window_end")


@register("str_07_sliding_window_stream", """
WITH w AS (SELECT e.*, time_bucket(INTERVAL 30 MINUTE, ts) - to_minutes(30 * k) AS window_start
           FROM events e, range(0, 4) r(k))
SELECT event_type, window_start, count(*) AS cnt FROM w GROUP BY ALL
""")
def str_07_sliding_window_stream(spark, sf):
    ev = events_stream(spark, sf)
    agg = (ev.groupBy("event_type", F.window("ts", "2 hours", "30 minutes").alias("w"))
             .agg(F.count(F.lit(1)).alias("cnt"))
             .select("event_type", F.col("w.start").alias("window_start"), "cnt"))
    return _ts_ntz(run_to_table(agg, "append"), "window_start")


def _tws(spark, sf, keys, proc, schema, mode="Append", time_mode="None", delay="0 seconds", carry=None):
    """``carry``: the columns that the processor reads beside the keys; the state is then kept by groups of keys."""
    ev = events_stream(spark, sf, delay=delay)
    if carry:
        out = transform_by_groups(ev.select(*keys, *carry), keys, proc, schema, mode, time_mode, _groups(spark, sf))
    else:
        out = ev.groupBy(*keys).transformWithState(proc, schema, mode, time_mode)
    return run_to_table(out, mode.lower(), with_batch_id=(mode == "Update"))


@register("str_27_count_trigger", """
WITH n AS (SELECT user_id, row_number() OVER w AS rn, sum(value) OVER w AS s
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT user_id AS key, rn AS fire_seq, rn AS cnt, round(s, 2) AS total FROM n WHERE rn % 4 = 0
""")
def str_27_count_trigger(spark, sf):
    schema = "key long, fire_seq long, cnt long, total double"
    return _tws(spark, sf, ["user_id"], P.CountTrigger(4, "value", "ts", "event_id"), schema)


@register("str_29_purging_trigger", """
WITH n AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, value FROM events)
SELECT user_id AS key, max(rn) AS fire_seq, count(*) AS cnt, round(sum(value), 2) AS total
FROM n GROUP BY user_id, (rn - 1) // 4 HAVING count(*) = 4
""")
def str_29_purging_trigger(spark, sf):
    schema = "key long, fire_seq long, cnt long, total double"
    return _tws(spark, sf, ["user_id"], P.CountTrigger(4, "value", "ts", "event_id", purge=True), schema)


@register("str_28_delta_trigger")
def str_28_delta_trigger(spark, sf):
    # sequential per key (distance to the last *fired* row): no SQL form;
    # checked against a brute-force fold in the tests
    schema = "key long, event_id long, value double, cnt long"
    return _tws(spark, sf, ["user_id"], P.DeltaTrigger(200.0, "value", "ts", "event_id"), schema)


@register("str_31_custom_trigger", """
WITH n AS (SELECT user_id, event_id, value, ts,
                  coalesce(sum(CASE WHEN value > 400 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM events)
SELECT user_id AS key, max(CASE WHEN value > 400 THEN event_id END) AS fired_by, count(*) AS cnt,
       round(sum(value), 2) AS total
FROM n GROUP BY user_id, seg HAVING max(CASE WHEN value > 400 THEN 1 ELSE 0 END) = 1
""")
def str_31_custom_trigger(spark, sf):
    schema = "key long, fired_by long, cnt long, total double"
    return _tws(spark, sf, ["user_id"], P.CustomTrigger(400.0, "value", "ts", "event_id"), schema)


_SESSION_1H = """
WITH f AS (
  SELECT *, epoch_us(ts) // 1000 AS ms,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR epoch_us(ts) // 1000 - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) // 1000 > 3600000
              THEN 1 ELSE 0 END AS nw FROM events),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id AS key, make_timestamp(min(ms) * 1000) AS session_start,
       make_timestamp((max(ms) + 3600000) * 1000) AS session_end, count(*) AS cnt
FROM g GROUP BY user_id, sid
"""


@register("str_37_keyed_process_function", _SESSION_1H)
def str_37_keyed_process_function(spark, sf):
    schema = "key long, session_start timestamp, session_end timestamp, cnt long"
    out = _tws(spark, sf, ["user_id"], P.InactivityTimeout(3_600_000, "ts", "event_id"), schema,
               time_mode="EventTime", carry=["ts", "event_id"])
    return _ts_ntz(out, "session_start", "session_end")


@register("str_39_timers", """
WITH e AS (SELECT *, epoch_us(ts) // 1000 AS ms FROM events)
SELECT s.user_id AS key, s.event_id AS start_id, make_timestamp(s.ms * 1000) AS start_ts
FROM e s WHERE s.event_type = 'signup' AND NOT EXISTS (
  SELECT 1 FROM e p WHERE p.user_id = s.user_id AND p.event_type = 'purchase'
    AND p.ms >= s.ms AND p.ms <= s.ms + 86400000)
""")
def str_39_timers(spark, sf):
    schema = "key long, start_id long, start_ts timestamp"
    proc = P.PendingTimeout(86_400_000, "event_type", "signup", "purchase", "ts", "event_id")
    out = _tws(spark, sf, ["user_id"], proc, schema, time_mode="EventTime")
    return _ts_ntz(out, "start_ts")


@register("str_40_keyed_state_kinds", """
SELECT user_id AS key, event_type AS category, count(*) AS cnt FROM events GROUP BY ALL
""")
def str_40_keyed_state_kinds(spark, sf):
    schema = "key long, category string, cnt long, total long"
    out = _tws(spark, sf, ["user_id"], P.StateKinds("event_type", "ts", "event_id"), schema, mode="Update", carry=["ts", "event_id", "event_type"])
    return final_by_key(out, ["key", "category"]).drop("total")


@register("str_41_state_ttl", """
SELECT user_id AS key, event_type AS category, count(*) AS cnt FROM events GROUP BY ALL
""")
def str_41_state_ttl(spark, sf):
    # Idle-state retention of 30 days (event time): state untouched for that
    # long is cleared by a timer.  No user is idle that long in the data, so
    # the result equals the plain count per key and category.
    schema = "key long, category string, cnt long, total long"
    proc = P.StateKinds("event_type", "ts", "event_id", retention_ms=30 * 86_400_000)
    out = _tws(spark, sf, ["user_id"], proc, schema, mode="Update", time_mode="EventTime", carry=["ts", "event_id", "event_type"])
    return final_by_key(out, ["key", "category"]).drop("total")


def _value_accumulators():
    """Reducing state: the row of the largest value, the first among equals; aggregating state: (n, sum) that gives a mean."""
    from quern.streaming.accumulators import aggregating, reducing
    best = reducing("value double, event_id long", lambda r: None if r["value"] is None else (r["value"], r["event_id"]),
                    lambda a, b: max(a, b, key=lambda x: (x[0], -x[1])))
    mean = aggregating("n long, s double", "double", lambda: (0, 0.0),
                       lambda acc, r: acc if r["value"] is None else (acc[0] + 1, acc[1] + r["value"]),
                       lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda acc: acc[1] / acc[0] if acc[0] else None)
    count = aggregating("n long", "long", lambda: (0,), lambda acc, r: (acc[0] + 1,), lambda a, b: (a[0] + b[0],), lambda acc: acc[0])
    return {"best": best, "mean": mean, "cnt": count}


@register("str_40_reducing_aggregating_state", """
SELECT user_id, max(value) AS best_value, arg_min(event_id, (-value, event_id)) AS best_id, round(avg(value) * count(*), 2) AS mean_by_cnt, count(*) AS cnt
FROM events GROUP BY user_id
""")
def str_40_reducing_aggregating_state(spark, sf):
    from quern.streaming.accumulators import accumulate
    ensure_stateful_conf(spark)
    acc = accumulate(stream_rows(spark, sf).select("user_id", "event_id", "value"), ["user_id"], _value_accumulators(), groups=_groups(spark, sf))
    out = final_by_key(run_to_table(acc, "update", with_batch_id=True), ["user_id"])
    return out.select("user_id", F.col("best.value").alias("best_value"), F.col("best.event_id").alias("best_id"),
                      r2(F.col("mean") * F.col("cnt")).alias("mean_by_cnt"), "cnt")


_SHORTEST, _LONGEST = 20 * 3_600_000, 30 * 3_600_000


@register("str_41_idle_state_retention", f"""
WITH RECURSIVE e AS (SELECT user_id, event_id, value, epoch_us(ts) // 1000 AS ms,
                            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
s AS (SELECT user_id, rn, ms + {_LONGEST} AS due, 1 AS life FROM e WHERE rn = 1
      UNION ALL
      SELECT e.user_id, e.rn, CASE WHEN e.ms >= s.due OR e.ms + {_SHORTEST} > s.due THEN e.ms + {_LONGEST} ELSE s.due END,
             CASE WHEN e.ms >= s.due THEN s.life + 1 ELSE s.life END
      FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1)
SELECT user_id, max(value) AS best_value, arg_min(event_id, (-value, event_id)) AS best_id, round(avg(value) * count(*), 2) AS mean_by_cnt, count(*) AS cnt
FROM s JOIN e USING (user_id, rn) GROUP BY user_id, life
""")
def str_41_idle_state_retention(spark, sf):
    # users idle for 20 to 30 hours lose their state and begin anew: six lives a user in the small tables
    from quern.streaming.accumulators import accumulate_until_idle
    ev = events_stream(spark, sf).select("user_id", "ts", "event_id", "value")
    acc = accumulate_until_idle(ev, ["user_id"], _value_accumulators(), "ts", "event_id",
                                shortest_ms=_SHORTEST, longest_ms=_LONGEST, groups=_groups(spark, sf))
    return run_to_table(acc, "append").select("user_id", F.col("best.value").alias("best_value"),
                                              F.col("best.event_id").alias("best_id"), r2(F.col("mean") * F.col("cnt")).alias("mean_by_cnt"), "cnt")


@register("str_23_retract_stream", """
SELECT user_id AS key, count(*) AS cnt, round(sum(value), 2) AS total FROM events GROUP BY user_id
""")
def str_23_retract_stream(spark, sf):
    # the changelog (-old, +new per change) folded back: sum of signed rows
    schema = "op string, key long, cnt long, total double"
    sums = P.partial_totals(events_stream(spark, sf), ["user_id"], "value", "n")
    log = run_to_table(sums.groupBy("user_id").transformWithState(P.Changelog("value", "n"), schema, "Append", "None"), "append")
    sign = F.when(F.col("op") == "+", 1).otherwise(-1)
    return log.groupBy("key").agg(F.sum(sign * F.col("cnt")).cast("long").alias("cnt"),
                                  r2(F.sum(sign * F.col("total"))).alias("total"))


@register("set_02_streaming_temporal_sort", """
SELECT user_id AS key, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, event_id,
       date_trunc('millisecond', ts) AS ts
FROM events
""")
def set_02_streaming_temporal_sort(spark, sf):
    schema = "key long, seq long, event_id long, ts timestamp, running_sum double"
    out = _tws(spark, sf, ["user_id"], P.EventTimeOrdered("ts", "event_id", "value"), schema,
               time_mode="EventTime", carry=["ts", "event_id", "value"])
    return _ts_ntz(out, "ts").drop("running_sum")


@register("ovr_05_streaming_over", """
SELECT user_id AS key, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                         ROWS UNBOUNDED PRECEDING), 2) AS running_sum
FROM events
""")
def ovr_05_streaming_over(spark, sf):
    schema = "key long, seq long, event_id long, ts timestamp, running_sum double"
    out = _tws(spark, sf, ["user_id"], P.EventTimeOrdered("ts", "event_id", "value"), schema,
               time_mode="EventTime", carry=["ts", "event_id", "value"])
    return out.select("key", "event_id", "running_sum")


@register("set_03_streaming_full_sort", """
SELECT event_type, count(*) AS cnt, rank() OVER (ORDER BY count(*) DESC) AS pos FROM events GROUP BY event_type
""")
def set_03_streaming_full_sort(spark, sf):
    # a full sort of a stream is only allowed on a complete-mode aggregate
    ev = events_stream(spark, sf)
    agg = order_by(ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt")), "cnt", ascending=False)
    out = run_to_table(agg, "complete", with_batch_id=True)
    last = out.agg(F.max("_batch_id")).first()[0]
    from pyspark.sql import Window
    fin = out.filter(F.col("_batch_id") == last).drop("_batch_id")
    # the final table has one row per event type: a bounded, single-task rank
    return fin.withColumn("pos", F.rank().over(Window.orderBy(F.col("cnt").desc())).cast("long"))


@register("str_38_two_input_process", """
SELECT p.user_id AS key, p.event_id AS probe_id,
       (SELECT v.event_id FROM events v WHERE v.user_id = p.user_id AND v.event_type = 'view'
          AND (v.ts < p.ts OR (v.ts = p.ts AND v.event_id < p.event_id)) ORDER BY v.ts DESC, v.event_id DESC LIMIT 1) AS ref_id
FROM events p WHERE p.event_type = 'purchase'
""")
def str_38_two_input_process(spark, sf):
    schema = "key long, probe_id long, ref_id long"
    proc = P.LatestOfOther("event_type", "view", "purchase", "ts", "event_id")
    return _tws(spark, sf, ["user_id"], proc, schema)


@register("ovr_14_streaming_top_n", """
SELECT event_type AS key, rank_num, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank_num FROM events)
WHERE rank_num <= 3
""")
def ovr_14_streaming_top_n(spark, sf):
    # five keys have all rows: what can't be in the top 3 is left out before they meet
    schema = "key string, rank_num long, event_id long, value double"
    best = P.partial_top(events_stream(spark, sf), ["event_type"], 3, "value", "event_id")
    top = best.groupBy("event_type").transformWithState(P.TopN(3, "value", "event_id"), schema, "Update", "None")
    out = run_to_table(top, "update", with_batch_id=True)
    return final_by_key(out, ["key", "rank_num"])


@register("ovr_16_streaming_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def ovr_16_streaming_dedup(spark, sf):
    # every key seen is remembered, so the stream itself emits one row per key
    d = stream_rows(spark, sf).dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")
    return run_to_table(d, "append")


@register("src_11_ack_source_dedup", "SELECT event_id, event_type, value FROM events")
def src_11_ack_source_dedup(spark, sf):
    # at-least-once replay (every message delivered twice) + id de-duplication
    # by remembered ids: a late first delivery stays, a second one never does
    ev = stream_rows(spark, sf, repeat=2)
    d = ev.dropDuplicates(["event_id"]).select("event_id", "event_type", "value")
    return run_to_table(d, "append")


@register("src_15_table_scan_stream", """
SELECT event_type, count(*) AS cnt FROM events WHERE value > 100 GROUP BY event_type
""", bench=True)
def src_15_table_scan_stream(spark, sf):
    ev = stream_table(spark, sf, "events").filter("value > 100")
    agg = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    return final_by_key(run_to_table(agg, "update", with_batch_id=True), ["event_type"])


_P = "(SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase')"
_V = "(SELECT user_id, ts AS v_ts, event_id AS v_id FROM events WHERE event_type = 'view')"


@register("joi_11_regular_streaming_join", f"""
SELECT p.event_id, v.v_id FROM {_P} p JOIN {_V} v
  ON p.user_id = v.user_id AND v.v_ts BETWEEN p.ts - INTERVAL 2 HOUR AND p.ts + INTERVAL 1 HOUR
""")
def joi_11_regular_streaming_join(spark, sf):
    ev = events_stream(spark, sf, delay="3 hours")
    p = ev.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    v = ev.filter("event_type = 'view'").select(F.col("user_id").alias("v_user"), F.col("ts").alias("v_ts"),
                                                F.col("event_id").alias("v_id"))
    j = p.join(v, (p.user_id == v.v_user) & (v.v_ts >= p.ts - F.expr("INTERVAL 2 HOURS"))
               & (v.v_ts <= p.ts + F.expr("INTERVAL 1 HOUR")), "inner")
    return run_to_table(j.select("event_id", "v_id"), "append")


# Purchases and views as changelogs that arrive out of order: every event is added at a scattered arrival number
# below 1000, and every third is taken back at one from 1000 on.
_SCATTER = "(event_id * 7919) % 1000"
_LEFT = "(SELECT user_id, event_id AS p_id, value AS p_value FROM events WHERE event_type = 'purchase' AND event_id % 3 <> 0)"
_RIGHT = "(SELECT user_id, event_id AS v_id, value AS v_value FROM events WHERE event_type = 'view' AND event_id % 3 <> 0)"
_JOIN_ON = "l.user_id = r.user_id AND r.v_value >= l.p_value"


def _changes(spark, sf, kind, names):
    ev = t(spark, sf, "events").filter(F.col("event_type") == kind)
    row = [F.col("user_id"), *[F.col(c).alias(n) for c, n in names.items()]]
    added = ev.select(*row, F.lit("+").alias("op"), F.expr(_SCATTER).alias("arrival"))
    taken = ev.filter("event_id % 3 = 0").select(*row, F.lit("-").alias("op"), (F.expr(_SCATTER) + 1000).alias("arrival"))
    return added.unionByName(taken)


def _regular_join(spark, sf, how):
    from quern.streaming.arrival import arrive
    from quern.streaming.joins import folded, regular_join
    ensure_stateful_conf(spark)
    left = arrive(_changes(spark, sf, "purchase", {"event_id": "p_id", "value": "p_value"}), "arrival", [500, 1000, 1500])
    right = arrive(_changes(spark, sf, "view", {"event_id": "v_id", "value": "v_value"}), "arrival", [300, 1200])
    log = regular_join(left, right, ["user_id"], how, on=lambda p, v: p[1] is not None and v[1] is not None and v[1] >= p[1])
    return folded(run_to_table(log, "append")).drop("p_value", "v_value")


def _regular_join_sql(how):
    if how in ("semi", "anti"):
        return f"SELECT l.user_id, l.p_id FROM {_LEFT} l WHERE {'NOT ' * (how == 'anti')}EXISTS (SELECT 1 FROM {_RIGHT} r WHERE {_JOIN_ON})"
    return f"SELECT coalesce(l.user_id, r.user_id) AS user_id, p_id, v_id FROM {_LEFT} l {how.upper()} JOIN {_RIGHT} r ON {_JOIN_ON}"


@register("joi_11_regular_join_inner", _regular_join_sql("inner"))
def joi_11_regular_join_inner(spark, sf):
    return _regular_join(spark, sf, "inner")


@register("joi_11_regular_join_left", _regular_join_sql("left"))
def joi_11_regular_join_left(spark, sf):
    return _regular_join(spark, sf, "left")


@register("joi_11_regular_join_right", _regular_join_sql("right"))
def joi_11_regular_join_right(spark, sf):
    return _regular_join(spark, sf, "right")


@register("joi_11_regular_join_full", _regular_join_sql("full"))
def joi_11_regular_join_full(spark, sf):
    return _regular_join(spark, sf, "full")


@register("joi_11_regular_join_semi", _regular_join_sql("semi"))
def joi_11_regular_join_semi(spark, sf):
    return _regular_join(spark, sf, "semi")


@register("joi_11_regular_join_anti", _regular_join_sql("anti"))
def joi_11_regular_join_anti(spark, sf):
    return _regular_join(spark, sf, "anti")


@register("joi_12_time_windowed_join_stream")
def joi_12_time_windowed_join_stream(spark, sf):
    # Left outer time-windowed join on two watermarked streams.  Unmatched
    # rows whose interval reaches past the end of the input are not emitted
    # by Spark at end of input (they would be on further data), so this id has
    # no SQL oracle; the inner form is checked in joi_11 and the batch outer
    # forms in joi_12_time_windowed_join.
    ev = events_stream(spark, sf, delay="3 hours")
    p = ev.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    v = ev.filter("event_type = 'view'").select(F.col("user_id").alias("v_user"), F.col("ts").alias("v_ts"),
                                                F.col("event_id").alias("v_id"))
    j = p.join(v, (p.user_id == v.v_user) & (v.v_ts >= p.ts - F.expr("INTERVAL 2 HOURS"))
               & (v.v_ts <= p.ts + F.expr("INTERVAL 1 HOUR")), "leftOuter")
    return run_to_table(j.select("event_id", "v_id"), "append")


@register("str_44_queryable_state", """
SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id
""")
def str_44_queryable_state(spark, sf):
    # read the latest value per key straight from the query's state store
    ev = events_stream(spark, sf)
    agg = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    ck = scratch_path(spark, "qs_ck")
    with state_partitions(spark):
        q = (agg.writeStream.outputMode("update").format("noop").option("checkpointLocation", ck).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    st = spark.read.format("statestore").load(ck)
    vals = st.select("key.user_id", "value.*")          # the aggregation buffer
    return vals.toDF("user_id", "cnt")


# --- firings of event-time windows on rows out of order -----------------------------------------

# Event time lies `value` minutes behind the order of arrival (event_id), which comes in eight micro-batches.
# One-hour windows a user; watermark one hour behind the largest event time of the micro-batches before.
_H = 3_600_000


def _firings_sql(lateness, early):
    early_rows = "" if not early else f"""
UNION ALL
SELECT user_id AS key, make_timestamp(start * 1000) AS window_start, 'early' AS firing, make_timestamp((start + j * {early}) * 1000) AS at, cnt, round(total, 2) AS total
FROM (SELECT *, coalesce(lag(cnt) OVER (PARTITION BY user_id, start ORDER BY batch), 0) AS told FROM (
  SELECT r.user_id, r.start, m.batch, (m.mark - r.start) // {early} AS j, count(*) AS cnt, sum(r.value) AS total
  FROM r JOIN m ON r.batch < m.batch WHERE m.mark < r.fin AND m.mark >= r.start + {early} AND r.ontime
    AND (m.prev IS NULL OR m.prev < r.start OR (m.mark - r.start) // {early} > (m.prev - r.start) // {early}) GROUP BY ALL))
WHERE cnt > told"""
    return f"""
WITH e AS (SELECT user_id, event_id, value, epoch_us({_DISORDER}) // 1000 AS ms,
                  least(7, event_id * 8 // ((SELECT max(event_id) FROM events) + 1)) AS batch FROM events),
s AS (SELECT batch, max(ms) AS top FROM e GROUP BY batch),
m AS (SELECT batch, mark, lag(mark) OVER (ORDER BY batch) AS prev FROM (SELECT b AS batch, (SELECT max(top) FROM s WHERE s.batch < b) - {_H} AS mark FROM range(0, 9) AS t(b))),
k AS (SELECT e.*, ms // {_H} * {_H} AS start, ms // {_H} * {_H} + {_H} - 1 AS fin, coalesce(m.mark, 0) AS mark FROM e JOIN m USING (batch)),
r AS (SELECT *, mark < fin AS ontime FROM k WHERE mark < fin + {lateness}),
c AS (SELECT *, count(*) OVER w AS cnt, sum(value) OVER w AS total FROM r WINDOW w AS (PARTITION BY user_id, start ORDER BY NOT ontime, event_id ROWS UNBOUNDED PRECEDING))
SELECT user_id AS key, make_timestamp(start * 1000) AS window_start, 'late' AS firing, make_timestamp(ms * 1000) AS at, cnt, round(total, 2) AS total FROM c WHERE NOT ontime
UNION ALL
SELECT user_id, make_timestamp(start * 1000), 'on time', make_timestamp(fin * 1000), count(*), round(sum(value), 2) FROM r WHERE ontime GROUP BY user_id, start, fin{early_rows}
"""


def _late_events(spark, sf, *more):
    """The events with their event time ``ets``, as a stream in order of arrival and a far row at the end."""
    from quern.streaming.arrival import arrive
    ensure_stateful_conf(spark)
    ev = t(spark, sf, "events").select("user_id", "event_id", "value", F.expr(
        "ts - make_dt_interval(0, 0, 0, CAST(round(value * 60000000) AS DECIMAL(18, 0)) / 1000000)").alias("ets"), F.lit(False).alias("_eoi"), *more)
    n = ev.agg(F.max("event_id")).first()[0] + 1
    batch = F.least(F.lit(7), F.floor(F.col("event_id") * 8 / F.lit(n)))
    end = spark.createDataFrame([(None, None, None, None, True, *[None] * len(more))], ev.schema).withColumns({"ets": F.lit("2100-01-01").cast("timestamp_ntz"), "batch": F.lit(9).cast("long")})
    return arrive(ev.withColumn("batch", batch.cast("long")), "batch", list(range(1, 8)), closing=end)


def _firings(spark, sf, lateness, early=None):
    from quern.streaming.windows import timed_windows
    rows = _late_events(spark, sf)
    out = timed_windows(rows, "user_id", "ets", "value", "event_id", size_ms=_H, bound_ms=_H, lateness_ms=lateness, early_ms=early,
                        drop=lambda d: drop_flush(d, "ets"), groups=_groups(spark, sf))
    return _ts_ntz(run_to_table(out, "append"), "window_start", "at")


@register("str_21_late_firings", _firings_sql(12 * _H, None))
def str_21_late_firings(spark, sf):
    # allowed lateness of twelve hours: each late row fires its window again
    return _firings(spark, sf, 12 * _H)


@register("str_26_interval_firings", _firings_sql(0, _H // 4))
def str_26_interval_firings(spark, sf):
    # a firing at the last quarter of an hour that the watermark has passed, if rows came since the one before
    return _firings(spark, sf, 0, _H // 4)


@register("str_30_early_and_late_firings", _firings_sql(6 * _H, _H // 2))
def str_30_early_and_late_firings(spark, sf):
    return _firings(spark, sf, 6 * _H, _H // 2)


@register("str_31_merging_sessions", f"""
WITH e AS (SELECT user_id, epoch_us({_DISORDER}) // 1000 AS ms FROM events),
f AS (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms) <= {_H} THEN 0 ELSE 1 END AS opens FROM e),
g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id AS key, make_timestamp(min(ms) * 1000) AS session_start, make_timestamp((max(ms) + {_H}) * 1000) AS session_end, count(*) AS cnt
FROM g GROUP BY user_id, sid
""")
def str_31_merging_sessions(spark, sf):
    # Rows come up to `value` minutes behind their time, within the watermark's 24 hours: a late row opens a session
    # before others, widens one, or makes two one; the sessions are those of the ordered table.
    late = bounded_out_of_orderness(_late_events(spark, sf), "ets", "25 hours")
    out = drop_flush(late, "ets").groupBy("user_id").transformWithState(
        P.InactivityTimeout(_H, "ets", "event_id", held_back_ms=_H), "key long, session_start timestamp, session_end timestamp, cnt long", "Append", "EventTime")
    return _ts_ntz(run_to_table(out, "append"), "session_start", "session_end")


# --- MATCH_RECOGNIZE -------------------------------------------------------------

def _views_then_purchase():
    from quern.operators.match import Var
    pattern = [Var("V", 1, None, True), Var("P", 1, 1)]
    define = {"V": F.col("event_type") == "view", "P": F.col("event_type") == "purchase"}
    measures = {"first_view": ("first", "V", "event_id"), "n_views": ("count", "V", "event_id"),
                "purchase_id": ("last", "P", "event_id"), "amount": ("sum", "P", "value"),
                "last_var": "classifier", "match_rowtime": "match_rowtime"}
    schema = ("first_view long, n_views long, purchase_id long, amount double, last_var string, "
              "match_rowtime timestamp")
    return pattern, define, measures, schema


@register("str_50_match_recognize", """
WITH n AS (SELECT *, count(*) FILTER (WHERE event_type IS DISTINCT FROM 'view') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS others FROM events)
SELECT p.user_id, first(v.event_id ORDER BY v.ts, v.event_id) AS first_view, count(*) AS n_views, p.event_id AS purchase_id, p.value AS amount,
       'P' AS last_var, p.ts AS match_rowtime
FROM n p JOIN n v ON v.user_id = p.user_id AND v.others = p.others - 1
WHERE p.event_type = 'purchase' AND v.event_type = 'view' AND epoch_ms(p.ts) - epoch_ms(v.ts) <= 86400000
GROUP BY p.user_id, p.event_id, p.value, p.ts
""")
def str_50_match_recognize(spark, sf):
    # PATTERN (V+ P) WITHIN INTERVAL '1' DAY, AFTER MATCH SKIP PAST LAST ROW:
    # views directly followed by a purchase of the same user.  The SQL numbers the rows that aren't views, so that the views
    # of one number stand together; the tests hold it against a brute-force matcher as well.
    from quern.operators.match import match_recognize_stream
    pattern, define, measures, schema = _views_then_purchase()
    ev = events_stream(spark, sf)
    m = match_recognize_stream(ev, ["user_id"], ["ts", "event_id"], pattern, define, measures, schema,
                               within_ms=86_400_000, groups=_groups(spark, sf))
    return _ts_ntz(run_to_table(m, "append"), "match_rowtime")


@register("str_50_match_out_of_order", f"""
WITH e AS (SELECT user_id, event_id, event_type, {_DISORDER} AS ets FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ets, event_id) AS pos FROM e),
g AS (SELECT *, pos - row_number() OVER (PARTITION BY user_id, event_type ORDER BY pos) AS island FROM n),
i AS (SELECT user_id, event_type, island, min(pos) AS lo FROM g GROUP BY ALL),
f AS (SELECT *, lead(event_type) OVER w AS t1, lead(lo) OVER w AS lo1, lead(event_type, 2) OVER w AS t2, lead(lo, 2) OVER w AS lo2
      FROM i WINDOW w AS (PARTITION BY user_id ORDER BY lo)),
s AS (SELECT g.user_id, g.event_id AS first_id, g.pos, CASE WHEN t1 = 'purchase' THEN lo1 WHEN t1 = 'click' AND t2 = 'purchase' THEN lo2 END AS fin,
             CASE WHEN t1 = 'click' THEN lo2 - lo1 ELSE 0 END AS n_clicks
      FROM g JOIN f USING (user_id, event_type, island) WHERE event_type = 'view')
SELECT s.user_id, first_id, CASE WHEN fin > s.pos + 1 THEN b.event_id END AS second_id, l.event_id AS last_id, fin - s.pos AS n_rows, n_clicks,
       p.event_id AS purchase_id
FROM s JOIN n p ON p.user_id = s.user_id AND p.pos = fin JOIN n l ON l.user_id = s.user_id AND l.pos = fin - 1
JOIN n b ON b.user_id = s.user_id AND b.pos = s.pos + 1
""")
def str_50_match_out_of_order(spark, sf):
    # PATTERN (V+ C* P), SUBSET VC = (V, C), AFTER MATCH SKIP TO NEXT ROW, on rows whose event time goes to and fro: a row waits until
    # the watermark has passed it.  The delay is the largest disorder, so no row is late.
    from quern.operators.match import Var, match_recognize_stream
    rows = bounded_out_of_orderness(_late_events(spark, sf, "event_type"), "ets", "11 hours")
    kind = lambda name: F.col("event_type") == name
    m = match_recognize_stream(
        drop_flush(rows, "ets"), ["user_id"], ["ets", "event_id"], [Var("V", 1, None), Var("C", 0, None), Var("P")],
        {"V": kind("view"), "C": kind("click"), "P": kind("purchase")},
        {"first_id": ("first", "VC", "event_id"), "second_id": ("first", None, "event_id", 1), "last_id": ("last", "VC", "event_id"),
         "n_rows": ("count", "VC", "event_id"), "n_clicks": ("count", "C", "event_id"), "purchase_id": ("last", "P", "event_id")},
        "first_id long, second_id long, last_id long, n_rows long, n_clicks long, purchase_id long", after="TO NEXT ROW", subset={"VC": ["V", "C"]},
        groups=_groups(spark, sf))
    m = m.withColumn("second_id", F.when(F.col("n_rows") > 1, F.col("second_id")))
    return run_to_table(m, "append")


@register("str_50_match_fixed_length", """
WITH n AS (SELECT user_id, event_id, event_type,
                  lead(event_type, 1) OVER w AS t1, lead(event_type, 2) OVER w AS t2,
                  lead(event_id, 2) OVER w AS last_id
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id AS a_id, last_id AS c_id FROM n
WHERE event_type = 'view' AND t1 = 'click' AND t2 = 'purchase'
""", bench=True)
def str_50_match_fixed_length(spark, sf):
    # PATTERN (A B C), AFTER MATCH SKIP TO NEXT ROW: compiled to lead columns
    from quern.operators.match import match_fixed_length
    ev = t(spark, sf, "events")
    return match_fixed_length(ev, ["user_id"], ["ts", "event_id"], ["A", "B", "C"],
                              {"A": F.col("event_type") == "view", "B": F.col("event_type") == "click",
                               "C": F.col("event_type") == "purchase"},
                              {"a_id": ("A", "event_id"), "c_id": ("C", "event_id")})


@register("str_51_match_navigation", """
WITH n AS (SELECT user_id, event_id, value, lag(value) OVER w AS prev_value,
                  lead(value) OVER w AS next_value, lead(event_id) OVER w AS next_id
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id AS a_id, next_id AS b_id FROM n
WHERE value > prev_value AND next_value > value
""")
def str_51_match_navigation(spark, sf):
    # DEFINE A AS A.value > PREV(A.value), B AS B.value > PREV(B.value):
    # PREV is a lag over the match order
    from quern.operators.match import lag_column, match_fixed_length
    ev = t(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    ev = lag_column(ev, ["user_id"], ["ts", "event_id"], "value", "_prev_value")
    up = F.col("value") > F.col("_prev_value")
    return match_fixed_length(ev, ["user_id"], ["ts", "event_id"], ["A", "B"], {"A": up, "B": up},
                              {"a_id": ("A", "event_id"), "b_id": ("B", "event_id")})


@register("str_51_match_so_far", """
WITH RECURSIVE n AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
w AS (SELECT user_id, pos AS start, pos, value, value AS low, 0::DOUBLE AS total, 0 AS n, false AS done FROM n
      UNION ALL
      SELECT w.user_id, w.start, n.pos, n.value, least(w.low, n.value), CASE WHEN n.value > w.value THEN w.total + n.value ELSE w.total END,
             w.n + (n.value > w.value)::INT, n.value <= w.value
      FROM w JOIN n ON n.user_id = w.user_id AND n.pos = w.pos + 1
      WHERE NOT w.done AND ((n.value > w.value AND w.total + n.value <= 150) OR (n.value < w.value AND w.n > 0 AND n.value < (w.total / w.n)))),
m AS (SELECT user_id, start, pos AS fin, total, n FROM w WHERE done),
k AS (SELECT user_id, 0::BIGINT AS start, 0::BIGINT AS fin, 0::DOUBLE AS total, 0 AS n FROM (SELECT DISTINCT user_id FROM events)
      UNION ALL
      SELECT user_id, c.start, c.fin, c.total, c.n
      FROM (SELECT m.*, row_number() OVER (PARTITION BY m.user_id ORDER BY m.start) AS r FROM k JOIN m ON m.user_id = k.user_id AND m.start > k.fin) c
      WHERE r = 1)
SELECT k.user_id, s.event_id AS start_id, u.event_id AS first_up, p.event_id AS down_id, k.n::BIGINT AS n_up, round(k.total, 6) AS total
FROM k JOIN n s ON s.user_id = k.user_id AND s.pos = k.start JOIN n u ON u.user_id = k.user_id AND u.pos = k.start + 1
JOIN n p ON p.user_id = k.user_id AND p.pos = k.fin WHERE k.start > 0
""")
def str_51_match_so_far(spark, sf):
    # PATTERN (S UP+ DOWN), AFTER MATCH SKIP PAST LAST ROW, conditions on the match so far:
    # UP AS UP.value > coalesce(LAST(UP.value, 1), S.value) AND SUM(UP.value) <= 150, DOWN AS DOWN.value < LAST(UP.value) AND DOWN.value < AVG(UP.value)
    from quern.operators.match import Var, match_recognize

    def up(m):
        before = m.last("UP", "value", 1)
        before = m.first("S", "value") if before is None else before
        return m.row["value"] is not None and before is not None and m.row["value"] > before and m.sum("UP", "value") <= 150

    def down(m):
        return m.row["value"] is not None and m.row["value"] < m.last("UP", "value") and m.row["value"] < m.avg("UP", "value")

    out = match_recognize(
        t(spark, sf, "events"), ["user_id"], ["ts", "event_id"], [Var("S"), Var("UP", 1, None), Var("DOWN")], {"UP": up, "DOWN": down},
        {"start_id": ("first", "S", "event_id"), "first_up": ("first", "UP", "event_id"), "down_id": ("last", "DOWN", "event_id"),
         "n_up": ("count", "UP", "event_id"), "total": ("sum", "UP", "value")},
        "start_id long, first_up long, down_id long, n_up long, total double", columns=["value"])
    return out.withColumn("total", F.round("total", 6))


@register("str_52_match_rowtime", """
WITH n AS (SELECT user_id, event_type, lead(event_type) OVER w AS t1, lead(ts) OVER w AS t1_ts
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, t1_ts AS match_rowtime FROM n WHERE event_type = 'signup' AND t1 = 'purchase'
""")
def str_52_match_rowtime(spark, sf):
    # MATCH_ROWTIME = time of the last row of the match
    from quern.operators.match import match_fixed_length
    ev = t(spark, sf, "events")
    return match_fixed_length(ev, ["user_id"], ["ts", "event_id"], ["S", "P"],
                              {"S": F.col("event_type") == "signup", "P": F.col("event_type") == "purchase"},
                              {"match_rowtime": ("P", "ts")})


# --- state machine, late data, punctuation, operator state, async, iteration ----

# Feed of the state machine from the events table (fixed mapping of this
# query): view -> a, click -> b, signup -> c, purchase -> e, error -> g.
EVENT_LETTERS = {"view": "a", "click": "b", "signup": "c", "purchase": "e", "error": "g"}


@register("str_43_state_machine")
def str_43_state_machine(spark, sf):
    # Keyed by the source address (user_id).  Sequential per key: no SQL
    # form; the tests compare it with a brute-force fold.
    letter = F.create_map(*[x for kv in EVENT_LETTERS.items() for x in map(F.lit, kv)])[F.col("event_type")]
    ev = events_stream(spark, sf).withColumn("evt", letter)
    out = ev.groupBy("user_id").transformWithState(
        P.StateMachine("evt", "ts", "event_id"),
        "address long, state string, transition string, event_id long", "Append", "None")
    return run_to_table(out, "append")




@register("str_22_late_data_side_output", f"""
WITH d AS (SELECT event_id, {_DISORDER} AS ets FROM events),
     w AS (SELECT event_id, ets, epoch_us(ets) // 1000 AS ms,
                  max(epoch_us(ets) // 1000) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) - 3600000 AS wm
           FROM d)
SELECT event_id, wm AS watermark_ms FROM w WHERE (ms // 600000) * 600000 + 600000 - 1 + 300000 <= wm
""")
def str_22_late_data_side_output(spark, sf):
    # Event time lags the arrival order by `value` minutes; 1-hour bounded
    # out-of-orderness, 10-minute tumbling windows with 5 minutes allowed
    # lateness: rows for windows already closed go to the side output.
    from quern.streaming.late import tag_late
    ev = t(spark, sf, "events").select("event_id", F.expr(
        "ts - make_dt_interval(0, 0, 0, CAST(value * 60 AS DECIMAL(18, 6)))").alias("ets"))
    tagged = tag_late(ev, "event_id", "ets", 3_600_000, 600_000, 300_000)
    return tagged.filter("is_late").select("event_id", "watermark_ms")


@register("str_04_punctuated_watermark", """
WITH m AS (SELECT event_id, ts, max(CASE WHEN event_type = 'signup' THEN epoch_us(ts) // 1000 END)
             OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS watermark_ms FROM events)
SELECT date_trunc('day', ts) AS day, count(*) AS cnt, max(watermark_ms) AS watermark_ms FROM m GROUP BY 1
""")
def str_04_punctuated_watermark(spark, sf):
    # signup rows are punctuation: the watermark jumps to their time
    from quern.streaming.late import punctuated_watermark
    ev = t(spark, sf, "events").select("event_id", "ts", "event_type")
    wm = punctuated_watermark(ev, "event_id", "ts", F.col("event_type") == "signup")
    return wm.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("cnt"), F.max("watermark_ms").alias("watermark_ms"))


@register("str_42_operator_state", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def str_42_operator_state(spark, sf):
    # Non-keyed operator state (a counting sink): every micro-batch appends
    # its partial counts with the batch id to a state table on the shared
    # store; a replayed batch id replaces its own rows, so totals stay exact.
    state_path = scratch_path(spark, "op_state")
    ev = events_stream(spark, sf).select("event_type")

    def snapshot(batch, batch_id):
        part = batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
        part.write.mode("overwrite").parquet(os.path.join(state_path, f"batch={batch_id:020d}"))

    ck = scratch_path(spark, "op_state_ck")
    q = ev.writeStream.foreachBatch(snapshot).option("checkpointLocation", ck).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    st = spark.read.schema("event_type string, cnt long").parquet(state_path)
    return st.groupBy("event_type").agg(F.sum("cnt").cast("long").alias("cnt"))


@register("str_45_async_io", "SELECT event_id, length(props)::BIGINT AS enriched FROM events")
def str_45_async_io(spark, sf):
    from quern.streaming.async_io import async_map
    ev = t(spark, sf, "events").select("event_id", "props")
    return async_map(ev, "props", "enriched", "long", ordered=True, capacity=64, timeout_s=5.0).select(
        "event_id", "enriched")


@register("str_45_async_unordered", """
SELECT event_id, 1 AS nth, -1 AS part FROM events WHERE event_type = 'error'
UNION ALL SELECT event_id, 1, event_id % 7 FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, 2, event_id % 11 FROM events WHERE event_type <> 'error' AND event_id % 2 = 0
""")
def str_45_async_unordered(spark, sf):
    # a service that answers odd ids with one element, even ids with two, and never about errors: their time-out is handled
    from quern.streaming.async_io import async_flat_map

    async def service(request):
        import asyncio
        if request["event_type"] == "error":
            await asyncio.sleep(3600)
        await asyncio.sleep(0.001 * (request["event_id"] % 5))
        return [(1, request["event_id"] % 7)] + ([(2, request["event_id"] % 11)] if request["event_id"] % 2 == 0 else [])

    ev = t(spark, sf, "events").select("event_id", F.struct("event_id", "event_type").alias("request"))
    out = async_flat_map(ev, "request", "answer", "struct<nth:int,part:long>", service, ordered=False, capacity=2_000,
                         timeout_s=0.5, on_timeout=lambda request: [(1, -1)])
    return out.select("event_id", "answer.nth", "answer.part")


@register("str_46_iteration", """
SELECT event_id, CASE WHEN value < 1 THEN 0 ELSE floor(log2(value))::BIGINT + 1 END AS rounds FROM events
""")
def str_46_iteration(spark, sf):
    # feedback loop: halve until below 1, counting the rounds
    from quern.operators.iteration import iterate
    ev = t(spark, sf, "events").select("event_id", F.col("value").alias("v"), F.lit(0).cast("long").alias("rounds"))
    out = iterate(ev, lambda d: d.select("event_id", (F.col("v") / 2).alias("v"), (F.col("rounds") + 1).alias("rounds")),
                  F.col("v") >= 1)
    return out.select("event_id", "rounds")
