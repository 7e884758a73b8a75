"""AGG-* and OVR-*: grouping, aggregate functions, OVER windows, top-N."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.operators import aggregates as A
from quern.operators import over as O
from quern.operators.joins import micros
from quern.plans.common import r2, t
from quern.plans.registry import register

R4 = lambda c: F.round(c, 4)


@register("agg_01_group_by", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 4) AS avg_qty, round(avg(l_discount), 4) AS avg_disc, count(*) AS count_order
FROM lineitem GROUP BY l_returnflag, l_linestatus
""", bench=True)
def agg_01_group_by(spark, sf):
    li = t(spark, sf, "lineitem")
    dp = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        r2(F.sum("l_quantity")).alias("sum_qty"), r2(F.sum("l_extendedprice")).alias("sum_base_price"),
        r2(F.sum(dp)).alias("sum_disc_price"), r2(F.sum(dp * (1 + F.col("l_tax")))).alias("sum_charge"),
        R4(F.avg("l_quantity")).alias("avg_qty"), R4(F.avg("l_discount")).alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"))


@register("agg_02_global_aggregate", """
SELECT 'all' AS part, count(*) AS cnt, round(sum(l_quantity), 2) AS qty FROM lineitem
UNION ALL
SELECT 'none', count(*), round(sum(l_quantity), 2) FROM lineitem WHERE l_quantity < 0
""")
def agg_02_global_aggregate(spark, sf):
    li = t(spark, sf, "lineitem")
    a = li.agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("l_quantity")).alias("qty"))
    # a global aggregate over empty input still yields one row
    b = li.filter("l_quantity < 0").agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("l_quantity")).alias("qty"))
    return a.select(F.lit("all").alias("part"), "*").unionByName(b.select(F.lit("none").alias("part"), "*"))


@register("agg_05_distinct_aggregate", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS supps,
       sum(DISTINCT l_linenumber)::BIGINT AS sum_distinct_ln
FROM lineitem GROUP BY l_returnflag
""")
def agg_05_distinct_aggregate(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"),
                                          F.countDistinct("l_suppkey").alias("supps"),
                                          F.sum_distinct("l_linenumber").cast("long").alias("sum_distinct_ln"))


@register("agg_06_distinct_skew_split", """
SELECT event_type, count(DISTINCT user_id) AS n_distinct FROM events GROUP BY event_type
""", bench=True)
def agg_06_distinct_skew_split(spark, sf):
    return A.distinct_count_split(t(spark, sf, "events"), ["event_type"], "user_id")


@register("agg_07_filter_aggregate", """
SELECT l_returnflag, round(sum(l_quantity) FILTER (WHERE l_discount > 0.05::DOUBLE), 2) AS qty_disc,
       count(*) FILTER (WHERE l_tax = 0) AS no_tax
FROM lineitem GROUP BY l_returnflag
""")
def agg_07_filter_aggregate(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(
        r2(F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity")))).alias("qty_disc"),
        F.count(F.when(F.col("l_tax") == 0, F.lit(1))).alias("no_tax"))


@register("agg_08_grouping_sets", """
SELECT 'sets' AS kind, l_returnflag, l_linestatus, count(*) AS cnt FROM lineitem
  GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())
UNION ALL
SELECT 'cube', l_returnflag, l_linestatus, count(*) FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
UNION ALL
SELECT 'rollup', l_returnflag, l_linestatus, count(*) FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""")
def agg_08_grouping_sets(spark, sf):
    li = t(spark, sf, "lineitem")
    sets = li.groupingSets([["l_returnflag"], ["l_linestatus"], []], "l_returnflag", "l_linestatus") \
             .agg(F.count(F.lit(1)).alias("cnt")).select(F.lit("sets").alias("kind"), "*")
    cube = li.cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("cnt")) \
             .select(F.lit("cube").alias("kind"), "*")
    roll = li.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("cnt")) \
             .select(F.lit("rollup").alias("kind"), "*")
    return sets.unionByName(cube).unionByName(roll)


@register("agg_09_grouping_functions", """
SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g_flag,
       grouping_id(l_returnflag, l_linestatus) AS gid, 0 AS group_id, count(*) AS cnt
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
""")
def agg_09_grouping_functions(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.cube("l_returnflag", "l_linestatus").agg(
        F.grouping("l_returnflag").cast("long").alias("g_flag"),
        F.grouping_id("l_returnflag", "l_linestatus").cast("long").alias("gid"),
        F.lit(0).alias("group_id"), F.count(F.lit(1)).alias("cnt"))


@register("agg_09_group_id_repeated_sets", """
WITH a AS (SELECT l_returnflag, l_linestatus, 0 AS gid, count(*) AS cnt, max(l_linestatus) AS last_status FROM lineitem GROUP BY ALL),
b AS (SELECT l_returnflag, NULL AS l_linestatus, 1 AS gid, count(*) AS cnt, max(l_linestatus) AS last_status FROM lineitem GROUP BY l_returnflag),
c AS (SELECT NULL AS l_returnflag, NULL AS l_linestatus, 3 AS gid, count(*) AS cnt, max(l_linestatus) AS last_status FROM lineitem)
SELECT l_returnflag, l_linestatus, gid::BIGINT AS gid, 0::BIGINT AS group_id, cnt, last_status FROM (FROM a UNION ALL FROM b UNION ALL FROM c)
UNION ALL SELECT l_returnflag, l_linestatus, gid::BIGINT, n.range::BIGINT + 1, cnt, last_status FROM b, range(0, 2) n
UNION ALL SELECT l_returnflag, l_linestatus, gid::BIGINT, 1::BIGINT, cnt, last_status FROM c
""")
def agg_09_group_id_repeated_sets(spark, sf):
    # GROUPING SETS ((flag, status), (flag), (flag), (flag), (), ()): GROUP_ID tells the repeats of a set apart
    return A.grouping_sets(t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                           [["l_returnflag", "l_linestatus"], ["l_returnflag"], ["l_returnflag"], ["l_returnflag"], [], []],
                           {"cnt": F.count(F.lit(1)), "last_status": F.max("l_linestatus")})


@register("agg_10_having", """
SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
GROUP BY o_custkey HAVING count(*) > 12
""")
def agg_10_having(spark, sf):
    o = t(spark, sf, "orders")
    return (o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), r2(F.sum("o_totalprice")).alias("total"))
             .filter(F.col("n") > 12))


@register("agg_11_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def agg_11_distinct(spark, sf):
    return t(spark, sf, "events").select("user_id", "event_type").distinct()


@register("agg_12_sum", """
SELECT l_returnflag, sum(l_linenumber)::BIGINT AS sum_ln, round(sum(l_tax), 4) AS sum_tax,
       sum(nullif(l_linenumber, l_linenumber))::BIGINT AS sum_all_null
FROM lineitem GROUP BY l_returnflag
""")
def agg_12_sum(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.sum("l_linenumber").cast("long").alias("sum_ln"), R4(F.sum("l_tax")).alias("sum_tax"),
        F.sum(F.nullif("l_linenumber", "l_linenumber")).cast("long").alias("sum_all_null"))


@register("agg_13_sum0", """
SELECT l_returnflag, coalesce(sum(nullif(l_linenumber, l_linenumber)), 0)::BIGINT AS s0
FROM lineitem GROUP BY l_returnflag
""")
def agg_13_sum0(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(A.sum0(F.nullif("l_linenumber", "l_linenumber")).cast("long").alias("s0"))


@register("agg_14_count", """
SELECT l_returnflag, count(*) AS n_all, count(nullif(l_linestatus, 'O')) AS n_nonnull,
       count(DISTINCT l_linestatus) AS n_status
FROM lineitem GROUP BY l_returnflag
""")
def agg_14_count(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_all"),
                                          F.count(F.nullif("l_linestatus", F.lit("O"))).alias("n_nonnull"),
                                          F.countDistinct("l_linestatus").alias("n_status"))


@register("agg_15_avg", """
SELECT l_returnflag, trunc(sum(l_linenumber) / count(l_linenumber))::INTEGER AS avg_int,
       round(avg(l_quantity), 4) AS avg_dbl
FROM lineitem GROUP BY l_returnflag
""")
def agg_15_avg(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(A.avg_keep_type("l_linenumber", "int").alias("avg_int"),
                                          R4(F.avg("l_quantity")).alias("avg_dbl"))


@register("agg_16_min_max", """
SELECT o_orderpriority, min(o_totalprice) AS mn, max(o_totalprice) AS mx, min(o_orderdate) AS first_date,
       max(o_orderstatus) AS max_status
FROM orders GROUP BY o_orderpriority
""")
def agg_16_min_max(spark, sf):
    o = t(spark, sf, "orders")
    return o.groupBy("o_orderpriority").agg(F.min("o_totalprice").alias("mn"), F.max("o_totalprice").alias("mx"),
                                            F.min("o_orderdate").alias("first_date"),
                                            F.max("o_orderstatus").alias("max_status"))


@register("agg_17_stddev", """
SELECT event_type, round(stddev(value), 4) AS sd, round(stddev_pop(value), 4) AS sd_pop,
       round(stddev_samp(value), 4) AS sd_samp FROM events GROUP BY event_type
""")
def agg_17_stddev(spark, sf):
    ev = t(spark, sf, "events")
    return ev.groupBy("event_type").agg(R4(F.stddev("value")).alias("sd"), R4(F.stddev_pop("value")).alias("sd_pop"),
                                        R4(F.stddev_samp("value")).alias("sd_samp"))


@register("agg_18_variance", """
SELECT event_type, round(variance(value), 2) AS var, round(var_pop(value), 2) AS var_pop,
       round(var_samp(value), 2) AS var_samp FROM events GROUP BY event_type
""")
def agg_18_variance(spark, sf):
    ev = t(spark, sf, "events")
    return ev.groupBy("event_type").agg(r2(F.variance("value")).alias("var"), r2(F.var_pop("value")).alias("var_pop"),
                                        r2(F.var_samp("value")).alias("var_samp"))


@register("agg_19_collect", """
WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, string_agg(o_orderpriority || ':' || n, ',' ORDER BY o_orderpriority) AS multiset
FROM c GROUP BY o_custkey
""")
def agg_19_collect(spark, sf):
    ms = A.collect_multiset(t(spark, sf, "orders"), ["o_custkey"], "o_orderpriority")
    entries = F.transform(F.array_sort(F.map_entries("multiset")),
                          lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return ms.select("o_custkey", F.array_join(entries, ",").alias("multiset"))


@register("agg_20_listagg", """
SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS statuses,
       string_agg(nullif(o_orderstatus, 'F'), ',' ORDER BY o_orderkey) AS non_f
FROM orders GROUP BY o_custkey
""")
def agg_20_listagg(spark, sf):
    o = t(spark, sf, "orders").withColumn("non_f_src", F.nullif("o_orderstatus", F.lit("F")))
    return o.groupBy("o_custkey").agg(A.listagg("o_orderstatus", ",", "o_orderkey").alias("statuses"),
                                      A.listagg("non_f_src", ",", "o_orderkey").alias("non_f"))


@register("agg_21_first_last_value", """
SELECT user_id, first(nullif(event_type, 'view') ORDER BY ts) FILTER (WHERE event_type <> 'view') AS first_non_view,
       last(nullif(event_type, 'view') ORDER BY ts) FILTER (WHERE event_type <> 'view') AS last_non_view
FROM events GROUP BY user_id
""")
def agg_21_first_last_value(spark, sf):
    ev = t(spark, sf, "events").withColumn("nv", F.nullif("event_type", F.lit("view")))
    return ev.groupBy("user_id").agg(A.first_value("nv", "ts").alias("first_non_view"),
                                     A.last_value("nv", "ts").alias("last_non_view"))


@register("agg_22_single_value", """
SELECT o_orderkey, any_value(o_totalprice) AS price FROM orders GROUP BY o_orderkey
""")
def agg_22_single_value(spark, sf):
    from quern.functions.scalar import single_value
    return t(spark, sf, "orders").groupBy("o_orderkey").agg(single_value("o_totalprice").alias("price"))


@register("agg_24_udaf", """
SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS wavg_price
FROM lineitem GROUP BY l_returnflag
""")
def agg_24_udaf(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(R4(A.WEIGHTED_AVG("l_extendedprice", "l_quantity")).alias("wavg_price"))


@register("agg_25_flat_aggregate_top2", """
SELECT * FROM (SELECT o_custkey, o_totalprice,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank_num FROM orders)
WHERE rank_num <= 2
""")
def agg_25_flat_aggregate_top2(spark, sf):
    o = t(spark, sf, "orders")
    return O.top_n(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 2) \
        .select("o_custkey", "o_totalprice", "rank_num")


@register("agg_26_keyed_rolling", """
SELECT event_id, user_id,
  row_number() OVER w AS rn, round(sum(value) OVER w, 2) AS rolling_sum,
  min(value) OVER w AS rolling_min, max(value) OVER w AS rolling_max
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""", bench=True)
def agg_26_keyed_rolling(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = A.keyed_rolling(ev, ["user_id"], ["ts", "event_id"], "value")
    return out.select("event_id", "user_id", "rn", r2("rolling_sum").alias("rolling_sum"),
                      "rolling_min", "rolling_max")


@register("agg_27_keyed_min_max_by", """
WITH r AS (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running_max
           FROM events),
f AS (SELECT user_id, running_max, first(event_id ORDER BY ts, event_id) AS max_by_id FROM r
      WHERE value = running_max GROUP BY ALL)
SELECT r.event_id, r.running_max, f.max_by_id FROM r JOIN f USING (user_id, running_max)
""")
def agg_27_keyed_min_max_by(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = A.keyed_max_by(ev, ["user_id"], ["ts", "event_id"], "value", "event_id")
    return out.select("event_id", "running_max", "max_by_id")


@register("agg_28_keyed_reduce", """
SELECT event_id, count(*) OVER w AS n, round(sum(value) OVER w, 2) AS running_sum
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def agg_28_keyed_reduce(spark, sf):
    # reduce((a, b) -> (a.n + b.n, a.s + b.s)) emits the running pair.
    from quern.operators.prefix import prefix_scan
    ev = t(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    sc = prefix_scan(ev, ["event_type"], ["ts", "event_id"], row_number="n", sums={"s": "value"})
    return sc.select("event_id", "n", r2("s").alias("running_sum"))


@register("agg_29_keyed_fold", """
SELECT event_id, round(1000 + sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS folded
FROM events
""")
def agg_29_keyed_fold(spark, sf):
    # fold(1000, (acc, e) -> acc + e.value): initial value plus running sum.
    from quern.operators.prefix import prefix_scan
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    sc = prefix_scan(ev, ["user_id"], ["ts", "event_id"], row_number=None, sums={"s": "value"})
    return sc.select("event_id", r2(F.lit(1000.0) + F.col("s")).alias("folded"))


@register("agg_30_multi_arg_udaf", """
SELECT l_returnflag, date_trunc('month', l_shipdate) AS m, sum(l_linenumber + 0)::BIGINT AS multi_sum
FROM lineitem GROUP BY ALL
""")
def agg_30_multi_arg_udaf(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("m")) \
             .agg(A.MULTI_SUM(F.col("l_linenumber"), F.lit(0)).alias("multi_sum"))


# --- OVER windows ----------------------------------------------------------------

@register("ovr_01_over_window", """
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS s3
FROM events
""")
def ovr_01_over_window(spark, sf):
    # Over.partitionBy(user_id).orderBy(ts).preceding(2 rows): bounded frame,
    # evaluated slice by slice (a hot user is spread over many tasks)
    from quern.operators.frames import rows_frame
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = rows_frame(ev, ["user_id"], ["ts", "event_id"], {"s3": ("sum", "value", -2, 0)})
    return out.select("event_id", r2("s3").alias("s3"))


@register("ovr_02_rows_frame", """
SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c5,
       round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS run
FROM events
""", bench=True)
def ovr_02_rows_frame(spark, sf):
    # bounded frame by slice halos; the unbounded-preceding frame by prefix scan
    from quern.operators.frames import rows_frame
    from quern.operators.prefix import prefix_scan
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    one = ev.withColumn("_one", F.lit(1.0))
    c5 = rows_frame(one, ["user_id"], ["ts", "event_id"], {"c5": ("count", "_one", -4, 0)}).select("event_id", "c5")
    run = prefix_scan(ev, ["user_id"], ["ts", "event_id"], row_number=None, sums={"run": "value"})
    return c5.join(run.select("event_id", r2("run").alias("run")), "event_id")


@register("ovr_03_range_frame", """
SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS c_day,
       round(sum(value) OVER (PARTITION BY event_type ORDER BY round(value * 100)::BIGINT RANGE BETWEEN 100 PRECEDING AND CURRENT ROW), 2) AS s_near
FROM events
""", bench=True)
def ovr_03_range_frame(spark, sf):
    # RANGE frames in blocks of the order value (hot-key safe), summed inside
    # the frame; money values are ordered by exact cents
    from quern.operators.frames import range_frame
    day = 86_400_000_000
    ev = t(spark, sf, "events").select("event_id", "user_id", "event_type", "value", micros("ts").alias("_us"),
                                       F.round(F.col("value") * 100).cast("long").alias("_cents"))
    a = range_frame(ev, ["user_id"], "_us", -day, 0, "value", "event_id", count="c_day", total="_s1")
    b = range_frame(ev.select("event_id", "event_type", "value", "_cents"), ["event_type"], "_cents", -100, 0,
                    "value", "event_id", count="_c2", total="s_near")
    return a.select("event_id", "c_day").join(b.select("event_id", r2("s_near").alias("s_near")), "event_id")


@register("ovr_04_following_frame", """
SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                         ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING), 4) AS centered
FROM events
""")
def ovr_04_following_frame(spark, sf):
    from quern.operators.frames import rows_frame
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = rows_frame(ev, ["user_id"], ["ts", "event_id"], {"centered": ("avg", "value", -1, 2)})
    return out.select("event_id", R4(F.col("centered")).alias("centered"))


@register("ovr_06_multiple_windows", """
SELECT event_id, count(*) OVER (PARTITION BY user_id) AS per_user,
       count(*) OVER (PARTITION BY event_type) AS per_type,
       rank() OVER (PARTITION BY user_id ORDER BY value DESC) AS value_rank
FROM events
""")
def ovr_06_multiple_windows(spark, sf):
    # whole-partition counts are aggregates joined back (partial aggregation,
    # AQE skew join); the rank uses the prefix-scan ranking
    ev = t(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    pu = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("per_user"))
    pt = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("per_type"))
    rk = O.rank_keyed(ev, ["user_id"], [("value", False)], "event_id", row_number=None, dense_rank=None)
    pu, pt = pu.withColumnRenamed("user_id", "_u"), pt.withColumnRenamed("event_type", "_t")  # null keys are keys
    return (rk.join(pu, F.col("user_id").eqNullSafe(F.col("_u")), "left").join(pt, F.col("event_type").eqNullSafe(F.col("_t")), "left")
              .select("event_id", "per_user", "per_type", F.col("rk").alias("value_rank")))


@register("ovr_07_aggregates_over", """
SELECT event_id, min(value) OVER w AS mn, max(value) OVER w AS mx, round(avg(value) OVER w, 4) AS av, count(value) OVER w AS n
FROM events WINDOW w AS (PARTITION BY event_type, user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
""")
def ovr_07_aggregates_over(spark, sf):
    from quern.operators.frames import rows_frame
    ev = t(spark, sf, "events").select("event_id", "event_type", "user_id", "ts", "value")
    out = rows_frame(ev, ["event_type", "user_id"], ["ts", "event_id"], {
        "mn": ("min", "value", -3, 0), "mx": ("max", "value", -3, 0), "av": ("avg", "value", -3, 0),
        "n": ("count", "value", -3, 0)})
    return out.select("event_id", "mn", "mx", R4(F.col("av")).alias("av"), "n")


@register("ovr_08_distinct_over", """
SELECT e.event_id, (SELECT count(DISTINCT e2.event_type) FROM (
    SELECT event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, user_id FROM events) e2
  WHERE e2.user_id = e.user_id AND e2.rn BETWEEN e.rn - 5 AND e.rn) AS types_last6
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) e
""")
def ovr_08_distinct_over(spark, sf):
    # COUNT(DISTINCT event_type) over the last 6 rows (hot-key safe)
    from quern.operators.frames import rows_frame
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    out = rows_frame(ev, ["user_id"], ["ts", "event_id"], {"types_last6": ("count_distinct", "event_type", -5, 0)})
    return out.select("event_id", "types_last6")


@register("ovr_09_11_ranking", """
SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS drk
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)
""")
def ovr_09_11_ranking(spark, sf):
    # hot-key safe: prefix-scan row numbers, first-peer ranks, dense prefix count
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    r = O.rank_keyed(o, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "o_orderkey")
    return r.select("o_orderkey", "rn", "rk", "drk")


@register("ovr_10_rank_ties", """
SELECT o_orderkey, rank() OVER w AS rk, dense_rank() OVER w AS drk
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate)
""")
def ovr_10_rank_ties(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    r = O.rank_keyed(o, ["o_orderpriority"], ["o_orderdate"], "o_orderkey", row_number=None)
    return r.select("o_orderkey", "rk", "drk")


@register("ovr_12_lead_lag", """
SELECT event_id, lag(value) OVER w AS prev_value, lead(event_id, 2, -1) OVER w AS next2
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""", bench=True)
def ovr_12_lead_lag(spark, sf):
    # LAG / LEAD inside blocks of row numbers with copied neighbours
    from quern.operators.frames import rows_frame
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = rows_frame(ev, ["user_id"], ["ts", "event_id"], {
        "prev_value": ("shift", "value", -1), "next2": ("shift", "event_id", 2, -1)})
    return out.select("event_id", "prev_value", F.col("next2").cast("long").alias("next2"))


@register("ovr_13_first_last_value_over", """
SELECT event_id,
  first(nullif(event_type, 'view') IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_nv,
  last(nullif(event_type, 'view') IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_nv
FROM events
""")
def ovr_13_first_last_value_over(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "user_id", "ts",
                                       F.nullif(F.col("event_type"), F.lit("view")).alias("nv"))
    out = O.first_last_non_null(ev, ["user_id"], ["ts", "event_id"], "nv", first="first_nv", last="last_nv")
    return out.select("event_id", "first_nv", "last_nv")


@register("ovr_14_top_n", """
SELECT * FROM (SELECT event_type, event_id, value,
  row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank_num FROM events) WHERE rank_num <= 3
""", bench=True)
def ovr_14_top_n(spark, sf):
    ev = t(spark, sf, "events")
    return O.top_n(ev, ["event_type"], [F.col("value").desc(), F.col("event_id")], 3) \
        .select("event_type", "event_id", "value", "rank_num")


@register("ovr_16_dedup_keep_first", """
SELECT user_id, event_type, event_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1
""")
def ovr_16_dedup_keep_first(spark, sf):
    ev = t(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return O.dedup_keep_first(ev, ["user_id", "event_type"], ["ts", "event_id"])


@register("ovr_17_dedup_keep_last", """
SELECT user_id, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def ovr_17_dedup_keep_last(spark, sf):
    ev = t(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return O.dedup_keep_last(ev, ["user_id"], ["ts", "event_id"])
