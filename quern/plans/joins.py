"""JOI-*: joins over the TPC-H-like tables and the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import joins as J
from quern.plans.common import r2, t
from quern.plans.registry import register

HOUR_US = 3_600_000_000


@register("joi_01_inner_join", """
SELECT l_orderkey, l_linenumber, o_orderpriority, o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_quantity * 1000 > o_totalprice / 10
""", bench=True)
def joi_01_inner_join(spark, sf):
    li, o = t(spark, sf, "lineitem"), t(spark, sf, "orders")
    j = li.join(o, (li.l_orderkey == o.o_orderkey)
                & (li.l_quantity * 1000 > o.o_totalprice / 10), "inner")
    return j.select("l_orderkey", "l_linenumber", "o_orderpriority", "o_orderstatus")


@register("joi_02_outer_joins", """
SELECT 'left' AS kind, c_custkey AS k, count(o_orderkey) AS n
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY c_custkey
UNION ALL
SELECT 'right', s_suppkey, count(c_custkey) FROM customer RIGHT JOIN supplier ON c_custkey = s_suppkey * 20 GROUP BY s_suppkey
UNION ALL
SELECT 'full', coalesce(c_custkey, s_suppkey * 20), count(*) FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 20
GROUP BY coalesce(c_custkey, s_suppkey * 20)
""")
def joi_02_outer_joins(spark, sf):
    c, o, s = t(spark, sf, "customer"), t(spark, sf, "orders"), t(spark, sf, "supplier")
    left = (c.join(o, (c.c_custkey == o.o_custkey) & (o.o_orderstatus == "F"), "left")
             .groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))
             .select(F.lit("left").alias("kind"), F.col("c_custkey").alias("k"), "n"))
    right = (c.join(s, c.c_custkey == s.s_suppkey * 20, "right")
              .groupBy("s_suppkey").agg(F.count("c_custkey").alias("n"))
              .select(F.lit("right").alias("kind"), F.col("s_suppkey").alias("k"), "n"))
    full = (c.join(s, c.c_custkey == s.s_suppkey * 20, "full")
             .groupBy(F.coalesce("c_custkey", s.s_suppkey * 20).alias("k"))
             .agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit("full").alias("kind"), "k", "n"))
    return left.unionByName(right).unionByName(full)


@register("joi_03_cross_join", """
SELECT r_name, count(*) AS cnt, round(sum(o_totalprice), 2) AS total FROM orders CROSS JOIN region GROUP BY r_name
""")
def joi_03_cross_join(spark, sf):
    # Cross product only against a table of fixed size (5 regions): the
    # broadcast side is bounded, the work stays linear in orders.
    o, r = t(spark, sf, "orders"), t(spark, sf, "region")
    return (o.crossJoin(F.broadcast(r)).groupBy("r_name")
             .agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("o_totalprice")).alias("total")))


@register("joi_04_semi_join", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def joi_04_semi_join(spark, sf):
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    urgent = o.filter(o.o_orderpriority == "1-URGENT")
    return c.join(urgent, c.c_custkey == urgent.o_custkey, "left_semi").select("c_custkey", "c_name")


@register("joi_05_anti_join", """
SELECT 'not_exists' AS kind, c_custkey FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
UNION ALL
SELECT 'not_in', p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)
""")
def joi_05_anti_join(spark, sf):
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    ne = (c.join(o.filter(o.o_orderstatus == "P"), c.c_custkey == o.o_custkey, "left_anti")
           .select(F.lit("not_exists").alias("kind"), F.col("c_custkey")))
    ni = J.not_in(t(spark, sf, "part"), "p_partkey", t(spark, sf, "lineitem").filter("l_quantity > 45"), "l_partkey")
    return ne.unionByName(ni.select(F.lit("not_in").alias("kind"), F.col("p_partkey").alias("c_custkey")))


@register("joi_06_scalar_subquery", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE l_quantity > (SELECT 1.5 * avg(l2.l_quantity) FROM lineitem l2 WHERE l2.l_partkey = l.l_partkey)
  AND l_extendedprice > (SELECT avg(l_extendedprice) FROM lineitem)
""")
def joi_06_scalar_subquery(spark, sf):
    return spark.sql("""
        SELECT l_orderkey, l_linenumber, l_partkey FROM {li} l
        WHERE l_quantity > (SELECT 1.5 * avg(l2.l_quantity) FROM {li} l2 WHERE l2.l_partkey = l.l_partkey)
          AND l_extendedprice > (SELECT avg(l_extendedprice) FROM {li})""", li=t(spark, sf, "lineitem"))


@register("joi_07_hash_join", """
SELECT p_brand, count(*) AS cnt, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
""")
def joi_07_hash_join(spark, sf):
    li, p = t(spark, sf, "lineitem"), t(spark, sf, "part")
    j = li.join(p.hint("shuffle_hash"), li.l_partkey == p.p_partkey)
    return j.groupBy("p_brand").agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("l_extendedprice")).alias("revenue"))


@register("joi_08_broadcast_join", """
SELECT n_name, count(*) AS cnt, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name
""", bench=True)
def joi_08_broadcast_join(spark, sf):
    # nation has a fixed 25 rows: broadcasting it is bounded at any scale;
    # supplier grows with the data, so its strategy is left to AQE.
    li, s, n = t(spark, sf, "lineitem"), t(spark, sf, "supplier"), t(spark, sf, "nation")
    sn = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    j = li.join(sn, li.l_suppkey == sn.s_suppkey)
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("cnt"),
                                   r2(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("revenue"))


@register("joi_09_sort_merge_join", """
SELECT o_orderstatus, count(*) AS cnt, round(sum(l_quantity), 2) AS qty
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus
""")
def joi_09_sort_merge_join(spark, sf):
    li, o = t(spark, sf, "lineitem"), t(spark, sf, "orders")
    j = li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey)
    return j.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("l_quantity")).alias("qty"))


@register("joi_10_theta_join", """
SELECT r_name, count(*) AS cnt FROM orders JOIN region
  ON o_totalprice >= r_regionkey * 100000 AND o_totalprice < (r_regionkey + 1) * 100000 GROUP BY r_name
""")
def joi_10_theta_join(spark, sf):
    o, r = t(spark, sf, "orders"), t(spark, sf, "region")
    j = o.join(F.broadcast(r), (o.o_totalprice >= r.r_regionkey * 100000)
               & (o.o_totalprice < (r.r_regionkey + 1) * 100000))
    return j.groupBy("r_name").agg(F.count(F.lit(1)).alias("cnt"))


_P = "(SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase')"
_V = "(SELECT user_id, ts AS v_ts, event_id AS v_id FROM events WHERE event_type = 'view')"


def _purchases(spark, sf):
    return (t(spark, sf, "events").filter("event_type = 'purchase'")
            .select("user_id", "ts", "event_id", "value"))


def _views(spark, sf):
    return (t(spark, sf, "events").filter("event_type = 'view'")
            .select("user_id", F.col("ts").alias("v_ts"), F.col("event_id").alias("v_id")))


@register("joi_12_time_windowed_join", f"""
SELECT 'inner' AS kind, p.event_id, v.v_id FROM {_P} p JOIN {_V} v
  ON p.user_id = v.user_id AND v.v_ts BETWEEN p.ts - INTERVAL 2 HOUR AND p.ts + INTERVAL 1 HOUR
UNION ALL
SELECT 'left', p.event_id, v.v_id FROM {_P} p LEFT JOIN {_V} v
  ON p.user_id = v.user_id AND v.v_ts BETWEEN p.ts - INTERVAL 2 HOUR AND p.ts + INTERVAL 1 HOUR
UNION ALL
SELECT 'full', p.event_id, v.v_id FROM {_P} p FULL JOIN {_V} v
  ON p.user_id = v.user_id AND v.v_ts BETWEEN p.ts - INTERVAL 2 HOUR AND p.ts + INTERVAL 1 HOUR
""", bench=True)
def joi_12_time_windowed_join(spark, sf):
    p, v = _purchases(spark, sf), _views(spark, sf)
    out = None
    for how in ("inner", "left", "full"):
        j = J.interval_join(p, v, ["user_id"], "ts", "v_ts", -2 * HOUR_US, HOUR_US, how=how)
        j = j.select(F.lit(how).alias("kind"), "event_id", "v_id")
        out = j if out is None else out.unionByName(j)
    return out


@register("joi_13_interval_join", f"""
SELECT p.event_id, v.v_id, greatest(p.ts, v.v_ts) AS ts FROM {_P} p JOIN {_V} v
  ON p.user_id = v.user_id AND v.v_ts >= p.ts - INTERVAL 1 HOUR AND v.v_ts < p.ts
""")
def joi_13_interval_join(spark, sf):
    # intervalJoin(views).between(-1 hour, 0).upperBoundExclusive(); result
    # time is the larger of both row times.
    p, v = _purchases(spark, sf), _views(spark, sf)
    j = J.interval_join(p, v, ["user_id"], "ts", "v_ts", -HOUR_US, 0, upper_inclusive=False)
    return j.select("event_id", "v_id", F.greatest("ts", "v_ts").alias("ts"))


@register("joi_14_window_join", f"""
SELECT p.event_id, v.v_id, date_trunc('hour', p.ts) AS window_start FROM {_P} p JOIN {_V} v
  ON p.user_id = v.user_id AND date_trunc('hour', p.ts) = date_trunc('hour', v.v_ts)
""")
def joi_14_window_join(spark, sf):
    j = J.window_join(_purchases(spark, sf), _views(spark, sf), ["user_id"], "ts", "v_ts", "1 hour")
    return j.select("event_id", "v_id", "window_start")


@register("joi_15_window_cogroup", """
WITH p AS (SELECT user_id, date_trunc('day', ts) AS window_start, count(*) AS purchases, round(sum(value), 2) AS spent
           FROM events WHERE event_type = 'purchase' GROUP BY ALL),
     v AS (SELECT user_id, date_trunc('day', ts) AS window_start, count(*) AS views
           FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT coalesce(p.user_id, v.user_id) AS user_id, coalesce(p.window_start, v.window_start) AS window_start,
       coalesce(purchases, 0) AS purchases, spent, coalesce(views, 0) AS views
FROM p FULL JOIN v ON p.user_id = v.user_id AND p.window_start = v.window_start
""")
def joi_15_window_cogroup(spark, sf):
    ev = t(spark, sf, "events")
    g = J.window_cogroup(ev.filter("event_type = 'purchase'"), ev.filter("event_type = 'view'"),
                         ["user_id"], "ts", "ts", "1 day",
                         [F.count(F.lit(1)).alias("purchases"), r2(F.sum("value")).alias("spent")],
                         [F.count(F.lit(1)).alias("views")])
    return g.select("user_id", "window_start", F.coalesce("purchases", F.lit(0)).alias("purchases"),
                    "spent", F.coalesce("views", F.lit(0)).alias("views"))


@register("joi_16_temporal_join", """
SELECT p.event_id, p.value AS amount, s.event_id AS version_id, s.value AS rate
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF JOIN (SELECT * FROM events WHERE event_type = 'signup') s
  ON p.user_id = s.user_id AND p.ts >= s.ts
""", bench=True)
def joi_16_temporal_join(spark, sf):
    # LATERAL TABLE(rates(p.rowtime)): the 'signup' rows of a user are the
    # versions, valid from their time until the next one.
    ev = t(spark, sf, "events")
    p = ev.filter("event_type = 'purchase'").select("user_id", "ts", "event_id", F.col("value").alias("amount"))
    s = ev.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("version_ts"),
                                                 F.col("event_id").alias("version_id"), F.col("value").alias("rate"))
    j = J.asof_join(p, s, ["user_id"], "ts", "version_ts")
    return j.select("event_id", "amount", "version_id", "rate")


@register("joi_17_lookup_join", """
SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'
""")
def joi_17_lookup_join(spark, sf):
    c, n, r = t(spark, sf, "customer"), t(spark, sf, "nation"), t(spark, sf, "region")
    j = J.lookup_join(c, n, c.c_nationkey == n.n_nationkey, broadcast=True)  # 25 nations
    j = J.lookup_join(j, r.filter("r_name <> 'ASIA'"), j.n_regionkey == r.r_regionkey, how="left")
    return j.select("c_custkey", "n_name", "r_name")


@register("joi_18_join_lateral", """
SELECT page_id, pos - 1 AS pos, seg FROM pages, unnest(string_split(url, '/')) WITH ORDINALITY AS u(seg, pos)
WHERE seg <> ''
""")
def joi_18_join_lateral(spark, sf):
    return spark.sql("""SELECT page_id, CAST(pos AS BIGINT) AS pos, seg FROM {p}
                        LATERAL VIEW posexplode(split(url, '/')) s AS pos, seg WHERE seg <> ''""",
                     p=t(spark, sf, "pages"))


@register("joi_19_left_outer_lateral", """
SELECT page_id, seg FROM pages LEFT JOIN LATERAL
  (SELECT unnest(list_filter(string_split(url, '/'), lambda x: regexp_full_match(x, '[0-9]+'))) AS seg) s ON true
""")
def joi_19_left_outer_lateral(spark, sf):
    return spark.sql("""SELECT page_id, seg FROM {p}
                        LATERAL VIEW OUTER explode(filter(split(url, '/'), x -> x rlike '^[0-9]+$')) s AS seg""",
                     p=t(spark, sf, "pages"))


@register("joi_20_unnest", """
SELECT vec_id, pos - 1 AS pos, round(x::DOUBLE, 6) AS x
FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, pos)
""")
def joi_20_unnest(spark, sf):
    e = t(spark, sf, "embeddings")
    return e.select("vec_id", F.posexplode("embedding")).select(
        "vec_id", F.col("pos").cast("long").alias("pos"), F.round(F.col("col").cast("double"), 6).alias("x"))


@register("joi_21_connected_streams", """
SELECT 'purchase' AS tag, user_id, event_id, value * 2 AS amount FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT 'view', user_id, event_id, 0.0 FROM events WHERE event_type = 'view'
""")
def joi_21_connected_streams(spark, sf):
    # connect(purchases, views).map(f1, f2): one tagged union, one expression
    # per tag.
    ev = t(spark, sf, "events")
    a = ev.filter("event_type = 'purchase'").select(F.lit("purchase").alias("tag"), "user_id", "event_id", "value")
    b = ev.filter("event_type = 'view'").select(F.lit("view").alias("tag"), "user_id", "event_id", "value")
    u = a.unionByName(b)
    return u.select("tag", "user_id", "event_id",
                    F.when(F.col("tag") == "purchase", F.col("value") * 2)
                     .otherwise(F.lit(0.0)).alias("amount"))


_RULES = [("purchase", 100.0), ("view", 300.0), ("click", 200.0), ("signup", 400.0), ("error", 50.0)]


@register("joi_22_broadcast_state_join", """
WITH rules(event_type, min_value) AS (VALUES ('purchase', 100.0), ('view', 300.0), ('click', 200.0),
                                             ('signup', 400.0), ('error', 50.0))
SELECT e.event_id, e.event_type FROM events e JOIN rules r ON e.event_type = r.event_type AND e.value > r.min_value
""")
def joi_22_broadcast_state_join(spark, sf):
    rules = spark.createDataFrame(_RULES, "event_type string, min_value double")
    ev = t(spark, sf, "events")
    j = ev.join(F.broadcast(rules), (ev.event_type == rules.event_type) & (ev.value > rules.min_value))
    return j.select("event_id", ev.event_type)


@register("joi_23_null_safe_join", """
WITH a AS (SELECT nullif(event_type, 'view') AS k, count(*) AS n FROM events GROUP BY 1),
     b AS (SELECT nullif(event_type, 'view') AS k, round(sum(value), 2) AS s FROM events GROUP BY 1)
SELECT a.k, n, s FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k
""")
def joi_23_null_safe_join(spark, sf):
    ev = t(spark, sf, "events").withColumn("k", F.nullif(F.col("event_type"), F.lit("view")))
    a = ev.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    b = ev.groupBy(F.col("k").alias("k2")).agg(r2(F.sum("value")).alias("s"))
    return J.null_safe_join(a, b, [("k", "k2")]).select("k", "n", "s")
