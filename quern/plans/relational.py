"""PRJ-*, SET-*, PAR-*: projections, set operations, catalog, partitioning."""

from __future__ import annotations

import functools
import re
import uuid

import pandas as pd
from pyspark.sql import functions as F

from quern.operators import columns as C
from quern.plans.common import r2, t
from quern.plans.registry import register
from quern.session import scratch_path


# --- projection -------------------------------------------------------------

@register("prj_01_select", """
SELECT *, l_extendedprice * (1 - l_discount) AS disc_price FROM lineitem
""")
def prj_01_select(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select("*", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("disc_price"))


@register("prj_02_as", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
FROM customer
""")
def prj_02_as(spark, sf):
    return t(spark, sf, "customer").toDF("id", "name", "nation", "balance", "segment")


@register("prj_03_filter", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000
""")
def prj_03_filter(spark, sf):
    o = t(spark, sf, "orders")
    return o.filter((o.o_orderstatus == "O") & (o.o_totalprice > 200000)).select("o_orderkey", "o_totalprice")


@register("prj_05_add_columns", """
SELECT *, o_totalprice * 2 AS double_price, year(o_orderdate) AS yr FROM orders
""")
def prj_05_add_columns(spark, sf):
    o = t(spark, sf, "orders")
    return C.add_columns(o, double_price=F.col("o_totalprice") * 2, yr=F.year("o_orderdate").cast("long"))


@register("prj_06_add_or_replace_columns", """
SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       o_custkey % 10 AS bucket
FROM orders
""")
def prj_06_add_or_replace_columns(spark, sf):
    o = t(spark, sf, "orders")
    return C.add_or_replace_columns(o, o_orderstatus=F.lower("o_orderstatus"), bucket=F.col("o_custkey") % 10)


@register("prj_07_rename_columns", "SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey FROM nation")
def prj_07_rename_columns(spark, sf):
    return C.rename_columns(t(spark, sf, "nation"), n_nationkey="nation_id", n_name="nation")


@register("prj_08_drop_columns", "SELECT event_id, ts, user_id, event_type FROM events")
def prj_08_drop_columns(spark, sf):
    return t(spark, sf, "events").drop("value", "props")


@register("prj_09_column_ranges", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
""")
def prj_09_column_ranges(spark, sf):
    li = t(spark, sf, "lineitem")
    a = C.with_columns(li, 1, 4)                         # withColumns(1 to 4)
    return C.without_columns(a, *li.columns[4:])         # withoutColumns(5 to 11): no-op here


@register("prj_10_map", """
SELECT c_custkey, upper(c_name) AS name, c_acctbal * 2 AS credit FROM customer
""")
def prj_10_map(spark, sf):
    # Table.map(f): one row in, one composite row out, then flattened.
    c = t(spark, sf, "customer")
    s = F.struct(F.upper("c_name").alias("name"), (F.col("c_acctbal") * 2).alias("credit"))
    return c.select("c_custkey", s.alias("m")).select("c_custkey", "m.*")


@register("prj_11_flat_map", """
SELECT p_partkey, w AS word FROM part, unnest(string_split(p_name, ' ')) AS u(w)
""")
def prj_11_flat_map(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@register("prj_12_map_stream", """
SELECT event_id, upper(event_type) AS kind, value * 100 AS cents FROM events
""")
def prj_12_map_stream(spark, sf):
    ev = t(spark, sf, "events")
    return ev.select("event_id", F.upper("event_type").alias("kind"), (F.col("value") * 100).alias("cents"))


@register("prj_13_flat_map_stream", """
SELECT doc_id, count(*) AS n_tokens
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS tok FROM documents) WHERE tok <> '' GROUP BY doc_id
""")
def prj_13_flat_map_stream(spark, sf):
    d = t(spark, sf, "documents")
    tok = d.select("doc_id", F.explode(F.split("text", " ")).alias("tok")).filter(F.col("tok") != "")
    return tok.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))


@register("prj_14_filter_stream", "SELECT * FROM events WHERE event_type = 'error' AND value > 100")
def prj_14_filter_stream(spark, sf):
    return t(spark, sf, "events").filter("event_type = 'error' AND value > 100")


@register("prj_15_project_stream", "SELECT event_type, event_id, value FROM events")
def prj_15_project_stream(spark, sf):
    return C.project(t(spark, sf, "events"), 3, 0, 4)


@register("prj_16_process_side_outputs", """
SELECT CASE WHEN value > 400 THEN 'big' WHEN event_type = 'error' THEN 'errors' ELSE 'main' END AS out,
       count(*) AS cnt FROM events GROUP BY 1
""")
def prj_16_process_side_outputs(spark, sf):
    tagged = C.tag(t(spark, sf, "events"),
                   [("big", F.col("value") > 400), ("errors", F.col("event_type") == "error")],
                   tag_col="out", default="main")
    return tagged.groupBy("out").agg(F.count(F.lit(1)).alias("cnt"))


@register("prj_17_side_output", """
SELECT event_id, value FROM events WHERE value > 400
""")
def prj_17_side_output(spark, sf):
    tagged = C.tag(t(spark, sf, "events"), [("big", F.col("value") > 400)], default="main")
    return C.output(tagged, "big").select("event_id", "value")


@register("prj_18_split_select", """
SELECT event_id FROM events WHERE value > 400 OR event_type = 'error'
""")
def prj_18_split_select(spark, sf):
    s = C.split(t(spark, sf, "events"), [("big", F.col("value") > 400),
                                        ("errors", F.col("event_type") == "error")])
    return C.select_outputs(s, "big", "errors").select("event_id")


@register("prj_19_flatten_get", """
SELECT l_orderkey, l_linenumber, l_quantity AS "info$qty", l_tax AS "info$tax" FROM lineitem
""")
def prj_19_flatten_get(spark, sf):
    li = t(spark, sf, "lineitem")
    nested = li.select("l_orderkey", "l_linenumber",
                       F.struct(F.col("l_quantity").alias("qty"), F.col("l_tax").alias("tax")).alias("info"))
    return C.flatten(nested, "info")


@register("prj_20_word_count", r"""
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM documents) WHERE word <> ''
GROUP BY word
""", bench=True)
def prj_20_word_count(spark, sf):
    d = t(spark, sf, "documents")
    words = d.select(F.explode(F.split(F.lower("text"), r"\W+")).alias("word")).filter(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


# --- sort, limit, set operations ------------------------------------------------

@register("set_01_order_by", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderpriority DESC NULLS FIRST, o_totalprice, o_orderkey) AS pos
FROM orders
""")
def set_01_order_by(spark, sf):
    # The global position is made explicit (an unordered comparison sees it)
    # with the distributed prefix scan: range partitioning, never one task.
    from quern.operators.prefix import prefix_scan
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    ranked = prefix_scan(o, [], [F.col("o_orderpriority").desc_nulls_first(), F.col("o_totalprice"),
                                 F.col("o_orderkey")], row_number="pos")
    return ranked.select("o_orderkey", "o_totalprice", "pos")


@register("set_04_limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def set_04_limit(spark, sf):
    return t(spark, sf, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10) \
        .select("o_orderkey", "o_totalprice")


@register("set_05_offset", """
SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 100
""")
def set_05_offset(spark, sf):
    # OFFSET without LIMIT would gather the whole sorted table into one task
    # (a global offset operator); instead the global position comes from the
    # distributed prefix scan and the first n positions are filtered out.
    from quern.operators.prefix import prefix_scan
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    pos = prefix_scan(o, [], [F.col("o_totalprice").desc(), F.col("o_orderkey")], row_number="_pos")
    return pos.filter(F.col("_pos") > 100).select("o_orderkey")


@register("set_06_sort_limit", """
SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 20 OFFSET 5
""")
def set_06_sort_limit(spark, sf):
    return (t(spark, sf, "events").orderBy(F.col("value").desc(), "event_id").offset(5).limit(20)
            .select("event_id", "value"))


@register("set_07_union", """
SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier
""")
def set_07_union(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_nationkey").alias("k"))
    s = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    return c.union(s).distinct()


@register("set_08_union_all", """
SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier
""")
def set_08_union_all(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_nationkey").alias("k"))
    s = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    return c.unionAll(s)


@register("set_09_stream_union", """
SELECT event_type, count(*) AS cnt FROM (
  SELECT event_type FROM events WHERE event_type = 'view'
  UNION ALL SELECT event_type FROM events WHERE event_type = 'click'
  UNION ALL SELECT event_type FROM events WHERE event_type = 'view') GROUP BY event_type
""")
def set_09_stream_union(spark, sf):
    ev = t(spark, sf, "events").select("event_type")
    parts = [ev.filter("event_type = 'view'"), ev.filter("event_type = 'click'"), ev.filter("event_type = 'view'")]
    u = functools.reduce(lambda a, b: a.union(b), parts)  # a stream unioned with itself keeps duplicates
    return u.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


@register("set_10_except", """
SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def set_10_except(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    c = t(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"))
    return o.subtract(c)


@register("set_11_except_all", """
SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
""")
def set_11_except_all(spark, sf):
    o = t(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("k")).exceptAll(
        o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")))


@register("set_12_intersect", """
SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
""")
def set_12_intersect(spark, sf):
    o = t(spark, sf, "orders")
    return o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).intersect(
        o.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")))


@register("set_13_intersect_all", """
SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
""")
def set_13_intersect_all(spark, sf):
    o = t(spark, sf, "orders")
    return o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).intersectAll(
        o.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")))


@register("set_14_replicate_rows", """
SELECT o_orderkey, k FROM orders, range(1, (o_custkey % 3) + 2) r(k)
""")
def set_14_replicate_rows(spark, sf):
    o = t(spark, sf, "orders")
    n = (F.col("o_custkey") % 3 + 1).cast("int")
    return o.select("o_orderkey", F.explode(F.sequence(F.lit(1).cast("long"), n.cast("long"))).alias("k"))


@register("set_16_sql_query", """
SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name HAVING count(*) > 10
""")
def set_16_sql_query(spark, sf):
    return spark.sql("""SELECT n_name, count(*) AS customers FROM {c} JOIN {n} ON c_nationkey = n_nationkey
                        GROUP BY n_name HAVING count(*) > 10""", c=t(spark, sf, "customer"), n=t(spark, sf, "nation"))


@register("set_17_sql_ddl", """
SELECT c_mktsegment, count(*) AS cnt FROM customer GROUP BY c_mktsegment
""")
def set_17_sql_ddl(spark, sf):
    t(spark, sf, "customer").createOrReplaceTempView("q_customer_src")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW q_segments AS "
              "SELECT c_mktsegment, count(*) AS cnt FROM q_customer_src GROUP BY c_mktsegment")
    out = spark.table("q_segments")
    spark.sql("DROP VIEW IF EXISTS q_customer_tmp")
    return out


def _catalog_state(spark, step: int, db: str):
    """What the catalogue says of a database: a row for each table with its columns, its property and the sum over its rows."""
    out = None
    for name in sorted(x.name for x in spark.catalog.listTables(db) if not x.isTemporary):
        table = spark.table(f"{db}.{name}")
        props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {db}.{name}").collect()}
        row = table.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("cnt"), F.lit(0)).alias("total")).select(
            F.lit(step).alias("step"), F.lit(name).alias("tbl"), F.lit(",".join(table.columns)).alias("cols"),
            F.lit(props.get("purpose")).cast("string").alias("purpose"), "n_rows", "total")
        row = spark.createDataFrame(row.collect(), row.schema)  # one row: the table may be gone when the result is read
        out = row if out is None else out.unionByName(row)
    return out


@register("set_17_table_ddl", """
WITH c AS (SELECT count(DISTINCT c_mktsegment) AS n, count(*) AS s FROM customer)
SELECT 1 AS step, 'segments' AS tbl, 'c_mktsegment,cnt' AS cols, 'draft' AS purpose, n AS n_rows, s AS total FROM c
UNION ALL SELECT 2, 'by_segment', 'c_mktsegment,cnt', 'draft', n, s FROM c
UNION ALL SELECT 3, 'by_segment', 'c_mktsegment,cnt', 'final', n, s FROM c
UNION ALL SELECT 4, 'by_segment', 'c_mktsegment,cnt,note', NULL, 2 * n, 2 * s FROM c
UNION ALL SELECT 5, 'by_segment', 'c_mktsegment,cnt,note', NULL, 2 * n, 2 * s FROM c
UNION ALL SELECT 5, 'second', 'c_mktsegment,cnt,note', NULL, 0, 0
UNION ALL SELECT 6, 'second', 'c_mktsegment,cnt,note', NULL, 0, 0
""")
def set_17_table_ddl(spark, sf):
    # CREATE, INSERT, ALTER (rename, properties, columns), CREATE LIKE and DROP of tables, each seen in the catalogue afterwards
    db, loc = f"quern_{uuid.uuid4().hex}", scratch_path(spark, "ddl")
    source = t(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("cnt"))
    steps = [
        [f"CREATE TABLE {db}.segments (c_mktsegment STRING, cnt BIGINT) USING parquet TBLPROPERTIES ('purpose' = 'draft')",
         f"INSERT INTO {db}.segments SELECT * FROM {{source}}"],
        [f"ALTER TABLE {db}.segments RENAME TO {db}.by_segment"],
        [f"ALTER TABLE {db}.by_segment SET TBLPROPERTIES ('purpose' = 'final')"],
        [f"ALTER TABLE {db}.by_segment UNSET TBLPROPERTIES ('purpose')",
         f"ALTER TABLE {db}.by_segment ADD COLUMNS (note STRING)",
         f"INSERT INTO {db}.by_segment SELECT *, 'again' FROM {{source}}"],
        [f"CREATE TABLE {db}.second LIKE {db}.by_segment"],
        [f"DROP TABLE {db}.by_segment", f"DROP TABLE IF EXISTS {db}.segments"]]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{loc}'")
    try:
        out = None
        for step, statements in enumerate(steps, 1):
            for statement in statements:
                spark.sql(statement, **({"source": source} if "{source}" in statement else {}))
            seen = _catalog_state(spark, step, db)
            out = seen if out is None else out.unionByName(seen)
        return out
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


@register("set_18_computed_columns_watermark", """
SELECT event_id, ts + INTERVAL 1 HOUR AS local_ts, value * 2 AS doubled FROM events
""")
def set_18_computed_columns_watermark(spark, sf):
    from quern.streaming.watermarks import with_computed_columns
    ev = t(spark, sf, "events")
    out = with_computed_columns(ev, {"local_ts": "ts + INTERVAL 1 HOUR", "doubled": "value * 2"},
                                watermark="WATERMARK FOR ts AS ts - INTERVAL '5' SECOND")
    return out.select("event_id", F.col("local_ts").cast("timestamp_ntz").alias("local_ts"), "doubled")


@register("set_19_partitioned_table", """
SELECT o_orderstatus, count(*) AS cnt, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderstatus IN ('F', 'P') GROUP BY o_orderstatus
""")
def set_19_partitioned_table(spark, sf):
    path = scratch_path(spark, "partitioned_orders")
    t(spark, sf, "orders").write.partitionBy("o_orderstatus").parquet(path)
    back = spark.read.parquet(path).filter(F.col("o_orderstatus").isin("F", "P"))  # partition pruning
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("o_totalprice")).alias("total"))


@register("set_20_databases", """
SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
""")
def set_20_databases(spark, sf):
    loc = scratch_path(spark, "db")
    prev = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS quern_db LOCATION '{loc}'")
    try:
        spark.catalog.setCurrentDatabase("quern_db")
        t(spark, sf, "nation").createOrReplaceTempView("q_nation")
        t(spark, sf, "region").createOrReplaceTempView("q_region")
        return spark.sql("SELECT r_name, count(*) AS nations FROM q_nation JOIN q_region "
                         "ON n_regionkey = r_regionkey GROUP BY r_name")
    finally:
        spark.catalog.setCurrentDatabase(prev)


@register("set_20_database_ddl", """
WITH n AS (SELECT count(*) AS n FROM nation), r AS (SELECT count(*) AS n FROM region)
SELECT 1 AS step, 'one' AS db, 'first' AS note, NULL AS stage, '' AS tables, 0 AS n_rows
UNION ALL SELECT 2, 'one', 'first', 'raw', 'places', n FROM n
UNION ALL SELECT 2, 'two', NULL, NULL, 'places', n FROM r
UNION ALL SELECT 3, 'one', 'first', 'clean', 'places', n FROM n
UNION ALL SELECT 3, 'two', NULL, NULL, 'places', n FROM r
UNION ALL SELECT 4, 'two', NULL, NULL, 'places', n FROM r
""")
def set_20_database_ddl(spark, sf):
    # CREATE, USE, ALTER and DROP of databases: one table name in two of them, a database that isn't empty can't go without CASCADE
    from pyspark.errors import AnalysisException
    mark, loc, prev = uuid.uuid4().hex, scratch_path(spark, "databases"), spark.catalog.currentDatabase()
    one, two = f"quern_one_{mark}", f"quern_two_{mark}"

    def state(step):
        rows = []
        for name, db in (("one", one), ("two", two)):
            if not spark.catalog.databaseExists(db):
                continue
            info = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {db}").collect()}
            stage = re.search(r"\(stage,(\w+)\)", info.get("Properties") or "")
            tables = sorted(x.name for x in spark.catalog.listTables(db) if not x.isTemporary)
            n = sum(spark.table(f"{db}.{x}").count() for x in tables)
            rows.append((step, name, info.get("Comment") or None, stage and stage[1], ",".join(tables), n))
        return rows

    try:
        spark.sql(f"CREATE DATABASE {one} COMMENT 'first' LOCATION '{loc}/one'")
        rows = state(1)
        spark.sql(f"ALTER DATABASE {one} SET DBPROPERTIES ('stage' = 'raw')")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {two} LOCATION '{loc}/two'")
        for db, table in ((one, "nation"), (two, "region")):
            spark.sql(f"USE {db}")
            spark.sql("CREATE TABLE places USING parquet AS SELECT * FROM {src}", src=t(spark, sf, table))
        rows += state(2)
        spark.sql(f"ALTER DATABASE {one} SET DBPROPERTIES ('stage' = 'clean')")
        try:
            spark.sql(f"DROP DATABASE {one} RESTRICT")
        except AnalysisException:
            pass
        rows += state(3)
        spark.sql(f"DROP DATABASE {one} CASCADE")
        rows += state(4)
    finally:
        spark.catalog.setCurrentDatabase(prev)
        for db in (one, two):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    return spark.createDataFrame(rows, "step int, db string, note string, stage string, tables string, n_rows long")


@register("set_21_functions_ddl", """
SELECT p_partkey, upper(p_brand) || '/' || p_size AS label FROM part
""")
def set_21_functions_ddl(spark, sf):
    from quern.functions.udf import brand_label
    spark.udf.register("brand_label", brand_label)
    return spark.sql("SELECT p_partkey, brand_label(p_brand, p_size) AS label FROM {p}", p=t(spark, sf, "part"))


@register("set_22_views", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000")
def set_22_views(spark, sf):
    t(spark, sf, "customer").filter("c_acctbal > 5000").createOrReplaceTempView("q_rich_customers")
    out = spark.table("q_rich_customers").select("c_custkey", "c_name")
    return out


@register("set_26_table_statistics", """
SELECT count(*) AS row_count, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty,
       count(*) - count(l_tax) AS null_tax, count(DISTINCT l_returnflag) AS ndv_flag
FROM lineitem
""")
def set_26_table_statistics(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.agg(F.count(F.lit(1)).alias("row_count"), F.min("l_quantity").alias("min_qty"),
                  F.max("l_quantity").alias("max_qty"),
                  (F.count(F.lit(1)) - F.count("l_tax")).alias("null_tax"),
                  F.countDistinct("l_returnflag").alias("ndv_flag"))


# --- partitioning -----------------------------------------------------------

@register("par_01_key_by", """
SELECT user_id, count(*) AS cnt, round(sum(value), 2) AS total FROM events GROUP BY user_id
""")
def par_01_key_by(spark, sf):
    # keyBy(user_id): hash partitioning on the key; the aggregate reuses it.
    ev = t(spark, sf, "events").repartition("user_id")
    return ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"), r2(F.sum("value")).alias("total"))


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@register("par_02_partition_custom", """
SELECT user_id % 4 AS part, count(*) AS cnt FROM events GROUP BY 1
""")
def par_02_partition_custom(spark, sf):
    ev = t(spark, sf, "events")
    n = partitions(spark)
    custom = ev.repartitionById(n, F.pmod(F.xxhash64("user_id"), F.lit(n)).cast("int"))
    return custom.groupBy(F.pmod(F.col("user_id"), F.lit(4)).cast("long").alias("part")).agg(F.count(F.lit(1)).alias("cnt"))


@register("par_03_broadcast", """
SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name
""")
def par_03_broadcast(spark, sf):
    s, n = t(spark, sf, "supplier"), t(spark, sf, "nation")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).groupBy("n_name") \
        .agg(F.count(F.lit(1)).alias("suppliers"))


@register("par_04_shuffle", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def par_04_shuffle(spark, sf):
    ev = t(spark, sf, "events").repartition(partitions(spark), F.rand(42))
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


@register("par_05_rebalance", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def par_05_rebalance(spark, sf):
    ev = t(spark, sf, "events").repartition(partitions(spark))  # round robin
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


@register("par_06_rescale", "SELECT o_orderstatus, count(*) AS cnt FROM orders GROUP BY o_orderstatus")
def par_06_rescale(spark, sf):
    o = t(spark, sf, "orders").repartition(partitions(spark)).coalesce(max(2, partitions(spark) // 4))  # local merge of partitions, no shuffle
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("cnt"))


@register("par_07_global", """
SELECT date_trunc('day', ts) AS day, count(*) AS cnt FROM events GROUP BY 1
""")
def par_07_global(spark, sf):
    # everything to one task: only after the data is reduced to one row per
    # day, i.e. bounded by the calendar, never on raw rows
    ev = t(spark, sf, "events")
    daily = ev.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count(F.lit(1)).alias("cnt"))
    return daily.repartition(1)  # an exchange: the aggregate before it runs in all its tasks


@register("prd_13_exists_scalar_query", """
SELECT c_custkey, (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS n_orders
FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
""")
def prd_13_exists_scalar_query(spark, sf):
    # EXISTS -> semi join, correlated scalar query -> aggregate + join (Catalyst)
    return spark.sql("""SELECT c_custkey, (SELECT count(*) FROM {o} o WHERE o.o_custkey = c.c_custkey) AS n_orders
                        FROM {c} c WHERE EXISTS (SELECT 1 FROM {o} o WHERE o.o_custkey = c.c_custkey
                                                 AND o.o_orderpriority = '1-URGENT')""",
                     c=t(spark, sf, "customer"), o=t(spark, sf, "orders"))


@register("aux_07_union_all_except_all", """
SELECT 'union_all' AS op, k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY k
UNION ALL
SELECT 'except_all', k, count(*) FROM (SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier) GROUP BY k
""")
def aux_07_union_all_except_all(spark, sf):
    q = """SELECT 'union_all' AS op, k, count(*) AS n FROM (SELECT c_nationkey AS k FROM {c} UNION ALL
             SELECT s_nationkey FROM {s}) GROUP BY k
           UNION ALL
           SELECT 'except_all', k, count(*) FROM (SELECT c_nationkey AS k FROM {c} EXCEPT ALL
             SELECT s_nationkey FROM {s}) GROUP BY k"""
    return spark.sql(q, c=t(spark, sf, "customer"), s=t(spark, sf, "supplier"))


@register("aux_08_intersect_all", """
SELECT 'intersect' AS op, k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) GROUP BY k
UNION ALL
SELECT 'intersect_all', k, count(*) FROM (SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier) GROUP BY k
""")
def aux_08_intersect_all(spark, sf):
    q = """SELECT 'intersect' AS op, k, count(*) AS n FROM (SELECT c_nationkey AS k FROM {c} INTERSECT
             SELECT s_nationkey FROM {s}) GROUP BY k
           UNION ALL
           SELECT 'intersect_all', k, count(*) FROM (SELECT c_nationkey AS k FROM {c} INTERSECT ALL
             SELECT s_nationkey FROM {s}) GROUP BY k"""
    return spark.sql(q, c=t(spark, sf, "customer"), s=t(spark, sf, "supplier"))
