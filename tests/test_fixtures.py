"""Hand-computed expectations from the reference's study tests (FIXTURES.md)."""

import datetime as dt
import os

import pandas as pd
from pyspark.sql import functions as F

from quern.operators import aggregates as A
from quern.operators import windows as W
from quern.session import scratch_path

ITEMS = [
    ("Item001", "Electronic", "2020-11-11 10:01:00", 1, 98.01),
    ("Item002", "Electronic", "2020-11-11 10:01:59", 2, 100.22),
    ("Item003", "Electronic", "2020-11-11 10:02:00", 1, 102.03),
    ("Item004", "Food", "2020-11-11 10:04:00", 2, 10.01),
    ("Item005", "Food", "2020-11-11 10:04:01", 1, 9.03),
]
EXPECTED = {("Electronic", "10:01"): (2, 3, 298.45), ("Electronic", "10:02"): (1, 1, 102.03),
            ("Food", "10:04"): (2, 3, 29.05)}


def _items(spark):
    df = spark.createDataFrame(ITEMS, "item string, category string, timeStr string, num int, price double")
    return df.withColumn("rowtime", F.to_timestamp_ntz("timeStr"))


def _check(rows):
    got = {(r.category, r.w.strftime("%H:%M")): (r.cnt, r.num, round(r.account, 2)) for r in rows}
    assert got == EXPECTED


def test_item_windows_batch(spark):
    df = _items(spark)
    out = df.groupBy("category", W.tumble("rowtime", "1 minute").start.alias("w")).agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("num").alias("num"),
        F.sum(F.col("num") * F.col("price")).alias("account"))
    _check(out.collect())


def test_item_windows_row_count_sum_udaf(spark):
    df = _items(spark)
    out = df.groupBy("category", W.tumble("rowtime", "1 minute").start.alias("w")).agg(
        A.ROW_COUNT_SUM(F.col("num"), F.col("price")).alias("r"), F.sum("num").alias("num"))
    got = {(r.category, r.w.strftime("%H:%M")): (r.r.cnt, r.num, round(r.r.account, 2)) for r in out.collect()}
    assert got == EXPECTED


def test_item_windows_stream_with_one_minute_watermark(spark):
    from quern.sources.replay import replay
    from quern.streaming.runner import drop_flush, run_to_table
    path = os.path.join(scratch_path(spark, "items"), "items.parquet")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pdf = pd.DataFrame(ITEMS, columns=["item", "category", "timeStr", "num", "price"])
    pdf["rowtime"] = pd.to_datetime(pdf["timeStr"])
    pdf.to_parquet(path)
    s = replay(spark, path, rows_per_batch=1, flush=True, time_column="rowtime")
    s = s.withColumn("rowtime", F.col("rowtime").cast("timestamp")).withWatermark("rowtime", "1 minute")
    s = drop_flush(s, "rowtime")
    # grouping on the window struct keeps the watermark on the key (append mode)
    agg = s.groupBy("category", F.window("rowtime", "1 minute").alias("win")).agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("num").alias("num"),
        F.sum(F.col("num") * F.col("price")).alias("account")).select(
        "category", F.col("win.start").cast("timestamp_ntz").alias("w"), "cnt", "num", "account")
    _check(run_to_table(agg, "append").collect())


def test_late_rows_boundary(spark):
    """5-second windows, zero lateness, 1 s bound: a row is late once the
    running max minus the bound reaches its window's last millisecond."""
    from quern.streaming.late import tag_late
    base = dt.datetime(2020, 11, 2, 21, 1, 0)
    ms = [5998, 5999, 6998, 6999, 8999, 4999, 9999, 4000]
    rows = [(i, base + dt.timedelta(milliseconds=m)) for i, m in enumerate(ms)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    got = {r.id: r.is_late for r in tag_late(df, "id", "ts", 1000, 5000).collect()}
    # window [21:01:00, 21:01:05) ends at ...04.999: late once watermark >= 4999 ms
    # watermark before id 5 = 8999 - 1000 = 7999 -> row 4999 (window end 4999) late
    assert got[5] is True and got[7] is True
    assert not any(got[i] for i in (0, 1, 2, 3, 4, 6))
