import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quern.operators.prefix import prefix_scan


def _data(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    # one hot key holding a third of all rows, plus many small keys
    keys = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 200, n))
    vals = rng.integers(-50, 50, n).astype(float)
    vals[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"k": keys, "t": rng.permutation(n), "v": vals, "id": np.arange(n)})
    return pdf, spark.createDataFrame(pdf)


def test_prefix_scan_matches_pandas_with_hot_key(spark):
    pdf, df = _data(spark)
    out = prefix_scan(df, ["k"], ["t", "id"], row_number="rn", sums={"s": "v"},
                      mins={"mn": "v"}, maxs={"mx": "v"}, num_slices=7).toPandas()
    exp = pdf.sort_values(["k", "t", "id"]).copy()
    g = exp.groupby("k")
    exp["rn"] = g.cumcount() + 1
    exp["s"] = exp["v"].fillna(0).groupby(exp["k"]).cumsum()
    exp["mn"] = g["v"].cummin().groupby(exp["k"]).ffill()
    exp["mx"] = g["v"].cummax().groupby(exp["k"]).ffill()
    m = out.merge(exp, on="id", suffixes=("", "_e"))
    assert len(m) == len(pdf)
    assert (m["rn"] == m["rn_e"]).all()
    assert np.allclose(m["s"], m["s_e"])
    assert np.allclose(m["mn"].astype(float), m["mn_e"], equal_nan=True)
    assert np.allclose(m["mx"].astype(float), m["mx_e"], equal_nan=True)


def test_prefix_scan_global_order(spark):
    pdf, df = _data(spark, n=1000, seed=2)
    out = prefix_scan(df, [], [F.col("t").desc(), F.col("id")], row_number="pos", num_slices=5).toPandas()
    exp = pdf.sort_values(["t", "id"], ascending=[False, True]).reset_index(drop=True)
    exp["pos"] = np.arange(1, len(exp) + 1)
    m = out.merge(exp[["id", "pos"]], on="id", suffixes=("", "_e"))
    assert (m["pos"] == m["pos_e"]).all()


def test_hot_key_is_split_across_slices(spark):
    pdf, df = _data(spark, n=3000, seed=3)
    ranged = df.repartitionByRange(6, "k", "t", "id").withColumn("p", F.spark_partition_id())
    slices = ranged.filter("k = 0").select("p").distinct().count()
    assert slices > 1


def test_null_keys_are_one_key_and_types_stay(spark):
    from decimal import Decimal
    from pyspark.sql import Window
    big = 2**53 + 1
    rows = [(None if i % 3 else "k", i, big + i, Decimal(i) / 7) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, id long, big long, d decimal(20,6)")
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    got = prefix_scan(df, ["k"], ["id"], sums={"s": "d"}, mins={"mn": "big"}, maxs={"mx": "big"}, num_slices=7)
    want = df.select("*", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("long").alias("rn"), F.sum("d").over(w).alias("s"),
                     F.min("big").over(w).alias("mn"), F.max("big").over(w).alias("mx"))
    assert sorted(map(tuple, got.select(want.columns).collect()), key=lambda r: r[1]) == sorted(map(tuple, want.collect()), key=lambda r: r[1])
    assert dict(got.dtypes)["mx"] == "bigint" and max(r.rn for r in got.filter("k is null").collect()) == 40


def test_falling_order_and_slices_of_a_single_key(spark):
    df = spark.range(500).withColumn("v", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 37))
    for order in (["v", "id"], [F.col("v").desc(), F.col("id")], [F.col("v").asc_nulls_last(), F.col("id").desc()], [F.col("v").desc_nulls_first(), F.col("id")]):
        from pyspark.sql import Window
        cols = [F.col(o) if isinstance(o, str) else o for o in order]
        got = prefix_scan(df, [], order, num_slices=9).select("id", "rn").collect()
        want = df.select("id", F.row_number().over(Window.orderBy(*cols)).alias("rn")).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_prefix_scan_and_frames_are_lazy_sql_plans(spark):
    """No Python in the plan and nothing but the bounds' sample goes to the driver."""
    from quern.operators.frames import rows_frame
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = rows_frame(df, ["k"], ["id"], {"x": ("sum", "id", -2, 0)}, num_slices=3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_falling_strings_times_and_flags_are_cut_into_slices(spark):
    import datetime

    from pyspark.sql import Window

    from quern.operators.prefix import with_slices
    words = ["", "a", "ab", "abc", "b", "é", "中", "\U0001F600", None, "a\x00", "A"]
    rows = [(i, words[i % 11], None if i % 13 == 0 else datetime.date(2020, 1, 1 + i % 28), datetime.datetime(1969, 12, 31, 23, 59, i % 60, i), i % 3 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, w string, d date, t timestamp_ntz, f boolean").withColumn("z", F.col("t").cast("timestamp"))
    for name in ("w", "d", "t", "z", "f"):
        for order in ([F.col(name).desc()], [F.col(name).desc_nulls_first()], [F.col(name).desc(), F.col("id").desc()]):
            cols = [*order, F.col("id")]
            assert with_slices(df, [], cols, 9).select("_q_pid").distinct().count() > 4
            got = prefix_scan(df, [], cols, num_slices=9).select("id", "rn").collect()
            want = df.select("id", F.row_number().over(Window.orderBy(*cols)).alias("rn")).collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, want))
