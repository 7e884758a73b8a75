import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.operators.frames import rows_frame


def test_rows_frame_matches_window_functions_with_hot_key(spark):
    rng = np.random.default_rng(5)
    n = 2500
    keys = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n))
    vals = rng.integers(-20, 20, n).astype(float)
    vals[rng.random(n) < 0.1] = np.nan
    pdf = pd.DataFrame({"k": keys, "t": rng.permutation(n), "v": vals, "id": np.arange(n)})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")   # many batches per slice
    try:
        got = rows_frame(df, ["k"], ["t", "id"], {
            "s": ("sum", "v", -2, 1), "c": ("count", "v", -3, 0), "a": ("avg", "v", -1, 2),
            "mn": ("min", "v", -4, 0), "mx": ("max", "v", 0, 3), "lag": ("shift", "v", -1),
            "lead2": ("shift", "v", 2)}, num_slices=9).toPandas().set_index("id").sort_index()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = df.select("id", F.sum("v").over(w.rowsBetween(-2, 1)).alias("s"),
                    F.count("v").over(w.rowsBetween(-3, 0)).alias("c"),
                    F.avg("v").over(w.rowsBetween(-1, 2)).alias("a"),
                    F.min("v").over(w.rowsBetween(-4, 0)).alias("mn"),
                    F.max("v").over(w.rowsBetween(0, 3)).alias("mx"),
                    F.lag("v").over(w).alias("lag"), F.lead("v", 2).over(w).alias("lead2")) \
        .toPandas().set_index("id").sort_index()
    for c in ["s", "c", "a", "mn", "mx", "lag", "lead2"]:
        assert np.allclose(got[c].astype(float), exp[c].astype(float), equal_nan=True), c


def test_count_distinct_frame_and_dense_ids(spark):
    from quern.operators.frames import dense_ids
    rows = [(1, i, v) for i, v in enumerate(["a", "b", "a", None, "c", "c", "b"])]
    df = spark.createDataFrame(rows, "k int, t int, s string")
    df = dense_ids(df, "s", "sid")
    got = {r.t: r.d for r in rows_frame(df, ["k"], ["t"], {"d": ("count_distinct", "sid", -2, 0)},
                                        num_slices=3).collect()}
    assert got == {0: 1, 1: 2, 2: 2, 3: 2, 4: 2, 5: 1, 6: 2}


def test_null_keys_big_ids_text_and_defaults(spark):
    big = 2**53 + 1
    rows = [(None, i, big + i, None if i == 5 else f"s{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "k int, id long, big long, s string")
    got = rows_frame(df, ["k"], ["id"], {"lag": ("shift", "big", -1), "nxt": ("shift", "s", 2, "none")}, num_slices=5).orderBy("id").collect()
    assert [r.lag for r in got] == [None] + [big + i for i in range(19)] and [r.big for r in got] == [big + i for i in range(20)]
    assert [r.nxt for r in got] == [None if i + 2 == 5 else f"s{i + 2}" if i < 18 else "none" for i in range(20)]


def test_blocks_smaller_than_a_key(spark, monkeypatch):
    import quern.operators.frames as frames
    monkeypatch.setattr(frames, "BLOCK", 4)
    df = spark.range(50).withColumn("k", F.lit(1)).withColumn("v", F.col("id").cast("double"))
    w = Window.partitionBy("k").orderBy("id")
    got = rows_frame(df, ["k"], ["id"], {"s": ("sum", "v", -6, 3), "d": ("count_distinct", "v", -2, 0)}).select("id", "s", "d").collect()
    want = df.select("id", F.sum("v").over(w.rowsBetween(-6, 3)), F.size(F.collect_set("v").over(w.rowsBetween(-2, 0)))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_one_huge_value_leaves_no_error_in_later_frames(spark):
    from quern.operators.frames import range_frame
    from quern.operators.windows import sliding_count_window
    df = spark.createDataFrame([(1, i, 1e16 if i == 0 else 0.01) for i in range(12)], "k int, id long, v double")
    last = sliding_count_window(df, ["k"], ["id"], 4, 4, "v").orderBy("fire_rn").collect()[-1]
    assert abs(last.sum_value - 0.04) < 1e-12
    out = {r.id: r.range_sum for r in range_frame(df, ["k"], "id", -1, 0, "v", "id").collect()}
    assert abs(out[5] - 0.02) < 1e-12 and out[0] == 1e16
    ahead = {r.id: (r.range_cnt, r.range_sum) for r in range_frame(df, ["k"], "id", 2, 3, "v", "id").collect()}
    assert ahead[11] == (0, None) and ahead[9] == (1, 0.01)
