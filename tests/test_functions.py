import hashlib

from pyspark.sql import functions as F

from quern.functions import scalar as S
from tests.brute import java_hash


def test_hash_code_is_java_string_hash(spark):
    words = ["", "a", "abc", "hello world", "Zürich", "x" * 50]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = {r.s: r.h for r in df.select("s", S.hash_code("s").alias("h")).collect()}
    assert got == {w: java_hash(w) for w in words}


def test_similar_to_translation():
    assert S.similar_to_regex("(small|red)%") == "^(?:(small|red).*)$"
    assert S.similar_to_regex("a_b.c") == "^(?:a.b\\.c)$"


def test_initcap_splits_on_non_alphanumerics(spark):
    df = spark.createDataFrame([("a-b c",), ("hELLO wORLD",), ("x1y_z",)], "s string")
    got = [r[0] for r in df.select(S.initcap("s")).collect()]
    assert got == ["A-B C", "Hello World", "X1y_Z"]


def test_split_index_and_regexp_extract(spark):
    df = spark.createDataFrame([("a.b..c",)], "s string")
    r = df.select(S.split_index("s", ".", 0).alias("i0"), S.split_index("s", ".", 2).alias("i2"),
                  S.split_index("s", ".", 9).alias("i9"),
                  S.regexp_extract_or_null("s", "z(.)", 1).alias("none")).first()
    assert (r.i0, r.i2, r.i9, r.none) == ("a", "", None, None)


def test_str_to_map_last_key_wins(spark):
    df = spark.createDataFrame([("a=1,b=2,a=3",)], "s string")
    m = df.select(S.str_to_map("s").alias("m")).first().m
    assert m == {"a": "3", "b": "2"}


def test_sha2_family_matches_hashlib(spark):
    df = spark.createDataFrame([("quern",)], "s string")
    r = df.select(*[F.sha2("s", b).alias(f"h{b}") for b in (224, 256, 384, 512)]).first()
    for b in (224, 256, 384, 512):
        assert r[f"h{b}"] == getattr(hashlib, f"sha{b}")(b"quern").hexdigest()


def test_extract_century_and_millennium(spark):
    df = spark.createDataFrame([("2024-05-01 00:00:00",), ("2000-12-31 00:00:00",)], "s string") \
        .select(F.to_timestamp_ntz("s").alias("t"))
    got = [(r.c, r.m, r.d) for r in df.select(S.extract("CENTURY", "t").alias("c"),
                                              S.extract("MILLENNIUM", "t").alias("m"),
                                              S.extract("DECADE", "t").alias("d")).collect()]
    assert got == [(21, 3, 202), (20, 2, 200)]


def test_element_errors_on_more_than_one(spark):
    import pytest
    df = spark.createDataFrame([([1, 2],)], "a array<int>")
    with pytest.raises(Exception):
        df.select(S.element("a")).collect()


def test_similar_to_crosses_line_breaks(spark):
    df = spark.createDataFrame([("a\nb",), ("ab\n",)], "s string")
    assert [r[0] for r in df.select(S.similar_to("s", "a%b")).collect()] == [True, False]


def test_int_divide_and_hash_code_are_exact(spark):
    df = spark.createDataFrame([(2**53 + 1, 1, "\U0001F600"), (-7, 2, "hello"), (7, -2, ""), (None, 2, None)], "a long, b long, s string")
    out = df.select(S.int_divide("a", "b").alias("q"), S.hash_code("s").alias("h")).collect()
    assert [r.q for r in out] == [2**53 + 1, -3, -3, None]
    assert [r.h for r in out] == [1772899, 99162322, 0, None]
