"""GROUPING SETS with repeated sets and null keys."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.operators.aggregates import grouping_sets


def test_repeated_sets_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1), (None, None)], "x string, y int")
    out = grouping_sets(df, ["x", "y"], [["x"], [], ["x"], ["y", "x"], []], {"n": F.count(F.lit(1)), "ys": F.count("y")})
    rows = [("a", None, 1, g, 2, 1) for g in (0, 1)] + [(None, None, 1, g, 2, 1) for g in (0, 1)]
    rows += [(None, None, 3, g, 4, 2) for g in (0, 1)]
    rows += [(x, y, 0, 0, 1, int(y is not None)) for x in ("a", None) for y in (1, None)]
    assert Counter(tuple(r) for r in out.collect()) == Counter(rows)
    assert grouping_sets(df.limit(0), ["x"], [["x"]], {"n": F.count(F.lit(1))}).collect() == []
    with pytest.raises(ValueError, match="not among"):
        grouping_sets(df, ["x"], [["y"]], {})
