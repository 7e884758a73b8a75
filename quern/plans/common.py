"""Small helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.tables import read_table


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def r2(c) -> F.Column:
    """Round a double to 2 places (sums of money values)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 2)


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
