"""User-defined functions (UDF-01..08): vectorised pandas UDFs only.

They are small per-row helpers; the surrounding work stays in Spark plans.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def brand_label(brand: pd.Series, size: pd.Series) -> pd.Series:
    """UDF-01/05 scalar function: ``upper(brand) || '/' || size`` per batch."""
    return brand.str.upper() + "/" + size.astype("Int64").astype(str)


@F.pandas_udf(T.LongType())
def token_count(text: pd.Series) -> pd.Series:
    """UDF-05: number of space-separated non-empty tokens of a whole text."""
    return text.fillna("").str.split(" ").map(lambda ws: sum(1 for w in ws if w)).astype("int64")


def register_segments(spark) -> None:
    """UDF-02 table function ``segments(url)``: one row per non-empty path
    segment (Arrow-batched Python UDTF), usable with LATERAL."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="seg: string, n: int", useArrow=True)
    class Segments:
        def eval(self, url: str):
            if url is None:
                return
            for s in url.split("/"):
                if s:
                    yield s, len(s)

    spark.udtf.register("segments", Segments)
