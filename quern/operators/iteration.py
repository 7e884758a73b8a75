"""STR-46 iteration, re-aimed as a bounded fix-point loop over DataFrames.

Each round transforms the rows still in the loop; rows that leave it are
collected.  Every few rounds the loop state is cut from its lineage with a
reliable ``checkpoint()`` (the shared ``spark.checkpoint.dir``), so a lost
executor recomputes at most a few rounds and the plan does not grow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import checkpoint_root


def iterate(df: DataFrame, step: Callable[[DataFrame], DataFrame], keep_going: Column,
            max_rounds: int | None = None, checkpoint_every: int = 4) -> DataFrame:
    """Rows for which ``keep_going`` holds go through ``step`` again, until none
    is left; a row whose condition is null leaves the loop.  ``max_rounds`` is
    for loops that may not end: rows left behind it are an error, never dropped."""
    checkpoint_root(df.sparkSession)
    stay = F.coalesce(keep_going, F.lit(False))
    done, cur, rounds = None, df, 0
    while True:
        out = cur.filter(~stay)
        done = out if done is None else done.unionByName(out)
        cur = cur.filter(stay)
        if cur.isEmpty():
            return done
        if rounds == max_rounds:
            raise RuntimeError(f"rows are still in the loop after {max_rounds} rounds")
        cur = step(cur)
        rounds += 1
        if rounds % checkpoint_every == 0:
            cur = cur.checkpoint(eager=True)
            done = done.checkpoint(eager=True)
