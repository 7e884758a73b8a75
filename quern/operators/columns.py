"""Column operations of the Table API (PRJ-05..19) and stream routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_columns(df: DataFrame, **cols: Column) -> DataFrame:
    """PRJ-05: add columns; an existing name is an error."""
    clash = [c for c in cols if c in df.columns]
    if clash:
        raise ValueError(f"add_columns: columns already exist: {clash}")
    return df.withColumns(cols)


def add_or_replace_columns(df: DataFrame, **cols: Column) -> DataFrame:
    """PRJ-06."""
    return df.withColumns(cols)


def rename_columns(df: DataFrame, **renames: str) -> DataFrame:
    """PRJ-07 ``renameColumns(a as b)``."""
    return df.withColumnsRenamed(renames)


def with_columns(df: DataFrame, start: int, end: int) -> DataFrame:
    """PRJ-09 ``withColumns(start to end)``: 1-based, inclusive."""
    return df.select(*df.columns[start - 1:end])


def without_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in names])


def project(df: DataFrame, *indexes: int) -> DataFrame:
    """PRJ-15 tuple projection by 0-based field index, in the given order."""
    return df.select(*[df.columns[i] for i in indexes])


def flatten(df: DataFrame, struct_col: str, prefix: str | None = None) -> DataFrame:
    """PRJ-19 ``flatten()``: nested fields become top-level columns."""
    fields = df.schema[struct_col].dataType.fieldNames()
    p = prefix if prefix is not None else f"{struct_col}$"
    others = [c for c in df.columns if c != struct_col]
    return df.select(*others, *[F.col(struct_col)[f].alias(p + f) for f in fields])


def tag(df: DataFrame, rules: Sequence[tuple[str, Column]], tag_col: str = "_tag",
        default: str | None = None) -> DataFrame:
    """PRJ-16/17 side outputs: the first matching rule names the output of a
    row; ``outputs(df, name)`` reads one of them.  One pass, no re-scan."""
    expr = None
    for name, cond in rules:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = expr.otherwise(F.lit(default)) if default is not None else expr
    return df.withColumn(tag_col, expr)


def output(tagged: DataFrame, name: str, tag_col: str = "_tag") -> DataFrame:
    return tagged.filter(F.col(tag_col) == name).drop(tag_col)


def split(df: DataFrame, rules: Sequence[tuple[str, Column]], tags_col: str = "_tags") -> DataFrame:
    """PRJ-18 split/select: a row may go to several named outputs."""
    arr = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))
    return df.withColumn(tags_col, arr)


def select_outputs(split_df: DataFrame, *names: str, tags_col: str = "_tags") -> DataFrame:
    cond = None
    for n in names:
        c = F.array_contains(F.col(tags_col), n)
        cond = c if cond is None else cond | c
    return split_df.filter(cond).drop(tags_col)
