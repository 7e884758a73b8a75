"""Every batch query with an oracle, at sf0.001, against DuckDB."""

import datetime
import decimal
import math

import duckdb
import pytest

from quern.sources.tables import TABLES
from tests.conftest import SF_SMALL

import __spark_entry__ as E

STREAMING = ("str_01", "str_02", "str_05", "str_07_sliding_window_stream", "str_08_session_window_stream",
             "str_21", "str_2", "str_3", "str_4", "str_50_match_recognize", "agg_03", "set_02", "set_03",
             "ovr_05", "ovr_14_streaming", "ovr_16_streaming", "src_11", "src_15", "joi_11",
             "joi_12_time_windowed_join_stream", "snk_07", "snk_1", "snk_18", "snk_19")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.6g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((_norm(k), _norm(x)) for k, x in v.items()))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


BATCH = sorted(n for n in E.oracle_sql() if not n.startswith(STREAMING) or n in (
    "str_06_tumbling_window", "str_06_tumbling_window_offset", "str_07_sliding_window", "str_08_session_window",
    "str_09_dynamic_session_gap", "str_10_global_window", "str_11_count_window_tumbling",
    "str_12_count_window_sliding", "str_13_window_all", "str_14_sql_group_window", "str_15_table_api_windows",
    "str_16_batch_group_window", "str_17_window_table_aggregate", "str_18_window_aggregate",
    "str_19_window_process", "str_20_window_min_max_by", "str_22_late_data_side_output",
    "str_32_count_evictor", "str_33_time_evictor", "str_34_delta_evictor", "str_35_vector_delta",
    "str_36_field_extractors", "str_46_iteration", "str_04_punctuated_watermark", "str_45_async_io",
    "str_03_ascending_timestamps"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s = df.collect()
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, s) == _rows(dcols, cur.fetchall())
