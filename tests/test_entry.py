import os

import duckdb
import pytest

from tests.conftest import SF001

import __spark_entry__ as E

FAST = ["clean", "cleaning_report", "vessel_metrics", "top_vessels", "fleet_statistics", "daily_traffic",
        "traffic_summary", "data_quality_raw", "decode_types", "index_files", "archive_listing", "table_changes"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 5
    assert df.columns[:3] == ["mmsi", "vessel_name", "total_distance_nm"]


def test_every_query_has_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    from trackline.plans.queries import QUERIES
    assert set(QUERIES) <= set(q)
    assert set(QUERIES) <= set(o)  # training-data queries have tests of their own


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["events", "pages"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("key", FAST)
def test_matches_oracle(spark, duck, key):
    from tools.oracle_check import rows_of
    df = E.queries()[key](spark, SF001)
    res = duck.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())
