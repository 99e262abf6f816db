"""Catalog queries against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SAMPLE = ["source_counts", "normalize_mixed", "duplicate_report", "run_totals", "quality_scores",
          "alerts_latest", "alerts_all_runs", "run_deltas", "run_lineage", "activity_feed",
          "ingest_files", "ingest_repeat", "ingest_retry", "lineage_stored", "quality_of_nothing",
          "quality_first_read", "incremental_analysis", "run_state_repeated", "stream_run_state",
          "stream_run_state_updates", "stream_three_feeds", "source_status_upsert",
          "source_status_strict", "health_score", "reject_reasons", "cross_run_new"]

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def _key(row):
    return tuple(str(v) for v in row)


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, con, name):
    frame = entry_points.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=_key)
    answer = con.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in answer.fetchall()), key=_key)
    assert got == want


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLE) == {"forest_anomalies"}
