"""Registered queries against their SQL on the smallest tables.

Runs a query or more of every group; REGISTRY=all runs every one, as check.py does on larger tables.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows

from registry import catalog

QUERIES, SQL = catalog.QUERIES, catalog.SQL
SOME = [
    "stg_dedup", "fx_asof_events", "stock_monitoring", "latest", "selection_summary",
    "selection_contribution", "selection_last", "signal_pivot", "history_audit",
    "contributions_reconcile", "no_future_fx", "monitoring_contract", "recheck_signals",
    "coverage_report", "key_quality", "merge_latest", "merge_checked", "archive_merge",
    "compare_ids", "overlap_align", "check_bars", "processed_vs_raw", "text_functions",
    "time_functions", "number_functions", "run_dedup", "event_identity", "event_contract",
    "event_reconcile", "run_metrics", "stream_valid_events", "stream_minute_bars", "fx_xml_clean",
    "sink_layout", "sink_json", "manifest_violations", "upsert_partitions", "archive_refresh_counts",
    "rate_batch", "replay_publish", "stream_dedup", "stream_bounded",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("REGISTRY") == "all" else SOME)
def test_query_matches_sql(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    found = rows(frame.columns, frame.collect())
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert found == rows(columns, result.fetchall())


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0
    assert result.where("strategy_signal IN ('BUY', 'SELL')").count() > 0
