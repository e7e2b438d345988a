"""Events of one type and time: refused as bars of the source, kept apart where they have numbers."""

import duckdb
import pytest

from check import rows
from fxtape.plans import archive
from fxtape.plans.rates import RefusedBatch
from fxtape.shared import new_folder

from registry import commits


@pytest.fixture(scope="module")
def pairs(sf_dir, tmp_path_factory):
    """Events, those with an odd number of type and time of the one before."""
    folder = tmp_path_factory.mktemp("pairs")
    connection = duckdb.connect()
    connection.execute(f"""COPY (SELECT a.* REPLACE (b.ts AS ts, b.event_type AS event_type)
        FROM '{sf_dir}/events.parquet' a JOIN '{sf_dir}/events.parquet' b ON b.event_id = a.event_id - a.event_id % 2
        ORDER BY a.event_id) TO '{folder}/events.parquet'""")
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("name", ["archive_refresh", "archive_refresh_counts"])
def test_query_matches_sql(spark, pairs, name):
    folder, connection = pairs
    frame = commits.QUERIES[name](spark, folder)
    found = rows(frame.columns, frame.collect())
    result = connection.execute(commits.SQL[name])
    assert found == rows([d[0] for d in result.description], result.fetchall())


def test_bars_without_numbers_are_refused(spark, pairs):
    collected = commits._collected(spark, pairs[0], ">= '2024-01-01'", False)
    with pytest.raises(RefusedBatch):
        archive.refresh_archive(
            spark, collected, new_folder(spark, "archive"), new_folder(spark, "active"), commits.LATER,
            "2024-02-01 00:00:00", required=commits.SYMBOLS,
        )
