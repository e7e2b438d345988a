import duckdb
import pytest
from pyspark.sql import functions as F

from check import rows
from fxtape.shared import new_folder
from fxtape.streaming import ingest

from registry import messages as m


def test_files_grow_in_number_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(ingest, "FILE_ROWS", 100)
    folder = new_folder(spark, "replay")
    source = spark.range(5000).select(F.timestamp_seconds("id").alias("timestamp"), F.col("id").alias("offset"))
    assert ingest.write_replay(source, folder, 2) == 50
    sizes = spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()
    assert sum(size for _, size in sizes) == 5000
    assert max(size for _, size in sizes) <= 300


@pytest.mark.parametrize("name", ["stream_capture", "stream_dedup", "stream_minute_bars"])
def test_many_files_give_the_same(spark, sf_dir, monkeypatch, name):
    """Batches of a few files each, so that rows, state and the watermark pass from one to the next."""
    monkeypatch.setattr(ingest, "FILE_ROWS", 50)
    monkeypatch.setattr(ingest, "batch_files", lambda spark, files: max(2, files // 5))
    frame = m.QUERIES[name](spark, sf_dir)
    found = rows(frame.columns, frame.collect())
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    result = connection.execute(m.SQL[name])
    assert found == rows([d[0] for d in result.description], result.fetchall())
