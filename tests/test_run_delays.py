from datetime import datetime, timezone

from pyspark.sql import functions as F

from fxtape.operators.reports import run_metrics


def test_delays_beyond_a_long_are_averaged(spark):
    """A hundred thousand replays of an old bar, shown by a hundred with delays of millennia."""
    old, new = (datetime(year, 1, 1, tzinfo=timezone.utc) for year in (2000, 9000))
    events = spark.range(100).select(
        F.lit("run").alias("run_id"), F.col("id").cast("string").alias("event_id"),
        F.lit("replay").alias("ingestion_mode"), F.lit(new).alias("processed_at"),
        F.lit(old).alias("ingested_at"), F.lit(None).cast("string").alias("error"),
    )
    found = run_metrics(events).first()
    assert found.valid == found.unique_event_ids == 100
    assert found.mean_replay_processing_seconds == (new - old).total_seconds()
