"""Replay of stored bars: messages, stream, reconciliation, publication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape import versions
from fxtape.functions.contract import decode_envelope, make_events
from fxtape.operators import compare, rows
from fxtape.plans.rates import RefusedBatch
from fxtape.schemas import MARKET_EVENT
from fxtape.shared import positioned, published
from fxtape.sinks import writers
from fxtape.streaming import ingest


def bar_events(
    bars: DataFrame, received: Column, symbols: list[str] | None = None
) -> DataFrame:
    """Contract events of stored bars; a single invalid bar refuses the replay."""
    events = published(make_events(bars, c.REPLAY_MODE, received, symbols), "replay_events")
    if not events.where(F.col("error").isNotNull()).isEmpty():
        raise RefusedBatch("a bar is no valid replay event")
    return events.drop("error")


def as_messages(events: DataFrame, topic: str) -> DataFrame:
    """Events as messages with one partition per symbol and offsets from 0 in time order.

    The ranking works on a day of a symbol at a time; the events of its earlier days, counted by day,
    are added. Symbols are numbered from their distinct list, so no two share a partition.
    """
    of_day = W.partitionBy("symbol", "event_date").orderBy("event_timestamp", "event_id")
    before = W.partitionBy("symbol").orderBy("event_date").rowsBetween(W.unboundedPreceding, -1)
    days = events.groupBy("symbol", "event_date").agg(F.count(F.lit(1)).alias("_events")).select(
        "symbol", "event_date", F.coalesce(F.sum("_events").over(before), F.lit(0)).alias("_earlier")
    )
    symbols = positioned(published(events.select("symbol").distinct(), "symbols").sort("symbol")).select(
        "symbol", F.col("position").alias("_partition")
    )
    numbered = (
        events.withColumn("_rank", F.row_number().over(of_day) - 1)
        .join(days, ["symbol", "event_date"]).join(symbols, "symbol")
        .withColumn("_offset", F.col("_earlier") + F.col("_rank"))
    )
    return ingest.replay_messages(numbered, topic, F.col("_partition"), F.col("_offset"))


def replay_and_publish(
    spark: SparkSession,
    bars: DataFrame,
    received: Column,
    root: str,
    table: str,
    run_id: str,
    symbols: list[str] | None = None,
    files: int = 8,
    files_per_trigger: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """Stream the bars through the contract and publish them when everything reconciles.

    Returns the run's metrics and its gate, one row each. The market table gets a new version
    that is partitioned by event date and sorted by symbol and mode.
    """
    events = bar_events(bars, received, symbols)
    paths = ingest.run_paths(root, run_id)
    source = f"{root}/topic/run_id={run_id}"
    written = ingest.write_replay(as_messages(events, f"market.{run_id.lower()}"), source, files)
    stream = ingest.replay_stream(spark, source, max(files_per_trigger, ingest.batch_files(spark, written)))
    metrics = published(ingest.run_once(stream, paths, events.count(), symbols), "run_metrics")
    # Both are read several times: stored once, with the fields that are compared and no message beside them.
    stored = published(rows.dedup_run_events(ingest.sink_rows(spark, paths)).select(*MARKET_EVENT.names), "stored")
    captured = published(
        decode_envelope(ingest.raw_rows(spark, paths), symbols).select(*MARKET_EVENT.names, "error"), "captured"
    )
    partition, cluster = writers.MARKET_LAYOUT
    gate = publish_checked(captured, stored, metrics, table, run_id, partition, cluster)
    writers.write_manifest(
        spark, f"{table}/{versions.newest(spark, table).folder}", f"{root}/manifests/run_id={run_id}", run_id,
        c.EVENT_SOURCE, metrics.first().valid, whole=True,
    )
    return metrics, gate


def publish_checked(
    captured: DataFrame, valid: DataFrame, report: DataFrame, table: str, run_id: str,
    partition: Sequence[str] = (), cluster: Sequence[str] = (),
) -> DataFrame:
    """Write, audit, publish: a version is staged, reconciled as it reads back, and only then named.

    The gate compares the capture with the run's output and with what was read from the staged version,
    and both sizes with the run's ``report``. If it refuses, the staged files go and readers still see the
    version before. Returns the gate's row.
    """
    spark = valid.sparkSession
    told = report.first().valid
    staged = versions.stage(writers.layout(valid, partition, cluster), table, run_id, told, *partition)
    back = versions.read(spark, table, staged, MARKET_EVENT).select(*MARKET_EVENT.names)
    gate = published(compare.publication_gate(captured, valid, report, back), "gate")
    if not gate.first().accepted:
        versions.remove(spark, f"{table}/{staged.folder}")
        raise RefusedBatch(f"capture and stored events do not reconcile: {gate.first().asDict()}")
    versions.publish(spark, table, staged)
    return gate
