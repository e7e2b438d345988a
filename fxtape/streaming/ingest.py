"""Streaming ingestion: decode, validate, split, capture, append, deduplicate."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fxtape import versions
from fxtape.functions.contract import decode_message, event_json, route_invalid
from fxtape.operators.reports import run_metrics
from fxtape.schemas import ENVELOPE, RUN_EVENT
from fxtape.shared import new_folder
from fxtape.sinks import writers
from fxtape.sources.readers import stream_events


@dataclass(frozen=True)
class RunPaths:
    """Everything one run writes; no two runs share a folder."""

    run_id: str
    checkpoint: str
    raw: str
    valid: str
    invalid: str
    admitted: str


def run_paths(root: str, run_id: str) -> RunPaths:
    base = f"{root.rstrip('/')}/run_id={run_id}"
    folders = ("checkpoint", "raw", "valid", "invalid", "admitted")
    return RunPaths(run_id, *[f"{base}/{name}" for name in folders])


def process_events(
    stream: DataFrame, symbols: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Valid events and dead letters of a stream or a batch of messages."""
    return route_invalid(decode_message(stream, symbols))


def admitted(spark: SparkSession, paths: RunPaths) -> int:
    """Messages a bounded run has let in so far."""
    told = [versions.read_small(spark, f"{paths.admitted}/{name}") for name in versions.names(spark, paths.admitted)]
    return sum(entry["count"] for entry in told if entry is not None)


def _admit(batch: DataFrame, batch_id: int, paths: RunPaths, limit: int) -> DataFrame:
    """The messages of a batch that still fit in the limit: whole partitions in order, the one that does
    not fit up to an end offset.

    What earlier batches let in is read from their entries, so a batch that is tried again after a failure
    lets the same messages in. The entry holds the count and each partition's end offset. One row per
    partition reaches the driver.
    """
    spark = batch.sparkSession
    entry = f"{paths.admitted}/{batch_id:012d}.json"
    earlier = [n for n in versions.names(spark, paths.admitted) if n < f"{batch_id:012d}"]
    told = [versions.read_small(spark, f"{paths.admitted}/{name}") for name in earlier]
    room = limit - sum(value["count"] for value in told if value is not None)
    place = ["topic", "partition"]
    sizes = batch.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("last")).orderBy(*place)
    ends, taken = {}, F.lit(False)
    for row in sizes.collect():
        if room <= 0:
            break
        here = (F.col("topic") == row.topic) & (F.col("partition") == row.partition)
        last = row.last
        if row.n > room:
            first = batch.where(here).select("offset").orderBy("offset").limit(room)
            last = first.agg(F.max("offset")).first()[0]
        taken = taken | (here & (F.col("offset") <= last))
        ends[f"{row.topic}/{row.partition}"] = last + 1
        room -= min(row.n, room)
    kept = batch.where(taken)
    versions.write_small(spark, entry, {"count": kept.count(), "ends": ends}, True)
    return kept


def capture_then_process(
    stream: DataFrame, paths: RunPaths, symbols: list[str] | None = None, available_now: bool = True,
    limit: int | None = None, zero_price: bool = False,
) -> StreamingQuery:
    """Store the raw messages of each micro-batch, then its events and its dead letters.

    With ``limit`` no more messages are let in than that; what comes after is left to another run.
    ``zero_price`` is the contract's.

    The batch is decoded once, from the capture just written: the source is read once and the
    message is on disk before it is interpreted, so a lost executor costs a re-read of the
    capture. Every folder is named by the batch, so a batch
    that is tried again after a failure overwrites its own output. What was decoded goes when the
    batch's events and dead letters are stored.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        received = F.current_timestamp()
        if limit is not None:
            batch = _admit(batch, batch_id, paths, limit)
        writers.capture_raw(batch, batch_id, paths.raw)
        captured = spark.read.schema(ENVELOPE).json(f"{paths.raw}/batch_id={batch_id}")
        messages = captured.select(
            F.lit(None).cast("binary").alias("key"),
            F.unbase64("value_base64").alias("value"),
            F.col("kafka_topic").alias("topic"),
            F.col("kafka_partition").cast("int").alias("partition"),
            F.col("kafka_offset").alias("offset"),
            F.lit(None).cast("timestamp").alias("timestamp"),
        )
        folder = f"{paths.raw.rsplit('/', 1)[0]}/decoded/batch_id={batch_id}"
        decode_message(messages, symbols, zero_price).write.mode("overwrite").parquet(folder)
        valid, invalid = route_invalid(spark.read.parquet(folder).drop("batch_id"))
        stamped = valid.withColumns({"consumer_received_at": received, "sink_requested_at": received})
        writers.append_events(stamped, batch_id, paths.valid, paths.run_id)
        writers.write_invalid(invalid.drop("key", "timestamp"), batch_id, paths.invalid)
        versions.remove(spark, folder)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", paths.checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def sink_rows(spark: SparkSession, paths: RunPaths) -> DataFrame:
    """Accepted events of a run; readable while the run goes on."""
    return spark.read.schema(RUN_EVENT).parquet(f"{paths.valid}/batch_id=*")


def raw_rows(spark: SparkSession, paths: RunPaths) -> DataFrame:
    return spark.read.schema(ENVELOPE).json(f"{paths.raw}/batch_id=*")


def dead_letters(spark: SparkSession, paths: RunPaths) -> DataFrame:
    return spark.read.parquet(f"{paths.invalid}/batch_id=*")


class IncompleteRun(RuntimeError):
    """A run that may not be published."""


def run_once(
    stream: DataFrame,
    paths: RunPaths,
    expected: int | None = None,
    symbols: list[str] | None = None,
    timeout: int | None = None,
) -> DataFrame:
    """Process what is there, then return the run's metrics as one row.

    Publication is refused when a record was invalid or the number of records is not the expected
    one, or when the deadline passed first.
    """
    if not stream.isStreaming:
        raise ValueError("run_once needs a stream")
    query = capture_then_process(stream, paths, symbols)
    query.awaitTermination(timeout)
    if query.isActive:
        query.stop()
        raise IncompleteRun("deadline passed")
    return _complete(stream.sparkSession, paths, expected)


def _complete(spark: SparkSession, paths: RunPaths, expected: int | None) -> DataFrame:
    metrics = metrics_of_run(spark, paths)
    counts = metrics.select("valid", "invalid").first()
    complete = counts is not None and (expected is None or counts.valid == expected)
    if not complete or counts.invalid:
        raise IncompleteRun("incomplete or invalid run; publication refused")
    return metrics


def run_bounded(
    stream: DataFrame, paths: RunPaths, limit: int, seconds: float, symbols: list[str] | None = None,
    pause: float = 0.2, zero_price: bool = False,
) -> StreamingQuery:
    """Take ``limit`` messages from every partition's earliest offset on, or stop at the deadline.

    The query goes on until its progress and its entries say that the limit is reached, that its source
    has nothing more to give and the deadline has passed, or that it failed. The source may hold more, and
    may get more while the query runs. Whether the run is complete is for ``bounded_metrics`` to say.
    """
    deadline = time.monotonic() + seconds
    query = capture_then_process(stream, paths, symbols, available_now=False, limit=limit, zero_price=zero_price)
    seen = -1
    while query.isActive and time.monotonic() < deadline:
        progress = query.lastProgress
        if progress is not None and progress.batchId != seen:
            seen = progress.batchId
            if admitted(stream.sparkSession, paths) >= limit:
                break
        query.awaitTermination(pause)
    if query.exception() is not None:
        raise query.exception()
    query.stop()
    return query


def bounded_metrics(spark: SparkSession, paths: RunPaths, limit: int) -> DataFrame:
    """Metrics of a bounded run as one row; refused unless exactly ``limit`` messages came and all are
    valid."""
    if admitted(spark, paths) != limit:
        raise IncompleteRun("fewer messages than asked for; publication refused")
    return _complete(spark, paths, limit)


def metrics_of_run(spark: SparkSession, paths: RunPaths) -> DataFrame:
    """Metrics of a finished run, from what it stored."""
    columns = ["event_id", "ingestion_mode", "ingested_at", "processed_at", "error"]
    valid = sink_rows(spark, paths).withColumnRenamed("sink_requested_at", "processed_at")
    valid = valid.withColumn("error", F.lit(None).cast("string")).select(*columns)
    refused = dead_letters(spark, paths).select(
        *[
            F.lit(None).cast("timestamp" if n.endswith("_at") else "string").alias(n)
            for n in columns[:-1]
        ],
        "error",
    )
    run = valid.unionByName(refused).withColumn("run_id", F.lit(paths.run_id))
    metrics = run_metrics(run)
    clean = (F.col("invalid") == 0) & (F.col("valid") > 0)
    return metrics.withColumn("status", F.when(clean, "passed").otherwise("failed"))


def dedup_newest(
    stream: DataFrame, delay: str = "2 hours", sink_time: str = "sink_requested_at", slot: str = "1 minute"
) -> DataFrame:
    """One row per run and event: the delivery with the newest sink time, then the highest offset.

    A delivery replaces the one that is held until the watermark, ``delay`` behind the newest event time,
    has passed the event's minute; then the row is given out and its state ends. State holds the events
    of ``delay``, however long the run; a delivery that comes later than that is dropped. Without a
    message beyond the end (``close_replay``) the events of the last ``delay`` are not given out yet.
    """
    newest = F.struct(F.col(sink_time), F.col("kafka_offset"))
    held = stream.withWatermark("event_timestamp", delay).groupBy(
        F.window("event_timestamp", slot).alias("_slot"), "demo_run_id", "event_id"
    ).agg(F.max_by(F.struct(*stream.columns), newest).alias("_row"))
    # A filter on a key would be applied before the watermark and hide a closing message from it.
    return held.where(F.col("_row.event_id").isNotNull()).select("_row.*")


def close_replay(spark: SparkSession, path: str, schema: T.StructType, after: str, columns: Mapping[str, Column] | None = None) -> None:
    """Add a message without an event, long after the last one, so that every window of a bounded replay
    is given out.

    ``after`` is its event time; all other columns are null but those in ``columns``.
    """
    values = {"event_timestamp": F.lit(after).cast("timestamp")} | dict(columns or {})
    row = spark.range(1).select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])
    row.write.mode("append").parquet(path)


def replay_messages(
    events: DataFrame, topic: str, partition: Column, offset: Column
) -> DataFrame:
    """Events as messages of the shape a topic delivers; ``timestamp`` is the event's time."""
    return events.select(
        F.col("symbol").cast("binary").alias("key"),
        event_json(events).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        F.col("event_timestamp").alias("timestamp"),
    )


FILE_ROWS = 250_000  # most rows of a file that a stream reads in order, but for uneven ranges


def write_in_order(rows: DataFrame, path: str, files: int, *order: str) -> int:
    """Rows as Parquet files in an order, ``files`` or as many as ``FILE_ROWS`` asks for.

    Each file is one range, sorted and written once by its own task beside the folder, so a task has as
    much to do however many rows there are. Then the files are moved in, in the order of their ranges and
    with rising modification times, by which a file stream reads them; no byte is written or read twice.
    Returns the number of files.
    """
    spark = rows.sparkSession
    beside = new_folder(spark, "replay_ranges")
    ranges = rows.repartitionByRange(max(files, -(-rows.count() // FILE_ROWS)), *order)
    ranges.sortWithinPartitions(*order).write.parquet(beside)
    parts = [name for name in versions.names(spark, beside) if name.startswith("part-")]
    versions.move_in_order(spark, beside, path, parts)
    return len(parts)


def write_replay(messages: DataFrame, path: str, files: int) -> int:
    """Messages as Parquet files of Kafka's shape in time order, ``files`` of them or more."""
    return write_in_order(messages, path, files, "timestamp", "offset")


def batch_files(spark: SparkSession, files: int) -> int:
    """Files for a micro-batch, of which there are two at least: one for each core, so that the size of a
    batch and of its tasks and state does not grow with the replay."""
    return max(1, min(files // 2, max(2, spark.sparkContext.defaultParallelism)))


def replay_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A written replay as a stream, a few files per micro-batch."""
    return stream_events(spark, path, files_per_trigger)


def minute_bars_stream(events: DataFrame, delay: str, bar_seconds: int = 60) -> DataFrame:
    """Last price of every symbol and bar as a stream; a bar is final once ``delay`` has passed."""
    latest = F.struct("event_timestamp", "ingested_at", "event_id")
    return (
        events.withWatermark("event_timestamp", delay)
        .groupBy(
            F.window("event_timestamp", f"{bar_seconds} seconds").alias("bar"),
            "symbol", "ingestion_mode", "record_type",
        )
        .agg(F.max_by("price_usd", latest).alias("price_usd"), F.max_by("event_id", latest).alias("event_id"))
        .select("symbol", "ingestion_mode", "record_type", F.col("bar.start").alias("minute_utc"),
                "price_usd", "event_id")
    )
