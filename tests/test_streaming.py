from pathlib import Path

import pytest
from helpers import ts
from pyspark.sql import functions as F

from fxtape.operators import rows
from fxtape.shared import new_folder
from fxtape.streaming import ingest
from fxtape.versions import RefusedWrite
from registry import messages as m

RUN = "20260909T214210877646Z"


def finished(spark, sf_dir, broken, expected=None):
    paths = ingest.run_paths(new_folder(spark, "runs"), RUN)
    return ingest.run_once(m._stream(spark, sf_dir, broken), paths, expected, m.SYMBOLS), paths


def test_clean_run_passes(spark, sf_dir):
    n = m.table(spark, sf_dir, "events").count()
    metrics, paths = finished(spark, sf_dir, False, n)
    row = metrics.first()
    assert (row.valid, row.invalid, row.status, row.modes) == (n, 0, "passed", ["replay"])
    assert row.unique_event_ids == n
    assert row.first_processed_at <= row.last_processed_at
    batch, _ = ingest.process_events(m.messages(spark, sf_dir, False), m.SYMBOLS)
    stored = ingest.sink_rows(spark, paths).select(*batch.columns)
    assert stored.exceptAll(batch).isEmpty() and batch.exceptAll(stored).isEmpty()
    deduplicated = rows.dedup_run_events(ingest.sink_rows(spark, paths))
    assert deduplicated.count() == n


def test_incomplete_or_invalid_run_is_refused(spark, sf_dir):
    with pytest.raises(ingest.IncompleteRun):
        finished(spark, sf_dir, True)
    with pytest.raises(ingest.IncompleteRun):
        finished(spark, sf_dir, False, 1)


def test_rerun_of_a_finished_stream_adds_nothing(spark, sf_dir):
    folder = new_folder(spark, "replay")
    ingest.write_replay(m.messages(spark, sf_dir, False), folder, 2)
    paths = ingest.run_paths(new_folder(spark, "runs"), RUN)
    for _ in range(2):
        stream = ingest.replay_stream(spark, folder, 1)
        ingest.capture_then_process(stream, paths, m.SYMBOLS).awaitTermination()
    assert ingest.sink_rows(spark, paths).count() == m.table(spark, sf_dir, "events").count()


DELIVERY = "demo_run_id string, event_id string, event_timestamp timestamp, sink_requested_at timestamp, kafka_offset long, n int"


def deliveries(spark, batches):
    """A folder with a file per batch, read a file at a time."""
    source = new_folder(spark, "source")
    for batch in batches:
        made = [("r", e, ts(f"2024-01-01T{t}:00"), ts(f"2024-01-01T{sink}:00"), o, n) for e, t, sink, o, n in batch]
        spark.createDataFrame(made, DELIVERY).coalesce(1).write.mode("append").parquet(source)
    return source


def test_stream_dedup_keeps_the_newest_delivery(spark):
    source = deliveries(spark, [
        [("a", "00:00", "01:00", 5, 0), ("b", "00:10", "01:10", 6, 1), ("b", "00:10", "01:10", 7, 2)],
        [("a", "00:00", "00:30", 9, 3), ("c", "00:20", "01:20", 8, 4)],
        [("a", "00:00", "01:30", 10, 5)],
        [("d", "09:00", "09:10", 11, 6)],
        [("e", "09:30", "09:40", 12, 7)],
        [("a", "00:00", "09:50", 13, 8)],
    ])
    schema = spark.createDataFrame([], DELIVERY).schema
    everything = spark.read.parquet(source)
    ingest.close_replay(spark, source, schema, "2030-01-01 00:00:00")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        ingest.dedup_newest(stream, "2 hours").writeStream.format("memory").queryName("newest")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {r.event_id: r.n for r in spark.table("newest").collect()}
    # The last delivery of a comes nine hours late, when its state has ended.
    assert got == {"a": 5, "b": 2, "c": 4, "d": 6, "e": 7}
    in_time = rows.dedup_run_events(everything.where("n < 8"))
    assert {r.event_id: r.n for r in in_time.collect()} == got
    kept = [s["numRowsTotal"] for p in query.recentProgress for s in p.stateOperators]
    assert max(kept) <= 4 and kept[-1] <= 1


def test_bounded_run_stops_at_its_limit(spark, sf_dir):
    source, stored = new_folder(spark, "topic"), m.messages(spark, sf_dir, False)
    ingest.write_replay(stored, source, 4)
    n = stored.count()
    for limit in (1, n // 2, n):
        paths = ingest.run_paths(new_folder(spark, "runs"), RUN)
        query = ingest.run_bounded(ingest.replay_stream(spark, source, 1), paths, limit, 300, m.SYMBOLS)
        assert not query.isActive
        assert ingest.admitted(spark, paths) == limit == ingest.raw_rows(spark, paths).count()
        assert ingest.bounded_metrics(spark, paths, limit).first().valid == limit
        captured = {(r.kafka_partition, r.kafka_offset) for r in ingest.raw_rows(spark, paths).collect()}
        assert len(captured) == limit


def test_bounded_run_ends_at_its_deadline(spark, sf_dir):
    source, stored = new_folder(spark, "topic"), m.messages(spark, sf_dir, False)
    ingest.write_replay(stored, source, 2)
    paths = ingest.run_paths(new_folder(spark, "runs"), RUN)
    query = ingest.run_bounded(ingest.replay_stream(spark, source, 2), paths, 10**9, 20, m.SYMBOLS)
    assert not query.isActive
    with pytest.raises(ingest.IncompleteRun, match="fewer"):
        ingest.bounded_metrics(spark, paths, 10**9)


def test_batch_that_is_tried_again_lets_the_same_messages_in(spark, sf_dir):
    paths = ingest.run_paths(new_folder(spark, "runs"), RUN)
    batch = m.messages(spark, sf_dir, False)
    first = {r.offset for r in ingest._admit(batch.where("offset < 500"), 0, paths, 600).collect()}
    again = [{r.offset for r in ingest._admit(batch.where("offset >= 500"), 1, paths, 600).collect()} for _ in range(2)]
    assert again[0] == again[1] and len(first) + len(again[0]) == 600
    assert ingest._admit(batch.where("offset >= 500"), 2, paths, 600).count() == 0


def test_replay_refuses_a_folder_that_is_there(spark, sf_dir):
    folder = new_folder(spark, "replay")
    batch = m.messages(spark, sf_dir, False)
    ingest.write_replay(batch, folder, 2)
    with pytest.raises(RefusedWrite):
        ingest.write_replay(batch, folder, 2)


def test_replay_files_are_in_time_order(spark, sf_dir):
    folder = new_folder(spark, "replay")
    ingest.write_replay(m.messages(spark, sf_dir, False), folder, 3)
    spans = (
        spark.read.parquet(folder).groupBy(F.input_file_name().alias("file"))
        .agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).orderBy("lo").collect()
    )
    assert len(spans) == 3
    assert all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))
    written = [Path(s.file.removeprefix("file://")).stat().st_mtime_ns for s in spans]
    assert written == sorted(written), "a file stream reads by modification time"
