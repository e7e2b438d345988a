"""Versions behind a log, commits by partition, publication after a read back, and the batch journal."""

import json
import time
from pathlib import Path

import pytest
from helpers import fx_rows, ts
from pyspark.sql import functions as F
from test_plans import FIRST, SECOND, bars, document, rate_run

from fxtape import versions
from fxtape.operators import merge, quality
from fxtape.plans import rates, replay
from fxtape.plans.journal import Journal
from fxtape.schemas import FX_FACT, MARKET_EVENT
from fxtape.shared import new_folder
from fxtape.sinks import partitions, writers
from fxtape.sources import readers
from registry import messages as m

FIELDS = ("usd_idr", "source", "fx_available_at")


def commit(root, batch):
    return partitions.upsert(root, batch, merge.FX_KEYS, "ingested_at", FIELDS, quality.fx_invalid(), "jisdor_date", ["currency"])


def files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("part-*.parquet")}


def days(first, last, rate, hour="00"):
    return [(f"2026-09-{d:02}", rate + d, None, "USD", f"2026-09-28T{hour}:00:00") for d in range(first, last)]


def test_upsert_touches_only_its_dates(spark):
    root = new_folder(spark, "rates")
    commit(root, fx_rows(spark, days(1, 21, 100)))
    before = files(root)
    time.sleep(0.02)
    done = commit(root, fx_rows(spark, days(7, 8, 500, "01")))
    after = files(root)
    assert [str(v) for v in done.partitions] == ["2026-09-07"]
    assert {k for k in before if after.get(k) != before[k]} == {k for k in before if "2026-09-07" in k}
    assert {k for k in after if k not in before} == {k for k in after if "2026-09-07" in k and k not in before}
    table = partitions.stored_table(spark, root, FX_FACT)
    assert table.count() == 20 and table.where("usd_idr = 507").count() == 1
    assert {(r.change, r["rows"]) for r in done.changes.collect()} == {("update", 1)}
    plan = partitions.only(table, "jisdor_date", done.partitions)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(jisdor_date" in plan and "2026-09-07" in plan
    again = commit(root, fx_rows(spark, days(7, 8, 500, "01")))
    assert {(r.change, r["rows"]) for r in again.changes.collect()} == {("keep", 1)}


@pytest.mark.parametrize("fault", ["twice", "invalid", "undated", "contradicts"])
def test_refused_batches_leave_every_file(spark, fault):
    root = new_folder(spark, "rates")
    commit(root, fx_rows(spark, days(1, 5, 100)))
    before = files(root)
    batch = fx_rows(spark, days(3, 5, 200, "01"))
    batch = {
        "twice": batch.unionByName(batch),
        "invalid": batch.withColumn("usd_idr", F.lit(-1).cast("decimal(38,9)")),
        "undated": batch.withColumn("jisdor_date", F.expr("if(day(jisdor_date) = 3, null, jisdor_date)")),
        "contradicts": fx_rows(spark, days(3, 5, 200)),
    }[fault]
    with pytest.raises(versions.RefusedWrite):
        commit(root, batch)
    assert files(root) == before


def test_empty_batch_changes_nothing(spark):
    root = new_folder(spark, "rates")
    commit(root, fx_rows(spark, days(1, 3, 100)))
    before = files(root)
    assert commit(root, fx_rows(spark, []).select(*FX_FACT.names)).partitions == []
    assert files(root) == before


def test_merged_bars_count_changes_and_keep_dates(spark):
    root = new_folder(spark, "bars")
    schema = "day date, symbol string, bar_start_utc string, price_usd double"

    def rows_(dates, price):
        made = [(d, s, f"{d}T14:00:00+00:00", price) for d in dates for s in "AB"]
        return spark.createDataFrame(made, "day string, symbol string, bar_start_utc string, price_usd double").withColumn("day", F.to_date("day"))

    keys = ("day", "symbol", "bar_start_utc")
    partitions.merge_bars(root, rows_(["2026-09-01", "2026-09-02", "2026-09-03"], 1.0), keys, "day")
    before = files(root)
    mixed = rows_(["2026-09-03", "2026-09-04"], 1.0).withColumn("price_usd", F.expr("if(symbol = 'A', 2D, 1D)"))
    done = partitions.merge_bars(root, mixed, keys, "day")
    assert {(r.change, r["rows"]) for r in done.changes.collect()} == {("added", 2), ("revised", 1), ("unchanged", 1)}
    after = files(root)
    assert {k for k in before if k in after} == {k for k in before if "2026-09-03" not in k}
    assert partitions.stored_table(spark, root, spark.createDataFrame([], schema).schema).count() == 8
    with pytest.raises(ValueError, match="stop"):
        partitions.merge_bars(root, rows_(["2026-09-01"], 9.0), keys, "day", before=refuse)
    assert files(root) == after


def refuse(rows_):
    raise ValueError("stop")


def test_two_writers_one_wins(spark):
    root = new_folder(spark, "versions")
    writers.replace_snapshot(spark.range(2), root, "1")
    one = versions.stage(spark.range(3), root, "2")
    other = versions.stage(spark.range(4), root, "2")
    versions.publish(spark, root, one)
    with pytest.raises(versions.RefusedWrite, match="another version"):
        versions.publish(spark, root, other)
    assert readers.read_snapshot(spark, root).count() == 3
    # Both saw the same newest version; the entry's number can be taken once.
    with pytest.raises(versions.RefusedWrite, match="exists"):
        versions.write_small(spark, f"{root}/{versions.LOG}/{one.number:012d}.json", {})
    with pytest.raises(versions.RefusedWrite, match="newer"):
        writers.replace_snapshot(spark.range(1), root, "1")


def test_reader_opens_one_version_and_skips_an_unfinished_entry(spark):
    root = new_folder(spark, "versions")
    for n in range(1, 5):
        writers.replace_snapshot(spark.range(n), root, str(n))
    newest = readers.read_snapshot(spark, root)
    assert newest.count() == 4
    assert {Path(f).parent.name for f in newest.inputFiles()} == {versions.newest(spark, root).folder}
    Path(root, versions.LOG, f"{5:012d}.json").write_text("")
    assert versions.newest(spark, root).number == 4
    writers.replace_snapshot(spark.range(9), root, "5")
    assert (versions.newest(spark, root).number, readers.read_snapshot(spark, root).count()) == (6, 9)


def test_wrong_count_is_never_seen(spark):
    root = new_folder(spark, "versions")
    writers.replace_snapshot(spark.range(2), root, "1", expected=2)
    with pytest.raises(versions.RefusedWrite, match="expected"):
        writers.replace_snapshot(spark.range(3), root, "2", expected=4)
    assert readers.read_snapshot(spark, root).count() == 2
    assert readers.snapshot_or_empty(spark, new_folder(spark, "none"), FX_FACT).count() == 0


def test_old_versions_end(spark):
    root = new_folder(spark, "versions")
    for n in range(1, 5):
        writers.replace_snapshot(spark.range(n), root, str(n))
    versions.stage(spark.range(7), root, "2")
    staged = versions.stage(spark.range(8), root, "6")
    assert len(versions.expire(spark, root, keep=2)) == 3
    left = {name.split("-")[0] for name in versions.names(spark, root) if name != versions.LOG}
    assert left == {"3", "4", "6"}
    assert readers.read_snapshot(spark, root).count() == 4
    versions.publish(spark, root, staged)
    assert readers.read_snapshot(spark, root).count() == 8
    with pytest.raises(ValueError):
        versions.expire(spark, root, keep=0)


@pytest.fixture(scope="module")
def replayed(spark):
    """A run's capture, its events and its report."""
    stored = bars(spark, ["2026-09-10"], range(3))
    events = replay.bar_events(stored, F.lit("2026-09-17 00:00:00").cast("timestamp"))
    messages = replay.as_messages(events, "market")
    decoded = m.contract.decode_message(messages)
    valid, _ = m.contract.route_invalid(decoded)
    report = spark.createDataFrame([(12, 12, "passed", ["replay"])], "kafka_records long, valid long, status string, modes array<string>")
    return decoded.withColumn("event_date", F.col("event_date")), valid.select(*MARKET_EVENT.names), report


def damaged(how):
    def read(spark, root, version, schema=None):
        stored = plain_read(spark, root, version, schema)
        return {
            "lost": stored.where("symbol <> 'JPM'"),
            "changed": stored.withColumn("price_usd", F.expr("if(symbol = 'JPM', price_usd + 1, price_usd)")),
            "twice": stored.unionByName(stored.where("symbol = 'JPM'")),
        }[how]

    return read


plain_read = versions.read


@pytest.mark.parametrize("how", ["lost", "changed", "twice"])
def test_damaged_staged_version_is_refused(spark, replayed, how, monkeypatch):
    captured, valid, report = replayed
    table = new_folder(spark, "market")
    replay.publish_checked(captured, valid, report, table, "1", *writers.MARKET_LAYOUT)
    monkeypatch.setattr(versions, "read", damaged(how))
    with pytest.raises(rates.RefusedBatch, match="reconcile"):
        replay.publish_checked(captured, valid, report, table, "2", *writers.MARKET_LAYOUT)
    monkeypatch.undo()
    assert versions.newest(spark, table).name == "1"
    assert [n for n in versions.names(spark, table) if n.startswith("2-")] == []
    assert readers.read_snapshot(spark, table, MARKET_EVENT).count() == 12


def test_report_must_agree(spark, replayed):
    captured, valid, report = replayed
    for wrong in ({"kafka_records": F.lit(13)}, {"status": F.lit("failed")}, {"modes": F.array(F.lit("live_websocket"))}):
        table = new_folder(spark, "market")
        with pytest.raises(rates.RefusedBatch):
            replay.publish_checked(captured, valid, report.withColumns(wrong), table, "1", *writers.MARKET_LAYOUT)
        assert versions.newest(spark, table) is None


class Killed(BaseException):
    pass


def test_killed_batch_ends_like_an_undisturbed_one(spark, tmp_path, monkeypatch):
    """Killed at every step in turn, before its work and between its work and its entry."""
    path, sha = document(tmp_path, "a.xml", [("2026-09-10", "16000"), ("2026-09-11", "16100.5")])
    second, sha2 = document(tmp_path, "b.xml", [("2026-09-11", "16200"), ("2026-09-14", "16300")])

    def runs(folder):
        folder.mkdir()
        return rate_run(folder, FIRST, path, sha), rate_run(folder, SECOND, second, sha2)

    plain = runs(tmp_path / "plain")
    for run in plain:
        _, report = rates.rate_batch(spark, run, "2026-09-14")
    want = sorted(map(tuple, rates.current_rates(spark, plain[0].table).collect()))
    told = [tuple(r) for r in report.collect()]

    run_one, run_two = runs(tmp_path / "killed")
    rates.rate_batch(spark, run_one, "2026-09-14")
    entries = {when: getattr(Journal, when) for when in ("begun", "done")}
    for step in rates.STEPS:
        for when, written in entries.items():
            def kill(self, name, *result, step=step, when=when, written=written):
                if when == "begun":
                    written(self, name, *result)
                if name == step:
                    raise Killed(step)
                if when == "done":
                    written(self, name, *result)

            monkeypatch.setattr(Journal, when, kill)
            with pytest.raises(Killed):
                rates.rate_batch(spark, run_two, "2026-09-14")
            monkeypatch.undo()
            assert Journal(spark, f"{run_two.landing}-journal", SECOND).state(step) == "begun"
    gate, report = rates.rate_batch(spark, run_two, "2026-09-14")
    assert sorted(map(tuple, rates.current_rates(spark, run_two.table).collect())) == want
    assert [tuple(r) for r in report.collect()] == told
    assert gate.first().accepted is True and gate.first().total_rows == 3


def test_lost_manifest_is_written_again(spark, tmp_path):
    path, sha = document(tmp_path, "a.xml", [("2026-09-10", "16000")])
    run = rate_run(tmp_path, FIRST, path, sha)
    rates.rate_batch(spark, run, "2026-09-12")
    journal = Journal(spark, f"{run.landing}-journal", FIRST)
    for step in ("manifest", "verify", "merge", "report"):
        versions.remove(spark, journal.place(step))
        versions.remove(spark, f"{journal.folder}/{step}.done.json")
    gate, _ = rates.rate_batch(spark, run, "2026-09-12")
    assert gate.first().total_rows == 1


def test_published_run_has_its_manifest(spark, tmp_path):
    stored = bars(spark, ["2026-09-10"], range(2))
    root, table = new_folder(spark, "replay"), new_folder(spark, "market")
    replay.replay_and_publish(spark, stored, F.lit("2026-09-17 00:00:00").cast("timestamp"), root, table, FIRST)
    listed = readers.read_manifest(spark, f"{root}/manifests/run_id={FIRST}")
    folder = versions.newest(spark, table).folder
    on_disk = {p.name for p in Path(table, folder).rglob("part-*")}
    assert on_disk <= {r.name.rsplit("/", 1)[-1] for r in listed.collect()}
    assert {r.records for r in listed.collect()} == {8}
    assert json.loads(Path(table, versions.LOG, f"{1:012d}.json").read_text())["rows"] == 8
    assert ts("2026-09-10T00:00:00").date() in {r.event_date for r in readers.read_snapshot(spark, table, MARKET_EVENT).collect()}
