"""Rates, upsert, archive, sinks and sources on literal fixtures."""

import json
from datetime import date
from decimal import Decimal

import duckdb
import pytest
from helpers import fx_rows, ts
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.operators import bars, merge, quality, reports, rows
from fxtape.schemas import FX_DOCUMENT, FX_FACT, FX_RECORD_TEXT, conform
from fxtape.shared import new_folder
from fxtape.sinks import writers
from fxtape.sources import readers

RUN = "20260909T214210877646Z"


def document(spark, *entries):
    return readers.normalise_fx(spark.createDataFrame(list(entries), FX_DOCUMENT))


def test_normalised_rate(spark):
    row = document(spark, ("2026-09-15T17:00:00Z", " usd ", "16000.25")).first()
    assert row.asDict() == {
        "jisdor_date": date(2026, 9, 16), "currency": "USD", "usd_idr": Decimal("16000.250000000"),
    }
    local = document(spark, ("2026-09-15T20:00:00", "USD", "1"), ("2026-09-15T20:00:00+07:00", "USD", "1"))
    assert {r.jisdor_date for r in local.collect()} == {date(2026, 9, 15)}


@pytest.mark.parametrize(
    "entries",
    [
        [("bad", "USD", "16000")],
        [("2026-09-16", "USD", "NaN")],
        [("2026-09-16", "USD", "-1")],
        [("2026-09-16", "EUR", "16000")],
        [],
        [("2026-09-16", "USD", "16000")] * 2,
    ],
)
def test_bad_batches_are_refused(spark, entries):
    assert quality.check_fx_batch(document(spark, *entries)).first().accepted is False


def test_good_batch_is_accepted(spark):
    good = document(spark, ("2026-09-16", "USD", "16000"), ("2026-09-17", "USD", "16001"))
    assert quality.check_fx_batch(good).first().accepted is True


RECORD = {
    "jisdor_date": "2026-09-09", "currency": "USD", "usd_idr": "17552", "source": "url",
    "ingested_at": "2026-09-09T21:00:00+00:00", "fx_available_at": None,
}


RECORDS = [
    ({}, None),
    ({"usd_idr": "17552.123456789"}, None),
    ({"usd_idr": "0"}, "rate"),
    ({"usd_idr": "-1"}, "rate"),
    ({"usd_idr": "NaN"}, "rate"),
    ({"usd_idr": "Infinity"}, "rate"),
    ({"usd_idr": "1e30"}, "rate"),
    ({"usd_idr": "1.0000000001"}, "rate"),
    ({"ingested_at": "2026-09-09T21:00:00"}, "ingested_at"),
    ({"fx_available_at": "2026-09-09T21:00:00"}, "fx_available_at"),
    ({"jisdor_date": "09/09/2026"}, "date"),
    ({"currency": "EUR"}, "currency"),
    ({"source": ""}, "source"),
]


def test_record_rules(spark):
    frame = spark.createDataFrame([RECORD | changes for changes, _ in RECORDS], FX_RECORD_TEXT)
    found = quality.check_fx_record(frame.coalesce(1)).collect()
    assert [r.error for r in found] == [error for _, error in RECORDS]


def test_interval(spark):
    fx = fx_rows(spark, [("2026-09-01", 1, None), ("2026-09-05", 1, None)])
    assert [r.jisdor_date for r in quality.outside_interval(fx, "2026-09-02", "2026-09-30").collect()] == [
        date(2026, 9, 1)
    ]
    for start, end in (("2026-09-02", "2026-09-01"), ("2025-01-01", "2026-09-01")):
        with pytest.raises(ValueError):
            quality.outside_interval(fx, start, end)


def test_xml_namespaces_and_depth(spark, tmp_path):
    row = "<Table><tgl_subkursasing>2026-09-16</tgl_subkursasing><mts_subkursasing>USD</mts_subkursasing><jual_subkursasing>1</jual_subkursasing></Table>"
    (tmp_path / "a.xml").write_text(f'<r xmlns="urn:x"><d><e>{row}</e>{row}</d></r>')
    prefixed = row.replace("<", "<d:").replace("<d:/", "</d:")
    (tmp_path / "b.xml").write_text(f'<r xmlns:d="urn:x"><d:s>{prefixed}</d:s></r>')
    assert readers.read_fx_xml(spark, str(tmp_path / "a.xml")).count() == 2
    assert readers.read_fx_xml(spark, str(tmp_path / "b.xml")).count() == 1
    (tmp_path / "c.xml").write_text(f"<r>{row[:-8]}</r>")
    with pytest.raises(Exception):  # noqa: B017
        readers.read_fx_xml(spark, str(tmp_path / "c.xml")).collect()


def test_coverage_labels(spark):
    fx = fx_rows(spark, [("2026-09-10", 1, None), ("2026-09-11", 2, None), ("2026-09-11", 3, None)])
    coverage = {r.calendar_date.isoformat(): r for r in quality.date_coverage(fx, "2026-09-15").collect()}
    assert [coverage[f"2026-09-{d}"].coverage_status for d in range(10, 16)] == [
        "available", "duplicate", "weekend_no_record", "weekend_no_record",
        "weekday_missing_unverified", "today_not_available_yet",
    ]
    frame = quality.date_coverage(fx, "2026-09-15")
    report = quality.coverage_report(frame).first()
    assert report.status == "failed" and report.duplicate_dates == ["2026-09-11"]
    single = quality.date_coverage(fx_rows(spark, [("2026-09-10", 1, None)]), "2026-09-15")
    assert quality.coverage_report(single).first().status == "passed"
    published = fx_rows(spark, [("2026-09-10", 1, None), ("2026-09-14", 1, None)])
    lost = quality.coverage_report(single, published).first()
    assert lost.status == "failed"
    assert lost.confirmed_missing_published_dates == ["2026-09-14"]


def test_merge_updates_only_newer_rows(spark):
    target = fx_rows(spark, [
        ("2026-09-01", 1, None, "USD", "2026-09-10T00:00:00"),
        ("2026-09-02", 1, None, "USD", "2026-09-10T00:00:00"),
        ("2026-09-03", 1, None, "USD", "2026-09-10T00:00:00"),
    ])
    staged = fx_rows(spark, [
        ("2026-09-01", 2, None, "USD", "2026-09-11T00:00:00"),
        ("2026-09-02", 2, None, "USD", "2026-09-10T00:00:00"),
        ("2026-09-03", 2, None, "USD", "2026-09-09T00:00:00"),
        ("2026-09-04", 2, None, "USD", "2026-09-11T00:00:00"),
    ])
    merged = merge.merge_latest(target, staged)
    conform(merged, FX_FACT)
    assert {r.jisdor_date.day: int(r.usd_idr) for r in merged.collect()} == {1: 2, 2: 1, 3: 1, 4: 2}
    # Equal time with another rate does not reconcile; an older staged row does.
    left = merge.merge_mismatches(staged, merged)
    assert [r.jisdor_date.day for r in left.collect()] == [2]
    _, gate = merge.merge_checked(target, staged, quality.fx_invalid())
    assert gate.first().mismatches == 1 and gate.first().accepted is False
    again = merge.merge_latest(merged, staged.where("day(jisdor_date) <> 2"))
    assert again.exceptAll(merged).isEmpty() and merged.exceptAll(again).isEmpty()
    clean = staged.where("day(jisdor_date) <> 2")
    assert merge.merge_checked(target, clean, quality.fx_invalid())[1].first().accepted is True


def test_merge_equals_literal_sql_on_random_data(spark):
    import random

    rng = random.Random(11)
    sides = []
    for _ in range(2):
        keys = rng.sample(range(1, 200), 120)
        sides.append([(k, rng.randint(1, 5), rng.randint(1, 99)) for k in keys])
    target, staged = [spark.createDataFrame(s, "k long, v long, x long") for s in sides]
    got = {tuple(r) for r in merge.merge_latest(target, staged, ["k"], "v").collect()}
    duck = duckdb.connect()
    for name, side in zip("ts", sides):
        duck.execute(f"CREATE TABLE {name} (k BIGINT PRIMARY KEY, v BIGINT, x BIGINT)")
        duck.executemany(f"INSERT INTO {name} VALUES (?, ?, ?)", side)
    duck.execute("INSERT INTO t SELECT * FROM s ON CONFLICT (k) DO UPDATE SET v = excluded.v, x = excluded.x WHERE excluded.v > v")
    assert got == set(duck.execute("SELECT * FROM t").fetchall())


BARS = "symbol string, bar_start_utc string, price_usd double"


def archive(spark, *rows_):
    return spark.createDataFrame(list(rows_), BARS)


def test_archive_merge(spark):
    t = "2026-09-10T13:30:00+00:00"
    four = [(s, t, 100.0) for s in c.SYMBOLS]
    empty = archive(spark, *four).where("false")
    added = merge.merge_archive(empty, archive(spark, *four))
    assert merge.archive_counts(added).first().asDict() == {"total": 4, "added": 4, "revised": 0}
    same = merge.merge_archive(archive(spark, four[0]), archive(spark, four[0]))
    assert merge.archive_counts(same).first().asDict() == {"total": 1, "added": 0, "revised": 0}
    incoming = archive(spark, ("JPM", t, 101.0), ("JPM", "2026-09-11T13:30:00+00:00", 102.0))
    both = merge.merge_archive(archive(spark, four[0]), incoming)
    assert merge.archive_counts(both).first().asDict() == {"total": 2, "added": 1, "revised": 1}
    assert rows.time_ordered(both).first().price_usd == 101.0
    twice = archive(spark, four[0], four[0])
    assert quality.duplicate_keys(twice, merge.BAR_KEY).count() == 1


def test_latest_sessions_and_window(spark):
    days = [10, 11, 14, 15, 16, 17]
    data = [(s, ts(f"2026-09-{d}T14:00:00")) for d in days for s in c.SYMBOLS]
    frame = spark.createDataFrame(data, "symbol string, bar_start timestamp")
    window = bars.latest_sessions(frame, 5)
    assert window.count() == 20
    assert window.agg(F.min("bar_start")).first()[0].day == 11
    assert bars.window_violations(window).first().accepted is True
    without = bars.window_violations(window.where("symbol <> 'GS'")).first()
    assert (without.absent_symbols, without.accepted) == (1, False)


def test_overlap_and_staleness(spark):
    data = [("A", ts(f"2026-09-10T0{h}:00:00")) for h in range(0, 5)]
    data += [("B", ts(f"2026-09-10T0{h}:00:00")) for h in range(2, 8)]
    frame = spark.createDataFrame(data, "symbol string, bar_start timestamp")
    aligned = bars.align_overlap(frame)
    assert aligned.groupBy("symbol").count().where("count <> 3").isEmpty()
    apart = frame.where("symbol = 'A' AND hour(bar_start) < 2 OR symbol = 'B'")
    assert bars.align_overlap(apart).isEmpty()
    a, b = frame.where("symbol = 'A'"), frame.where("symbol = 'B'")
    assert bars.is_stale(a, b).first().stale is True
    assert bars.is_stale(b, a).first().stale is False
    assert bars.is_stale(b, a.where("false")).first().stale is False


def test_write_once(spark):
    path = new_folder(spark, "once")
    one = spark.range(10)
    assert writers.write_once(one, path) == "uploaded"
    assert writers.write_once(one.repartition(3), path) == "already_present"
    with pytest.raises(writers.RefusedWrite):
        writers.write_once(spark.range(11), path)
    assert spark.read.parquet(path).count() == 10


def test_stage_counts(spark):
    with pytest.raises(writers.RefusedWrite):
        writers.stage(spark.range(0), new_folder(spark, "stage"), 1)
    with pytest.raises(writers.RefusedWrite):
        writers.stage(spark.range(2), new_folder(spark, "stage"), 3)
    assert writers.stage(spark.range(3), new_folder(spark, "stage"), 3) == 3


def test_snapshot_shows_newest_version(spark):
    root = new_folder(spark, "snapshots")
    writers.replace_snapshot(spark.range(3), root, "20260101T000000000000Z")
    writers.replace_snapshot(spark.range(5), root, "20260102T000000000000Z", expected=5)
    assert readers.read_snapshot(spark, root).count() == 5


def test_processed_json_refuses_other_content(spark):
    root = new_folder(spark, "processed")
    frame = spark.createDataFrame([RECORD], FX_RECORD_TEXT)
    assert writers.write_fx_processed(frame, root, RUN) == 1
    assert writers.write_fx_processed(frame, root, RUN) == 0
    other = frame.withColumn("usd_idr", F.lit("1"))
    with pytest.raises(writers.RefusedWrite):
        writers.write_fx_processed(other, root, RUN)
    assert writers.write_fx_processed(other, root, "20260910T214210877646Z") == 1


def landed(spark, tmp_path, tamper=None):
    frame = spark.createDataFrame(
        [RECORD, RECORD | {"jisdor_date": "2026-09-08", "usd_idr": "17000"}], FX_RECORD_TEXT
    )
    root, manifest = str(tmp_path / "root"), str(tmp_path / "manifest")
    writers.write_fx_processed(frame, f"{root}/processed", RUN)
    writers.write_manifest(spark, root, manifest, RUN, "url", 2)
    if tamper:
        tamper(tmp_path / "root")
    good, violations = readers.read_manifested(spark, manifest, root, RUN)
    return good, sorted(v.problem for v in violations.collect())


def test_manifest_round_trip(spark, tmp_path):
    good, problems = landed(spark, tmp_path)
    assert problems == []
    conform(good, FX_FACT)
    assert sorted(int(r.usd_idr) for r in good.collect()) == [17000, 17552]


def test_manifest_notices_changed_bytes(spark, tmp_path):
    def tamper(root):
        for file in root.glob("processed/date=2026-09-09/*/*.json"):
            text = file.read_text().replace("17552", "17553")
            file.write_text(text)
            for crc in file.parent.glob(".*.crc"):
                crc.unlink()

    _, problems = landed(spark, tmp_path, tamper)
    assert problems == ["digest"]


def test_manifest_notices_absent_files(spark, tmp_path):
    def tamper(root):
        for file in root.glob("processed/date=2026-09-09/*/*.json"):
            file.unlink()

    _, problems = landed(spark, tmp_path, tamper)
    assert problems == ["absent"]


def test_manifest_of_another_run(spark, tmp_path):
    landed(spark, tmp_path)
    _, violations = readers.read_manifested(
        spark, str(tmp_path / "manifest"), str(tmp_path / "root"), "20260101T000000000000Z"
    )
    assert {v.problem for v in violations.collect()} == {"foreign_manifest"}


def test_one_pretty_printed_manifest(spark, tmp_path):
    body = {"run_id": RUN, "records": 0, "source": "url", "objects": []}
    (tmp_path / "manifest.json").write_text(json.dumps(body, indent=2))
    rows_ = readers.read_manifest(spark, str(tmp_path / "manifest.json"), multiline=True).collect()
    assert len(rows_) == 1 and rows_[0].name is None


def test_exports(spark, sf_dir):
    path = new_folder(spark, "json")
    frame = spark.createDataFrame([("<b>", 1.5)], "t string, x double")
    writers.export_json(frame, path, {"source": "s"})
    assert spark.read.text(f"{path}/rows").first().value == '{"t":"\\u003cb>","x":1.5}'
    with pytest.raises(Exception, match="not finite"):
        bad = spark.createDataFrame([(float("nan"),)], "x double")
        writers.export_json(bad, new_folder(spark, "json"), {"source": "s"})
    mart = spark.range(20).withColumn("ingestion_mode", F.lit("replay"))
    assert writers.export_checked(mart, new_folder(spark, "csv"), ["id"], 20) == 20
    for refused in (mart.where("false"), mart.withColumn("ingestion_mode", F.lit("live"))):
        with pytest.raises(writers.RefusedWrite):
            writers.export_checked(refused, new_folder(spark, "csv"), ["id"])
    with pytest.raises(writers.RefusedWrite):
        writers.export_checked(mart, new_folder(spark, "csv"), ["id"], 19)


def test_row_checks(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert [r.k for r in quality.unique(frame, ["k"]).collect()] == [1]
    assert quality.not_null(frame, "v").count() == 1
    assert [r.v for r in quality.accepted(frame, "v", ["a"]).collect()] == ["b"]
    parent = spark.createDataFrame([("a",)], "v string")
    assert [r.v for r in quality.relationship(frame, "v", parent, "v").collect()] == ["b"]
    assert quality.is_empty(frame.where("false")).first().row_count == 0
    assert quality.is_empty(frame).isEmpty()
    assert rows.same_ids(frame, frame, "k").first().same is True
    runs = spark.createDataFrame([(RUN,), ("x",), (None,)], "source_run_id string")
    assert quality.bad_run_ids(runs).count() == 2


def test_fx_audit_and_readiness_of_empty_tables(spark):
    fx = fx_rows(spark, [("2026-09-01", 1, None)])
    assert reports.fx_audit(fx).first().asDict()["invalid"] == 0
    assert reports.fx_audit(fx.where("false")).first().row_count == 0


@pytest.mark.parametrize("side", ["target", "staged"])
def test_merges_refuse_repeated_keys(spark, side):
    once = spark.createDataFrame([("a", 1, "x")], "k string, v int, w string")
    twice = spark.createDataFrame([("a", 2, "y"), ("a", 3, "z")], "k string, v int, w string")
    left, right = (twice, once) if side == "target" else (once, twice)
    for merged in (merge.merge_latest(left, right, ["k"], "v"), merge.merge_archive(left, right, ["k"])):
        with pytest.raises(Exception, match="repeated key"):
            merged.collect()
