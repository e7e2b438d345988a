import hashlib
from datetime import timedelta

import pytest
from helpers import fx_rows, ts
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.operators import valuation
from fxtape.plans import archive, audit, marts, rates, replay
from fxtape.rules import MarketRules
from fxtape.schemas import BAR, MARKET_EVENT
from fxtape.shared import new_folder
from fxtape.sources import readers

FIRST, SECOND = "20260911T110000000000Z", "20260914T110000000000Z"


def document(tmp_path, name, entries):
    rows = "".join(
        f"<Table><tgl_subkursasing>{d}</tgl_subkursasing><mts_subkursasing>USD </mts_subkursasing>"
        f"<jual_subkursasing>{r}</jual_subkursasing></Table>" for d, r in entries
    )
    path = tmp_path / name
    path.write_text(f'<DataSet xmlns="urn:x"><NewDataSet>{rows}</NewDataSet></DataSet>')
    return str(path), hashlib.sha256(path.read_bytes()).hexdigest()


def rate_run(tmp_path, run_id, path, sha, interval=None):
    return rates.RateRun(
        run_id, path, sha, "bank", str(tmp_path / "landing"), str(tmp_path / "table"), interval
    )


def test_rate_batch_and_revision(spark, tmp_path):
    path, sha = document(tmp_path, "a.xml", [("2026-09-10", "16000"), ("2026-09-11", "16100.5")])
    gate, report = rates.rate_batch(spark, rate_run(tmp_path, FIRST, path, sha), "2026-09-12")
    assert gate.first().total_rows == 2 and report.first().status == "passed"
    path, sha = document(tmp_path, "b.xml", [("2026-09-11", "16200"), ("2026-09-14", "16300")])
    run = rate_run(tmp_path, SECOND, path, sha, ("2026-09-11", "2026-09-14"))
    rates.rate_batch(spark, run, "2026-09-14")
    table = {r.jisdor_date.day: (float(r.usd_idr), r.source_run_id)
             for r in rates.current_rates(spark, run.table).collect()}
    assert table == {10: (16000.0, FIRST), 11: (16200.0, SECOND), 14: (16300.0, SECOND)}
    again, _ = rates.rate_batch(spark, run, "2026-09-14")
    assert again.first().total_rows == 3


def test_rate_batch_refusals(spark, tmp_path):
    path, sha = document(tmp_path, "a.xml", [("2026-09-10", "16000")])
    with pytest.raises(rates.RefusedBatch, match="bytes"):
        rates.rate_batch(spark, rate_run(tmp_path, FIRST, path, "0" * 64), "2026-09-12")
    with pytest.raises(rates.RefusedBatch, match="interval"):
        run = rate_run(tmp_path, FIRST, path, sha, ("2026-09-11", "2026-09-12"))
        rates.rate_batch(spark, run, "2026-09-12")
    path, sha = document(tmp_path, "b.xml", [("2026-09-10", "-1")])
    with pytest.raises(rates.RefusedBatch, match="invalid"):
        rates.rate_batch(spark, rate_run(tmp_path, FIRST, path, sha), "2026-09-12")


def bars(spark, days, prices=range(20), symbols=c.SYMBOLS):
    rows = []
    for day in days:
        for i, price in enumerate(prices):
            for k, symbol in enumerate(symbols):
                start = ts(f"{day}T14:00:00") + timedelta(minutes=i)
                rows.append((symbol, start.isoformat(), 100.0 + k + price % 5, 10, "yfinance",
                             "1m", "historical_bar", "USD"))
    return spark.createDataFrame(rows, BAR)


def test_archive_refresh(spark, tmp_path):
    roots = str(tmp_path / "archive"), str(tmp_path / "active")
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    days = ["2026-09-10", "2026-09-11", "2026-09-14", "2026-09-15", "2026-09-16"]
    bars(spark, days, range(2)).write.json(first)
    counts = archive.refresh_archive(spark, first, *roots, FIRST, "2026-09-18 00:00:00").first()
    assert (counts.total, counts.added, counts.revised) == (40, 40, 0)
    newer = bars(spark, ["2026-09-16", "2026-09-17"], range(2))
    changed = F.when(F.col("symbol") == "JPM", F.col("price_usd") + 1).otherwise(F.col("price_usd"))
    newer.withColumn("price_usd", changed).write.json(second)
    counts = archive.refresh_archive(spark, second, *roots, SECOND, "2026-09-18 00:00:00").first()
    assert (counts.total, counts.added, counts.revised) == (48, 8, 2)
    active = readers.read_snapshot(spark, roots[1], BAR)
    assert active.count() == 40
    assert active.agg(F.min("bar_start_utc")).first()[0].startswith("2026-09-11")
    with pytest.raises(rates.RefusedBatch, match="older"):
        archive.refresh_archive(spark, first, *roots, SECOND, "2026-09-18 00:00:00")


def test_archive_refuses_bad_bars(spark, tmp_path):
    good = bars(spark, ["2026-09-10"], range(1))
    for name, bad in {
        "twice": good.unionByName(good),
        "currency": good.withColumn("currency", F.lit("EUR")),
        "price": good.withColumn("price_usd", F.lit(0.0)),
    }.items():
        path = str(tmp_path / name)
        bad.write.json(path)
        with pytest.raises(rates.RefusedBatch):
            archive.refresh_archive(
                spark, path, str(tmp_path / "a"), str(tmp_path / "b"), FIRST, "2026-09-18 00:00:00"
            )


def test_replay_to_marts_and_exports(spark, tmp_path):
    stored = bars(spark, ["2026-09-10"])
    received = F.lit("2026-09-17 00:00:00").cast("timestamp")
    table = str(tmp_path / "market")
    metrics, gate = replay.replay_and_publish(
        spark, stored, received, new_folder(spark, "replay"), table, FIRST
    )
    assert metrics.first().valid == 80 and gate.first().accepted is True
    market = readers.read_snapshot(spark, table, MARKET_EVENT)
    assert market.count() == 80
    fx = fx_rows(spark, [("2026-09-09", 16000, None)])
    chain = marts.Marts(market, fx, valuation.dim_stock(spark), MarketRules())
    ready, exported = audit.audit_and_export(chain, str(tmp_path / "out"), FIRST)
    assert ready.first().status == "passed"
    assert exported == {"rows": 80, "missing_fx": 0, "review_movements": 0}
    published = chain.publish_monitoring()
    checks = audit.mart_checks(chain, published, chain.mart_stock_latest(published))
    report = audit.check_report(checks).collect()
    assert len(report) == 23 and all(r.violations == 0 for r in report)
    complete = published.where("comparison_complete").count()
    assert complete == 80


def test_replay_refuses_an_invalid_bar(spark):
    bad = bars(spark, ["2026-09-10"], range(1)).withColumn("price_usd", F.lit(-1.0))
    received = F.lit("2026-09-17 00:00:00").cast("timestamp")
    with pytest.raises(rates.RefusedBatch):
        replay.bar_events(bad, received)


def test_sources_by_name(spark):
    fx_rows(spark, [("2026-09-09", 16000, None)]).createOrReplaceTempView("fact_jisdor_daily")
    spark.createDataFrame([], MARKET_EVENT).createOrReplaceTempView("other_market")
    chain = marts.from_sources(
        spark, marts.Sources(raw_market="other_market"), valuation.dim_stock(spark)
    )
    assert chain.mart_stock_monitoring().isEmpty()
    assert chain.fx.count() == 1
