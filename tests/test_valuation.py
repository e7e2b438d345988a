import random
from datetime import date, datetime, timedelta, timezone

import duckdb
import pytest
from helpers import by, fx_rows, ts
from pyspark.sql import functions as F

from fxtape.operators import valuation
from fxtape.plans import marts
from fxtape.rules import MarketRules

EVENTS = "event_id string, symbol string, currency string, price_usd double, event_timestamp timestamp"


def golden(spark):
    rates = fx_rows(
        spark,
        [
            ("2026-09-07", 16000, None),
            ("2026-09-08", 16100, "2026-09-08T09:00:00"),
            ("2026-09-09", 16200, None),
        ],
    )
    events = spark.createDataFrame(
        [
            ("first", "JPM", "USD", 100.0, ts("2026-09-08T02:00:00")),
            ("second", "JPM", "USD", 100.0, ts("2026-09-08T10:00:00")),
            ("missing", "JPM", "USD", 100.0, ts("2026-09-01T02:00:00")),
            ("unknown_same_day", "JPM", "USD", 100.0, ts("2026-09-09T10:00:00")),
        ],
        EVENTS,
    )
    return events, rates


@pytest.mark.parametrize("way", ["broadcast", "merge"])
def test_asof_rejects_future_and_unknown_same_day(spark, way):
    events, rates = golden(spark)
    events = events.withColumn("event_date_wib", F.to_date(F.from_utc_timestamp("event_timestamp", "Asia/Jakarta")))
    events = events.hint("merge") if way == "merge" else events
    fact = by(marts.exposure(events, rates, MarketRules()), "event_id")
    expected = {
        "first": (16000, 1_600_000.0, "prior_day_assumption"),
        "second": (16100, 1_610_000.0, "verified_availability"),
        "missing": (None, None, "missing_fx"),
        "unknown_same_day": (16100, 1_610_000.0, "verified_availability"),
    }
    assert {
        k: (r.usd_idr, r.exposure_idr, r.fx_join_policy) for k, r in fact.items()
    } == expected
    assert fact["missing"].valuation_status == "unavailable"
    assert fact["second"].fx_age_calendar_days == 0


def test_no_rates_at_all(spark):
    events, rates = golden(spark)
    result = valuation.asof_fx(events, rates.where("false"))
    assert result.count() == 4
    assert {r.fx_join_policy for r in result.collect()} == {"missing_fx"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_equals_literal_rule_on_random_data(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rates, events = [], []
    for currency in ("USD", "EUR"):
        for i in range(60):
            if rng.random() < 0.3:
                continue
            day = date(2024, 1, 1) + timedelta(days=i)
            choice = rng.random()
            available = None
            if choice < 0.6:
                shift = rng.choice([-30, 0, 9, 17, 40, 200])
                available = (datetime.combine(day, datetime.min.time()) + timedelta(hours=shift)).isoformat()
            rates.append((day.isoformat(), rng.randint(15000, 17000), available, currency))
    for i in range(800):
        at = start + timedelta(minutes=rng.randint(-3000, 90 * 1440))
        if rng.random() < 0.2:
            at = at.replace(hour=17, minute=0)
        events.append((f"e{i}", "S", rng.choice(["USD", "EUR", "GBP"]), 1.0, at))
    fx = fx_rows(spark, rates)
    frame = spark.createDataFrame(events, EVENTS)
    results = [
        {r.event_id: r.jisdor_date for r in valuation.asof_fx(f, fx).collect()}
        for f in (frame, frame.hint("merge"))
    ]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE e (id VARCHAR, currency VARCHAR, t TIMESTAMP)")
    duck.executemany("INSERT INTO e VALUES (?, ?, ?)",
                     [(e[0], e[2], e[4].replace(tzinfo=None)) for e in events])
    duck.execute("CREATE TABLE f (d DATE, currency VARCHAR, a TIMESTAMP)")
    duck.executemany("INSERT INTO f VALUES (?, ?, ?)", [(r[0], r[3], r[2]) for r in rates])
    expected = dict(
        duck.execute(
            """SELECT id, d FROM e LEFT JOIN f ON f.currency = e.currency
               AND d <= CAST(t + INTERVAL 7 HOUR AS DATE)
               AND (a <= t OR (a IS NULL AND d < CAST(t + INTERVAL 7 HOUR AS DATE)))
               QUALIFY row_number() OVER (PARTITION BY id ORDER BY d DESC NULLS LAST) = 1"""
        ).fetchall()
    )
    assert results[0] == expected
    assert results[1] == expected


def test_stock_dimension_keeps_unknown_symbols(spark):
    rows = spark.createDataFrame([("JPM", "USD"), ("XYZ", "USD"), ("JPM", "EUR")], ["symbol", "currency"])
    joined = valuation.join_stock(rows, valuation.dim_stock(spark)).collect()
    assert sorted((r.symbol, r.currency, r.company_name) for r in joined) == [
        ("JPM", "EUR", None), ("JPM", "USD", "JPMorgan Chase & Co."), ("XYZ", "USD", None),
    ]


def test_asof_is_one_lazy_plan_with_a_shuffled_form(spark):
    """Building the join runs no job; with the merge hint both sides meet by currency and day."""
    events, rates = golden(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("asof-plan", "building only")
    joined = valuation.asof_fx(events.hint("merge"), rates)
    assert len(tracker.getJobIdsForGroup("asof-plan")) == 0
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "_currency" in plan and "BroadcastNestedLoopJoin" not in plan
