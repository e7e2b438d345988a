from datetime import timedelta
from decimal import Decimal

import pytest
from helpers import by, ts
from pyspark.sql import functions as F

from fxtape.functions.labels import register_signal_function
from fxtape.operators import quality, rows, windows
from fxtape.plans import marts
from fxtape.rules import MarketRules

RULES = MarketRules()
EXPOSURE = (
    "event_id string, symbol string, session_date string, minute_utc timestamp, price_usd double, "
    "usd_idr decimal(38,9), exposure_idr double"
)
MODE = {"ingestion_mode": "replay", "record_type": "historical_bar"}


def with_mode(df):
    return df.withColumns({name: F.lit(value) for name, value in MODE.items()})


def exposures(spark, rows_):
    built = [
        (i, s, d, ts(m), float(p), Decimal(r) if r else None, p * float(r) if r else None)
        for i, s, d, m, p, r in rows_
    ]
    return with_mode(spark.createDataFrame(built, EXPOSURE))


def minutes(spark, prices, symbol="JPM", rate=16000, start="2026-09-10T13:30:00"):
    first = ts(start)
    built = [
        (f"{symbol}{i}", symbol, "2026-09-10", first + timedelta(minutes=i), float(p),
         Decimal(rate) if rate else None, p * float(rate) if rate else None)
        for i, p in enumerate(prices) if p is not None
    ]
    return with_mode(spark.createDataFrame(built, EXPOSURE)).withColumns(
        {"event_timestamp": F.col("minute_utc"), "ingested_at": F.col("minute_utc")}
    )


def test_contributions_and_session_edge(spark):
    rows_ = [
        ("a", "JPM", "2026-09-08", "2026-09-08T13:30:00", 100, 16000),
        ("b", "JPM", "2026-09-08", "2026-09-08T13:31:00", 101, 16010),
        ("c", "JPM", "2026-09-09", "2026-09-09T13:30:00", 102, 16010),
    ]
    risk = by(marts.risk(exposures(spark, rows_), RULES), "event_id")
    effects = ["asset_effect_idr", "fx_effect_idr", "interaction_effect_idr", "total_change_idr"]
    assert [risk["b"][e] for e in effects] == [16000, 1000, 10, 17010]
    assert all(risk[k][e] is None for k in "ac" for e in effects)
    assert risk["a"].consecutive_minute is None and risk["b"].consecutive_minute is True
    assert {r.risk_indicator for r in risk.values()} == {"insufficient_data"}


def test_gap_is_not_filled(spark):
    risk = by(marts.risk(minutes(spark, [10, None, 11]), RULES), "event_id")
    assert risk["JPM2"].consecutive_minute is False
    assert risk["JPM2"].asset_return is None and risk["JPM2"].total_change_idr is None


def test_moving_averages_use_current_and_past_minutes(spark):
    prices = [8] * 8 + [11, 2]
    features = by(marts.features(marts.risk(minutes(spark, prices), RULES), RULES), "event_id")
    got = [
        (r.moving_average_short, r.moving_average_long, r.ma_observation_count)
        for r in (features[f"JPM{i}"] for i in range(10))
    ]
    assert got == [(8, 8, i + 1) for i in range(8)] + [(9, 8.375, 8), (7, 7.625, 8)]


def test_signal_needs_nine_bars_and_a_rate(spark):
    prices = [8] * 8 + [11, 2]
    mart = by(marts.monitoring(marts.features(marts.risk(minutes(spark, prices), RULES), RULES), RULES), "event_id")
    signals = [mart[f"JPM{i}"].strategy_signal for i in range(10)]
    assert signals == ["NO_SIGNAL"] * 8 + ["BUY", "SELL"]
    assert mart["JPM8"].signal_available_at == mart["JPM8"].minute_utc + timedelta(minutes=1)
    assert mart["JPM8"].institution_name == "JPMorgan Chase"
    assert mart["JPM7"].data_status == "insufficient_history"
    without = marts.monitoring(
        marts.features(marts.risk(minutes(spark, prices, rate=None), RULES), RULES), RULES
    )
    assert {r.strategy_signal for r in without.collect()} == {"NO_SIGNAL"}
    assert {r.data_status for r in without.collect()} == {"missing_fx"}


def test_zscore_threshold_and_zero_deviation(spark):
    prices = [100.0]
    for i in range(24):
        prices.append(prices[-1] * (1.001 if i % 2 else 0.999))
    prices.append(prices[-1] * 1.2)
    risk = by(marts.risk(minutes(spark, prices), RULES), "event_id")
    last = risk[f"JPM{len(prices) - 1}"]
    assert last.baseline_count == 24 and last.risk_indicator == "review_movement"
    assert risk["JPM20"].return_zscore is None  # nineteen earlier returns only
    assert risk["JPM22"].risk_indicator == "within_demo_threshold"
    flat = by(marts.risk(minutes(spark, [5.0] * 30), RULES), "event_id")
    assert flat["JPM29"].baseline_stddev == 0
    assert flat["JPM29"].return_zscore is None
    assert flat["JPM29"].risk_indicator == "insufficient_data"


def test_baseline_excludes_the_current_bar_and_old_ones(spark):
    risk = by(marts.risk(minutes(spark, [10 + i % 3 for i in range(50)]), RULES), "event_id")
    assert risk["JPM49"].baseline_count == 30
    assert risk["JPM1"].baseline_count == 0


def test_peers_need_everyone_and_a_common_start(spark):
    frames = [
        minutes(spark, [10, 11], "JPM"), minutes(spark, [10, 12], "BAC"),
        minutes(spark, [10, 9], "GS"), minutes(spark, [10, 12], "MS"),
        minutes(spark, [20, 21, 22], "LATE", start="2026-09-10T13:31:00"),
    ]
    small = rows.union_rows(*frames[:4])
    features = marts.features(marts.risk(small, RULES), RULES)
    peers = by(windows.peer_comparison(features, 4), "event_id")
    assert [peers[f"{s}1"].peer_rank for s in ("BAC", "MS", "JPM", "GS")] == [1, 1, 2, 3]
    assert peers["JPM1"].peer_average_return == pytest.approx((0.2 - 0.1 + 0.2) / 3)
    assert peers["JPM1"].excess_return_vs_peers == pytest.approx(0.1 - 0.1)
    # Three of the four and one that began a minute later: everyone is there, not together.
    mixed = rows.union_rows(*frames[:3], frames[4])
    features = marts.features(marts.risk(mixed, RULES), RULES)
    late = by(windows.peer_comparison(features, 4), "event_id")
    assert late["JPM1"].comparison_symbol_count == 4
    assert late["JPM1"].comparison_complete is False
    assert late["JPM1"].peer_rank is None and late["JPM1"].peer_average_return is None
    surplus = marts.features(marts.risk(rows.union_rows(*frames), RULES), RULES)
    assert by(windows.peer_comparison(surplus, 4), "event_id")["JPM1"].peer_rank is None


def test_latest_and_alignment(spark):
    both = rows.union_rows(minutes(spark, [1, 2, 3], "JPM"), minutes(spark, [1, 2], "GS"))
    mart = marts.monitoring(marts.features(marts.risk(both, RULES), RULES), RULES)
    latest = by(windows.latest(mart), "symbol")
    assert latest["JPM"].aligned_with_latest is True
    assert latest["GS"].aligned_with_latest is False
    assert latest["GS"].universe_latest_minute == latest["JPM"].minute_utc
    assert quality.latest_mismatch(windows.latest(mart), mart).isEmpty()


def test_signal_scenarios(spark):
    scenarios = quality.signal_scenarios(spark)
    assert scenarios.count() == 5
    assert quality.scenarios_match(scenarios).isEmpty()
    assert quality.scenario_mismatches(scenarios).first().asDict() == {"row_count": 5, "mismatches": 0}
    register_signal_function(spark)
    in_sql = scenarios.selectExpr(
        "crossover_signal(short_ma, long_ma, prev_short, prev_long, ready) = expected_signal AS ok"
    )
    assert all(r.ok for r in in_sql.collect())


def test_dedup_order(spark):
    events = spark.createDataFrame(
        [
            ("a", ts("2024-01-01T00:00:00"), 0, 5), ("a", ts("2024-01-01T01:00:00"), 1, 1),
            ("b", ts("2024-01-01T00:00:00"), 1, 9), ("b", ts("2024-01-01T00:00:00"), 0, 1),
            ("b", ts("2024-01-01T00:00:00"), 0, 2),
        ],
        "event_id string, ingested_at timestamp, kafka_partition long, kafka_offset long",
    )
    kept = by(rows.dedup_events(events), "event_id")
    assert (kept["a"].kafka_partition, kept["a"].kafka_offset) == (1, 1)
    assert (kept["b"].kafka_partition, kept["b"].kafka_offset) == (0, 2)


def test_session_windows_share_one_exchange_and_sort(spark):
    features = marts.features(marts.risk(minutes(spark, range(1, 20)), RULES), RULES)
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Sort ") + plan.count("*Sort ") <= 1


def test_dedup_is_cut_before_the_shuffle(spark, sf_dir):
    from registry.tables import raw_market

    plan = rows.dedup_events(raw_market(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]
