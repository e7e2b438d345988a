"""The mart chain: one lazy plan from raw events and rates to the monitoring mart."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from fxtape.operators import rows, valuation, windows
from fxtape.rules import MarketRules
from fxtape.shared import published


@dataclass(frozen=True)
class Sources:
    """Names of the two declared source tables; the market source is switchable."""

    raw_fx: str = "fact_jisdor_daily"
    raw_market: str = "stg_market_replay_demo"

    def fx(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.raw_fx)

    def market(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.raw_market)


def minutes(raw: DataFrame, dim: DataFrame, rules: MarketRules) -> DataFrame:
    """One observation per symbol, mode, type and bar, with local date and session."""
    bars = rows.last_in_bar(
        valuation.minute_columns(rows.dedup_events(raw), rules), rules.bar_seconds
    )
    return valuation.join_stock(bars, dim)


def exposure(minute_table: DataFrame, fx: DataFrame, rules: MarketRules) -> DataFrame:
    """Each observation valued with the rate that was known at its time."""
    matched = valuation.asof_fx(minute_table, fx, rules.local_zone)
    return valuation.valuation(matched, rules.quantity)


def risk(exposures: DataFrame, rules: MarketRules) -> DataFrame:
    """Contribution split and unusual returns."""
    changes = windows.contributions(windows.with_previous(exposures), rules.bar_seconds)
    baseline = windows.rolling_baseline(changes, rules.baseline_seconds, rules.bar_seconds)
    return windows.risk_columns(baseline, rules)


def features(risks: DataFrame, rules: MarketRules) -> DataFrame:
    """Moving averages and session returns."""
    averages = windows.session_first(windows.moving_averages(risks, rules))
    return windows.with_previous_features(averages)


def monitoring(feature_rows: DataFrame, rules: MarketRules) -> DataFrame:
    """Signals, statuses and peer comparison."""
    signals = windows.signal_columns(feature_rows, rules).drop("bar_epoch")
    return windows.peer_comparison(signals, rules.universe_size)


@dataclass(frozen=True)
class Marts:
    """Every relation of the chain, each a lazy DataFrame on top of the previous one."""

    raw: DataFrame
    fx: DataFrame
    dim: DataFrame
    rules: MarketRules = field(default_factory=MarketRules)

    def stg_prices(self) -> DataFrame:
        return rows.dedup_events(self.raw)

    def int_market_minutes(self) -> DataFrame:
        return minutes(self.raw, self.dim, self.rules)

    def fact_market_exposure(self) -> DataFrame:
        return exposure(self.int_market_minutes(), self.fx, self.rules)

    def mart_market_risk(self) -> DataFrame:
        return risk(self.fact_market_exposure(), self.rules)

    def int_stock_features(self) -> DataFrame:
        return features(self.mart_market_risk(), self.rules)

    def mart_stock_monitoring(self) -> DataFrame:
        return monitoring(self.int_stock_features(), self.rules)

    def publish_monitoring(self) -> DataFrame:
        """The monitoring mart, written once for the reports that read it several times."""
        return published(self.mart_stock_monitoring(), "mart_stock_monitoring")

    def mart_stock_latest(self, stored: DataFrame | None = None) -> DataFrame:
        return windows.latest(stored if stored is not None else self.publish_monitoring())


def from_sources(
    spark: SparkSession, sources: Sources, dim: DataFrame, rules: MarketRules | None = None
) -> Marts:
    return Marts(sources.market(spark), sources.fx(spark), dim, rules or MarketRules())
