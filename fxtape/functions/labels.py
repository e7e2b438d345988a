"""Business rules as column functions: policies, statuses, risk labels and signals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.functions.scalars import add_seconds, choose, day_of_week, safe_div


def _pick(values: Mapping[str, str], key: Column) -> Column:
    """Look a key up in a small literal map; NULL when it is not there."""
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def fx_policy(rate_date: Column, available_at: Column) -> Column:
    """How the rate of an event was found: not at all, by an earlier date, or by its publication."""
    missing, prior, verified = c.FX_POLICIES
    by_rule = choose(available_at.isNotNull(), F.lit(verified), F.lit(prior))
    return choose(rate_date.isNotNull(), by_rule, F.lit(missing))


def valuation_status(rate: Column) -> Column:
    unavailable, indicative = c.VALUATION_STATUSES
    return choose(rate.isNotNull(), F.lit(indicative), F.lit(unavailable))


def zscore(x: Column, n: Column, mean: Column, deviation: Column, min_n: int) -> Column:
    """Standard score against the baseline, NULL while the baseline is short."""
    return F.when(n >= min_n, safe_div(x - mean, deviation))


def risk_label(
    x: Column, n: Column, mean: Column, deviation: Column, min_n: int, limit: float
) -> Column:
    """A usable score is one over a long enough baseline that varies at all."""
    insufficient, review, within = c.RISK_LABELS
    score = F.abs(zscore(x, n, mean, F.nullif(deviation, F.lit(0.0)), min_n))
    return F.coalesce(
        F.when(score >= limit, F.lit(review)),
        F.when(score < limit, F.lit(within)),
        F.lit(insufficient),
    )


def crossover_signal(
    short: Column, long: Column, previous_short: Column, previous_long: Column, ready: Column
) -> Column:
    """Sign of the gap between the averages, now against before.

    BUY when a gap that was not positive becomes positive, SELL for the mirror image, else HOLD.
    """
    crossed_up = (previous_short <= previous_long) & (short > long)
    crossed_down = (previous_short >= previous_long) & (short < long)
    buy, sell, hold, none = (F.lit(signal) for signal in c.SIGNALS)
    active = F.when(crossed_up, buy).when(crossed_down, sell).otherwise(hold)
    return choose(F.coalesce(ready, F.lit(False)), active, none)


def register_signal_function(spark: SparkSession, name: str = "crossover_signal") -> None:
    """The crossover rule for SQL users, as a session-scoped SQL function."""
    buy, sell, hold, none = c.SIGNALS
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            short_ma DOUBLE, long_ma DOUBLE, previous_short DOUBLE, previous_long DOUBLE,
            ready BOOLEAN)
        RETURNS STRING
        RETURN if(coalesce(ready, false),
                  if(previous_short <= previous_long AND short_ma > long_ma, '{buy}',
                     if(previous_short >= previous_long AND short_ma < long_ma, '{sell}',
                        '{hold}')),
                  '{none}')
        """
    )


def signal_ready(
    n: Column, previous_n: Column, consecutive: Column, rate: Column, size: int
) -> Column:
    """Full current and previous long windows, no gap before this bar, and a known rate."""
    full = (n == size) & (previous_n == size)
    return F.coalesce(full & consecutive & rate.isNotNull(), F.lit(False))


def signal_reason(signal: Column) -> Column:
    return _pick(c.SIGNAL_REASONS, signal)


def institution_name(symbol: Column) -> Column:
    return _pick({stock[0]: stock[3] for stock in c.STOCKS}, symbol)


def signal_text(signal: Column) -> dict[str, Column]:
    """The constant and explanatory columns that accompany a signal."""
    return {
        "signal_rule_version": F.lit(c.SIGNAL_RULE_VERSION),
        "signal_type": F.lit(c.SIGNAL_TYPE),
        "signal_reason": signal_reason(signal),
    }


def signal_available_at(
    record_type: Column, bar: Column, ts: Column, bar_seconds: int = 60
) -> Column:
    """A bar's close is known at its end, a tick at its own time."""
    return choose(record_type == c.BAR_RECORD, add_seconds(bar, bar_seconds), ts)


def data_status(
    rate: Column, n: Column, previous_n: Column, consecutive: Column, size: int = 8
) -> Column:
    missing, short, ready = c.DATA_STATUSES
    gap = ~F.coalesce(consecutive, F.lit(False))
    return (
        F.when(rate.isNull(), missing)
        .when(gap | (n < size) | (previous_n < size), short)
        .otherwise(ready)
    )


def data_kind(mode: Column) -> Column:
    replay = F.coalesce(mode == c.REPLAY_MODE, F.lit(False))
    return choose(replay, F.lit(c.REPLAY_KIND), F.lit(c.LIVE_KIND))


def coverage_status(n: Column, day: Column, as_of: Column) -> Column:
    """Label of a calendar date by the number of rates it has."""
    duplicate, available, today, weekend, unverified = c.COVERAGE_LABELS
    absent = (
        F.when(day == as_of, today)
        .when(day_of_week(day).isin(1, 7), weekend)
        .otherwise(unverified)
    )
    found = F.coalesce(n, F.lit(0))
    return F.when(found == 0, absent).when(found == 1, available).otherwise(duplicate)
