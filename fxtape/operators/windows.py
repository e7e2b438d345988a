"""Session windows, peer windows and the latest mart.

The minute table has one row per symbol, mode, type and bar, so a session partition holds at
most a session's number of bars (1,500 for one-minute bars of the longest day) whatever the
size of the data. All session windows share one partitioning and one order, and so one exchange
and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from fxtape.functions.labels import (
    crossover_signal,
    data_kind,
    data_status,
    institution_name,
    risk_label,
    signal_available_at,
    signal_ready,
    signal_text,
    zscore,
)
from fxtape.functions.scalars import epoch, safe_div, seconds_between
from fxtape.operators.rows import latest_per
from fxtape.rules import MarketRules

SESSION_KEYS = ["symbol", "ingestion_mode", "record_type", "session_date"]
PEER_KEYS = ["minute_utc", "ingestion_mode", "record_type"]



def with_bar_epoch(df: DataFrame) -> DataFrame:
    """Add the bar start in unix seconds, once.

    Every session window orders by this one column. Ordering by an expression instead would give
    each window a column and a sort of its own.
    """
    if "bar_epoch" in df.columns:
        return df
    return df.withColumn("bar_epoch", epoch(F.col("minute_utc")))


def session_window() -> WindowSpec:
    """The one window specification of a trading session, ordered by bar."""
    return W.partitionBy(*SESSION_KEYS).orderBy("bar_epoch")


def with_previous(df: DataFrame) -> DataFrame:
    """Bar, price, rate and value of the previous observation in the session."""
    w = session_window()
    return with_bar_epoch(df).withColumns(
        {
            "previous_minute": F.lag("minute_utc").over(w),
            "previous_price": F.lag("price_usd").over(w),
            "previous_fx": F.lag("usd_idr").over(w),
            "previous_exposure": F.lag("exposure_idr").over(w),
        }
    )


def contributions(df: DataFrame, step_seconds: int = 60) -> DataFrame:
    """Change since the previous bar, split into price, rate and interaction.

    All of it is NULL unless the previous observation is exactly one bar earlier.
    """
    price, before = F.col("price_usd"), F.col("previous_price")
    rate = F.col("usd_idr").cast("double")
    rate_before = F.col("previous_fx").cast("double")
    step = seconds_between(F.col("minute_utc"), F.col("previous_minute")) == step_seconds

    def stepwise(value: Column) -> Column:
        return F.when(F.col("consecutive_minute"), value)

    return df.withColumn("consecutive_minute", step).withColumns(
        {
            "asset_return": stepwise(safe_div(price, before) - 1),
            "asset_effect_idr": stepwise((price - before) * rate_before),
            "fx_effect_idr": stepwise(before * (rate - rate_before)),
            "interaction_effect_idr": stepwise((price - before) * (rate - rate_before)),
            "total_change_idr": stepwise(F.col("exposure_idr") - F.col("previous_exposure")),
        }
    )


def rolling_baseline(df: DataFrame, from_s: int = 1800, to_s: int = 60) -> DataFrame:
    """Count, mean and sample deviation of the returns between ``from_s`` and ``to_s`` ago."""
    history = session_window().rangeBetween(-from_s, -to_s)
    return with_bar_epoch(df).withColumns(
        {
            "baseline_count": F.count("asset_return").over(history),
            "baseline_mean": F.avg("asset_return").over(history),
            "baseline_stddev": F.stddev_samp("asset_return").over(history),
        }
    )


def risk_columns(df: DataFrame, rules: MarketRules) -> DataFrame:
    """Z-score and risk label of every return."""
    stats = [F.col(n) for n in ("asset_return", "baseline_count", "baseline_mean", "baseline_stddev")]
    return df.withColumns(
        {
            "return_zscore": zscore(*stats, rules.baseline_min),
            "risk_indicator": risk_label(*stats, rules.baseline_min, rules.zscore_limit),
        }
    )


def moving_average(seconds: int) -> Column:
    """Mean price of the current bar and the ``seconds`` before it.

    Summed as decimals, so two averages of equal prices are equal whatever the order of
    summation, and a crossing is never a rounding artefact.
    """
    window = session_window().rangeBetween(-seconds, W.currentRow)
    total = F.sum(F.col("price_usd").cast("decimal(28,12)")).over(window)
    return total.cast("double") / F.count("price_usd").over(window)


def moving_averages(df: DataFrame, rules: MarketRules) -> DataFrame:
    """Short and long average, and the number of rows in the long window."""
    long_window = session_window().rangeBetween(-rules.long_seconds, W.currentRow)
    return with_bar_epoch(df).withColumns(
        {
            "moving_average_short": moving_average(rules.short_seconds),
            "moving_average_long": moving_average(rules.long_seconds),
            "ma_observation_count": F.count(F.lit(1)).over(long_window),
        }
    )


def session_first(df: DataFrame) -> DataFrame:
    """Price and bar with which the session of a symbol began."""
    so_far = session_window().rowsBetween(W.unboundedPreceding, W.currentRow)
    return with_bar_epoch(df).withColumns(
        {
            "session_first_price": F.first("price_usd").over(so_far),
            "session_first_minute": F.first("minute_utc").over(so_far),
        }
    )


def with_previous_features(df: DataFrame) -> DataFrame:
    """Averages and count of the previous observation, and the return since the session began."""
    w = session_window()
    return with_bar_epoch(df).withColumns(
        {
            "previous_short_ma": F.lag("moving_average_short").over(w),
            "previous_long_ma": F.lag("moving_average_long").over(w),
            "previous_ma_count": F.lag("ma_observation_count").over(w),
            "session_return": safe_div(F.col("price_usd"), F.col("session_first_price")) - 1,
        }
    )


_PEER_STATS = {
    "comparison_symbol_count": lambda: F.count(F.lit(1)),
    "comparison_return_sum": lambda: F.sum("session_return"),
    "earliest_peer_start": lambda: F.min("session_first_minute"),
    "latest_peer_start": lambda: F.max("session_first_minute"),
}


def _complete(universe_size: int) -> Column:
    everyone = F.col("comparison_symbol_count") == universe_size
    return everyone & (F.col("earliest_peer_start") == F.col("latest_peer_start"))


def peers(df: DataFrame, universe_size: int) -> DataFrame:
    """Number of symbols, sum of returns, session starts and rank among the peers of a bar.

    The statistics are a partial aggregation joined back on the bar. A rank is only reported for
    complete bars, which have exactly ``universe_size`` rows; rows of other bars are spread by a
    hash, so that no surplus of symbols gathers in one window partition.
    """
    stats = df.groupBy(*PEER_KEYS).agg(*[stat().alias(n) for n, stat in _PEER_STATS.items()])
    keys = [f"_{name}" for name in PEER_KEYS]
    stats = stats.withColumnsRenamed(dict(zip(PEER_KEYS, keys)))
    same_bar = [F.col(name).eqNullSafe(F.col(key)) for name, key in zip(PEER_KEYS, keys)]
    joined = df.join(stats, same_bar, "left").drop(*keys)
    spread = F.when(~_complete(universe_size), F.xxhash64("event_id"))
    w = W.partitionBy(*PEER_KEYS, spread).orderBy(F.desc_nulls_last("session_return"))
    return joined.withColumn("raw_peer_rank", F.dense_rank().over(w))


def peer_columns(df: DataFrame, universe_size: int) -> DataFrame:
    """Comparison with the other symbols of the bar, only when all of them are there and began
    their session together."""
    others = universe_size - 1
    complete, own = F.col("comparison_complete"), F.col("session_return")
    average = safe_div(F.col("comparison_return_sum") - own, F.lit(float(others)))
    return df.withColumn("comparison_complete", _complete(universe_size)).withColumns(
        {
            "peer_average_return": F.when(complete, average),
            "excess_return_vs_peers": F.when(complete, own - average),
            "peer_rank": F.when(complete, F.col("raw_peer_rank")),
        }
    ).drop("comparison_return_sum", "raw_peer_rank")


def peer_comparison(df: DataFrame, universe_size: int) -> DataFrame:
    """Peer statistics, rank and comparison columns of every bar, by one plan at every size."""
    return peer_columns(peers(df, universe_size), universe_size)


def signal_columns(df: DataFrame, rules: MarketRules) -> DataFrame:
    """Crossover signal with its texts, availability and data status."""
    count, before = F.col("ma_observation_count"), F.col("previous_ma_count")
    consecutive, rate = F.col("consecutive_minute"), F.col("usd_idr")
    ready = signal_ready(count, before, consecutive, rate, rules.long_bars)
    averages = ["moving_average_short", "moving_average_long", "previous_short_ma", "previous_long_ma"]
    signal = crossover_signal(*[F.col(name) for name in averages], ready)
    return df.withColumn("strategy_signal", signal).withColumns(
        {
            "institution_name": institution_name(F.col("symbol")),
            **signal_text(F.col("strategy_signal")),
            "signal_available_at": signal_available_at(
                F.col("record_type"),
                F.col("minute_utc"),
                F.col("event_timestamp"),
                rules.bar_seconds,
            ),
            "data_status": data_status(rate, count, before, consecutive, rules.long_bars),
            "data_kind": data_kind(F.col("ingestion_mode")),
            "last_updated_at": F.col("ingested_at"),
        }
    )


def universe_latest(latest: DataFrame) -> DataFrame:
    """Latest bar over all symbols of a mode and type, and whether a row is at it.

    Takes one row per symbol: their maximum is the maximum of all rows, and one row per mode and
    type is joined back, where a window over all rows would fill one task per mode and type.
    """
    by = ["ingestion_mode", "record_type"]
    newest = latest.groupBy(*by).agg(F.max("minute_utc").alias("universe_latest_minute"))
    return latest.join(newest, by, "left").withColumn(
        "aligned_with_latest", F.col("minute_utc") == F.col("universe_latest_minute")
    )


def latest(monitoring: DataFrame) -> DataFrame:
    """Latest row per symbol, mode and type. Reads its input twice: give it a stored relation."""
    return universe_latest(latest_per(monitoring))
