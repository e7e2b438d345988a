"""Queries over the mart chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fxtape.operators import rows, valuation
from registry import sql
from registry.tables import day, marts, raw_market, text

QUERIES: dict = {}
SQL: dict[str, str] = {}


def key() -> list:
    return ["symbol", text("minute_utc").alias("minute_utc")]


SQL_KEY = f"symbol, {sql.text('minute_utc')} AS minute_utc"


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            SQL[name] = oracle
        return function

    return register


def rounded(*names: str) -> list:
    return [F.round(F.col(name).cast("double"), 6).alias(name) for name in names]


def sql_rounded(*names: str) -> str:
    return ", ".join(f"round(CAST({name} AS DOUBLE), 6) AS {name}" for name in names)


def whole(*names: str) -> list:
    return [F.col(name).cast("long").alias(name) for name in names]


def sql_whole(*names: str) -> str:
    return ", ".join(f"CAST({name} AS BIGINT) AS {name}" for name in names)


@query(
    "stg_dedup",
    sql.upto(
        "stg",
        f"""SELECT event_id, symbol, price_usd, kafka_partition, kafka_offset,
        {sql.text("ingested_at")} AS ingested_at FROM stg""",
    ),
)
def stg_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = rows.dedup_events(raw_market(spark, sf_dir))
    return events.select(
        "event_id", "symbol", "price_usd", "kafka_partition", "kafka_offset",
        text("ingested_at").alias("ingested_at"),
    )


@query(
    "minute_bars",
    sql.upto(
        "minutes",
        f"""SELECT {SQL_KEY}, event_id, company_name, price_usd,
        {sql.day("event_date_wib")} AS event_date_wib, {sql.day("session_date")} AS session_date
        FROM minutes""",
    ),
)
def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).int_market_minutes().select(
        *key(), "event_id", "company_name", "price_usd",
        day("event_date_wib").alias("event_date_wib"), day("session_date").alias("session_date"),
    )


@query(
    "fx_asof",
    sql.upto(
        "exposure",
        f"""SELECT event_id, {sql.day("jisdor_date")} AS jisdor_date, {sql_rounded("usd_idr")},
        {sql.text("fx_available_at")} AS fx_available_at, fx_source_run_id, fx_join_policy
        FROM exposure""",
    ),
)
def fx_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = marts(spark, sf_dir)
    return valuation.asof_fx(chain.int_market_minutes(), chain.fx).select(
        "event_id", day("jisdor_date").alias("jisdor_date"), *rounded("usd_idr"),
        text("fx_available_at").alias("fx_available_at"), "fx_source_run_id", "fx_join_policy",
    )


@query(
    "fx_asof_events",
    "WITH " + ",".join([sql.RAW, sql.STG, sql.FX]) + f""",
    located AS (SELECT event_id, currency, event_timestamp,
      CAST(timezone('Asia/Jakarta', timezone('UTC', event_timestamp)) AS DATE) AS wib FROM stg)
    SELECT e.event_id, {sql.day("f.jisdor_date")} AS jisdor_date,
           round(CAST(f.usd_idr AS DOUBLE), 6) AS usd_idr
    FROM located e LEFT JOIN fx f ON f.currency = e.currency AND f.jisdor_date <= e.wib
      AND (f.fx_available_at <= e.event_timestamp
           OR (f.fx_available_at IS NULL AND f.jisdor_date < e.wib))
    QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY f.jisdor_date DESC NULLS LAST) = 1
    """,
)
def fx_asof_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of join on every single event, with a merge join forced, as it is planned for rates too large to broadcast."""
    chain = marts(spark, sf_dir)
    return valuation.asof_fx(chain.stg_prices().hint("merge"), chain.fx).select(
        "event_id", day("jisdor_date").alias("jisdor_date"), *rounded("usd_idr")
    )


@query(
    "exposure",
    sql.upto(
        "exposure",
        f"""SELECT {SQL_KEY}, price_usd, {sql_rounded("usd_idr", "exposure_idr")},
        {sql_whole("quantity", "fx_age_calendar_days")}, valuation_status, fx_join_policy
        FROM exposure""",
    ),
)
def exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).fact_market_exposure().select(
        *key(), "price_usd", *rounded("usd_idr", "exposure_idr"),
        *whole("quantity", "fx_age_calendar_days"), "valuation_status", "fx_join_policy",
    )


EFFECTS = [
    "asset_return", "asset_effect_idr", "fx_effect_idr", "interaction_effect_idr",
    "total_change_idr",
]


@query(
    "contribution",
    sql.upto("risk", f"SELECT {SQL_KEY}, consecutive_minute, {sql_rounded(*EFFECTS)} FROM risk"),
)
def contribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).mart_market_risk().select(
        *key(), "consecutive_minute", *rounded(*EFFECTS)
    )


@query(
    "baseline_zscore",
    sql.upto(
        "risk",
        f"""SELECT {SQL_KEY}, {sql_whole("baseline_count")},
        {sql_rounded("baseline_mean", "baseline_stddev", "return_zscore")}, risk_indicator
        FROM risk""",
    ),
)
def baseline_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).mart_market_risk().select(
        *key(), *whole("baseline_count"),
        *rounded("baseline_mean", "baseline_stddev", "return_zscore"), "risk_indicator",
    )


@query(
    "sma_features",
    sql.upto(
        "features",
        f"""SELECT {SQL_KEY}, {sql_whole("ma_observation_count")},
        {sql_rounded("moving_average_short", "moving_average_long", "session_first_price")},
        {sql.text("session_first_minute")} AS session_first_minute FROM features""",
    ),
)
def sma_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).int_stock_features().select(
        *key(), *whole("ma_observation_count"),
        *rounded("moving_average_short", "moving_average_long", "session_first_price"),
        text("session_first_minute").alias("session_first_minute"),
    )


@query(
    "sma_lags",
    sql.upto(
        "features",
        f"""SELECT {SQL_KEY}, {sql_whole("previous_ma_count")},
        {sql_rounded("previous_short_ma", "previous_long_ma", "session_return")} FROM features""",
    ),
)
def sma_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).int_stock_features().select(
        *key(), *whole("previous_ma_count"),
        *rounded("previous_short_ma", "previous_long_ma", "session_return"),
    )


PEERS = ["peer_average_return", "excess_return_vs_peers"]


@query(
    "peer_comparison",
    sql.upto(
        "monitoring",
        f"""SELECT {SQL_KEY}, comparison_complete,
        {sql_whole("comparison_symbol_count", "peer_rank")}, {sql_rounded(*PEERS)},
        {sql.text("earliest_peer_start")} AS earliest_peer_start,
        {sql.text("latest_peer_start")} AS latest_peer_start FROM monitoring""",
    ),
)
def peer_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).mart_stock_monitoring().select(
        *key(), "comparison_complete", *whole("comparison_symbol_count", "peer_rank"),
        *rounded(*PEERS), text("earliest_peer_start").alias("earliest_peer_start"),
        text("latest_peer_start").alias("latest_peer_start"),
    )


@query(
    "signal",
    sql.upto(
        "monitoring",
        f"""SELECT {SQL_KEY}, strategy_signal, data_status, data_kind, institution_name,
        {sql.text("signal_available_at")} AS signal_available_at,
        'sma_3_8_crossover_v1' AS signal_rule_version,
        'SIMULATION_RULE_NOT_INVESTMENT_ADVICE' AS signal_type,
        CASE strategy_signal
          WHEN 'BUY' THEN 'SMA3 crosses above SMA8; simulated entry signal'
          WHEN 'SELL' THEN 'SMA3 crosses below SMA8; simulated exit signal, not a short order'
          WHEN 'HOLD' THEN 'No new crossover; no new action, not proof of an existing position'
          ELSE 'Insufficient consecutive history or unavailable FX' END AS signal_reason
        FROM monitoring""",
    ),
)
def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).mart_stock_monitoring().select(
        *key(), "strategy_signal", "data_status", "data_kind", "institution_name",
        text("signal_available_at").alias("signal_available_at"),
        "signal_rule_version", "signal_type", "signal_reason",
    )


MONITORING = ["usd_idr", "exposure_idr", *EFFECTS, "return_zscore", "moving_average_short",
              "moving_average_long", "session_return", *PEERS]


def monitoring_columns(df: DataFrame) -> DataFrame:
    return df.select(
        *key(), "event_id", "price_usd", "strategy_signal", "data_status", "risk_indicator",
        "fx_join_policy", "comparison_complete", *whole("peer_rank"), *rounded(*MONITORING),
    )


@query(
    "stock_monitoring",
    sql.upto(
        "monitoring",
        f"""SELECT {SQL_KEY}, event_id, price_usd, strategy_signal, data_status, risk_indicator,
        fx_join_policy, comparison_complete, {sql_whole("peer_rank")}, {sql_rounded(*MONITORING)}
        FROM monitoring""",
    ),
)
def stock_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring_columns(marts(spark, sf_dir).mart_stock_monitoring())


@query(
    "latest",
    sql.upto(
        "latest",
        f"""SELECT {SQL_KEY}, event_id, strategy_signal, aligned_with_latest, comparison_complete,
        {sql.text("universe_latest_minute")} AS universe_latest_minute FROM latest""",
    ),
)
def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).mart_stock_latest().select(
        *key(), "event_id", "strategy_signal", "aligned_with_latest", "comparison_complete",
        text("universe_latest_minute").alias("universe_latest_minute"),
    )
