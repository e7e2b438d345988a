"""Queries for reports, exports and checks over the marts and the rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fxtape.functions.labels import crossover_signal, register_signal_function, signal_ready
from fxtape.operators import quality, reports, rows
from registry import sql
from registry.market import EFFECTS, SQL_KEY, key, rounded, sql_rounded, sql_whole, whole
from fxtape.shared import positioned
from registry.tables import AS_OF, RULES, day, fx_fact, marts, table, text

QUERIES: dict = {}
SQL: dict[str, str] = {}

SESSION_SQL = f"symbol, {sql.day('session_date')} AS session_date"


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            SQL[name] = oracle
        return function

    return register


def monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).mart_stock_monitoring()


def selection() -> list:
    return ["symbol", day("session_date").alias("session_date")]


# --- distributions and selections --------------------------------------------------------


@query(
    "signal_distribution",
    sql.upto(
        "monitoring",
        """SELECT symbol, strategy_signal, count(*) AS row_count FROM monitoring
        GROUP BY symbol, strategy_signal""",
    ),
)
def signal_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.signal_distribution(monitoring(spark, sf_dir), ["symbol"])


_COUNTS = ", ".join(
    f"count(*) FILTER (strategy_signal = '{name}') AS {name.lower()}"
    for name in ("BUY", "SELL", "HOLD", "NO_SIGNAL")
)


def lowered(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


@query(
    "signal_pivot",
    sql.upto(
        "monitoring",
        f"""SELECT symbol, count(*) AS bars, {_COUNTS},
        count(*) FILTER (usd_idr IS NULL) AS missing_fx,
        count(*) FILTER (NOT coalesce(comparison_complete, false)) AS incomplete_comparison
        FROM monitoring GROUP BY symbol""",
    ),
)
def signal_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lowered(reports.signal_pivot(monitoring(spark, sf_dir)))


@query(
    "selection_summary",
    sql.upto(
        "monitoring",
        f"""SELECT {SESSION_SQL}, arg_max(price_usd, minute_utc) AS last_price_usd,
        round(arg_max_null(exposure_idr, minute_utc), 6) AS last_exposure_idr,
        count(*) AS observations, count(*) FILTER (usd_idr IS NULL) AS missing_fx,
        count(*) FILTER (risk_indicator = 'review_movement') AS review,
        count(*) FILTER (risk_indicator = 'insufficient_data') AS insufficient, {_COUNTS}
        FROM monitoring GROUP BY symbol, monitoring.session_date""",
    ),
)
def selection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = lowered(reports.selection_summary(monitoring(spark, sf_dir)))
    return summary.withColumns(
        {"session_date": day("session_date"), "last_exposure_idr": F.round("last_exposure_idr", 6)}
    )


@query(
    "selection_contribution",
    sql.upto(
        "monitoring",
        f"""SELECT {SESSION_SQL},
        round((p1 - p0) * r0 + 0 * r1, 6) AS asset_effect_idr,
        round(p0 * (r1 - r0), 6) AS fx_effect_idr,
        round((p1 - p0) * (r1 - r0), 6) AS interaction_effect_idr,
        round(p1 * r1 - p0 * r0, 6) AS total_change_idr FROM ends""",
        """
        ends AS (SELECT symbol, session_date, arg_min(price_usd, minute_utc) AS p0,
          arg_max(price_usd, minute_utc) AS p1, arg_min_null(rate, minute_utc) AS r0,
          arg_max_null(rate, minute_utc) AS r1 FROM monitoring GROUP BY symbol, session_date)""",
    ),
)
def selection_contribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.selection_contribution(monitoring(spark, sf_dir)).select(
        *selection(), *rounded(*EFFECTS[1:])
    )


@query(
    "selection_last",
    sql.upto(
        "monitoring",
        f"""SELECT {SQL_KEY}, {sql.day("session_date")} AS session_date, event_id, strategy_signal,
        {sql_rounded("session_return", "peer_average_return")} FROM monitoring
        QUALIFY row_number() OVER (PARTITION BY symbol, monitoring.session_date
          ORDER BY monitoring.minute_utc DESC) = 1""",
    ),
)
def selection_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.selection_last(monitoring(spark, sf_dir)).select(
        *key(), day("session_date").alias("session_date"), "event_id", "strategy_signal",
        *rounded("session_return", "peer_average_return"),
    )


@query(
    "last_rows",
    sql.upto(
        "monitoring",
        f"""SELECT {SQL_KEY}, event_id, risk_indicator, fx_join_policy,
        {sql_whole("fx_age_calendar_days")} FROM monitoring
        QUALIFY row_number() OVER (PARTITION BY symbol, session_date
          ORDER BY monitoring.minute_utc DESC) <= 8""",
    ),
)
def last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.last_rows(monitoring(spark, sf_dir)).select(
        *key(), "event_id", "risk_indicator", "fx_join_policy", *whole("fx_age_calendar_days")
    )


@query(
    "last_minute",
    sql.upto(
        "monitoring",
        f"""SELECT symbol, ingestion_mode, record_type, {sql.text("max(minute_utc)")} AS last_minute
        FROM monitoring GROUP BY symbol, ingestion_mode, record_type""",
    ),
)
def last_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.last_minute(monitoring(spark, sf_dir)).withColumn(
        "last_minute", text("last_minute")
    )


@query(
    "ordered_export",
    sql.upto(
        "monitoring",
        f"""SELECT {SQL_KEY}, ingestion_mode, event_id, row_number() OVER (
          ORDER BY symbol, ingestion_mode, monitoring.minute_utc) - 1 AS position FROM monitoring""",
    ),
)
def ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row, with its place in the order of the exported rows."""
    order = ["symbol", "ingestion_mode", "minute_utc"]
    return positioned(
        rows.ordered_export(monitoring(spark, sf_dir), order).select(*key(), "ingestion_mode", "event_id")
    )


@query(
    "export_guard",
    sql.upto(
        "monitoring",
        """SELECT count(*) AS "rows", count(*) FILTER (ingestion_mode <> 'replay') AS other_modes,
        count(*) >= 1 AND count(*) FILTER (ingestion_mode <> 'replay') = 0 AS allowed
        FROM monitoring""",
    ),
)
def export_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_export(monitoring(spark, sf_dir))


# --- audits and checks --------------------------------------------------------------------


@query(
    "history_audit",
    sql.upto(
        "monitoring",
        f"""SELECT count(*) AS row_count, count(DISTINCT event_id) AS unique_events,
        count(DISTINCT symbol) AS symbols, count(*) FILTER (usd_idr IS NULL) AS missing_fx,
        count(*) FILTER (data_kind <> 'real_historical_replay') AS wrong_mode,
        {sql.text("min(minute_utc)")} AS first_minute, {sql.text("max(minute_utc)")} AS last_minute
        FROM monitoring""",
    ),
)
def history_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.history_audit(monitoring(spark, sf_dir)).withColumns(
        {"first_minute": text("first_minute"), "last_minute": text("last_minute")}
    )


@query(
    "contributions_reconcile",
    sql.upto(
        "risk",
        f"""SELECT {SQL_KEY}, event_id FROM (
          SELECT *, total_change_idr + CASE WHEN price_usd < 10 THEN 0.02 ELSE 0.002 END AS total
          FROM risk)
        WHERE total IS NOT NULL AND (asset_effect_idr IS NULL OR fx_effect_idr IS NULL
          OR interaction_effect_idr IS NULL
          OR abs(total - asset_effect_idr - fx_effect_idr - interaction_effect_idr) > 0.01)""",
    ),
)
def contributions_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals are moved off by an amount that depends on the price, so some rows fail."""
    shift = F.when(F.col("price_usd") < 10, 0.02).otherwise(0.002)
    risk = marts(spark, sf_dir).mart_market_risk()
    moved = risk.withColumn("total_change_idr", F.col("total_change_idr") + shift)
    return quality.contributions_reconcile(moved).select(*key(), "event_id")


@query(
    "no_future_fx",
    sql.upto(
        "exposure",
        """SELECT event_id, fx_join_policy FROM exposure
        WHERE jisdor_date > event_date_wib - 1 OR fx_available_at > event_timestamp
          OR (fx_available_at IS NULL AND jisdor_date >= event_date_wib - 1)""",
    ),
)
def no_future_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are moved back a day after the join, so fresh rates become future ones."""
    fact = marts(spark, sf_dir).fact_market_exposure()
    moved = fact.withColumn("event_date_wib", F.date_sub("event_date_wib", 1))
    return quality.no_future_fx(moved).select("event_id", "fx_join_policy")


@query(
    "monitoring_contract",
    sql.upto(
        "monitoring",
        f"""SELECT {SQL_KEY}, event_id FROM (
          SELECT *, CASE WHEN price_usd > 100 THEN 'WAIT'
                         WHEN price_usd < 5 THEN 'HOLD' ELSE strategy_signal END AS s FROM monitoring)
        WHERE s NOT IN ('BUY', 'SELL', 'HOLD', 'NO_SIGNAL') OR s IS NULL
          OR (data_status <> 'ready' AND s <> 'NO_SIGNAL')
          OR (NOT comparison_complete AND (peer_average_return IS NOT NULL OR peer_rank IS NOT NULL))
          OR signal_available_at < event_timestamp""",
    ),
)
def monitoring_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some signals are overwritten by price, so some rows break the contract."""
    price = F.col("price_usd")
    damaged = (
        F.when(price > 100, "WAIT").when(price < 5, "HOLD").otherwise(F.col("strategy_signal"))
    )
    mart = monitoring(spark, sf_dir).withColumn("strategy_signal", damaged)
    return quality.monitoring_contract(mart).select(*key(), "event_id")


@query(
    "valid_prices",
    sql.upto(
        "stg",
        """SELECT event_id, symbol FROM (SELECT *, price_usd - 5 AS p FROM stg)
        WHERE p <= 0 OR isnan(p) OR isinf(p) OR currency <> 'USD'
          OR symbol NOT IN ('click', 'error', 'purchase', 'view')""",
    ),
)
def valid_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices are lowered by five and one symbol is not declared."""
    stg = marts(spark, sf_dir).stg_prices().withColumn("price_usd", F.col("price_usd") - 5)
    symbols = ["click", "error", "purchase", "view"]
    return quality.valid_prices(stg, symbols).select("event_id", "symbol")


@query(
    "latest_uses_source_time",
    sql.upto(
        "latest",
        f"""SELECT l.symbol, {sql.text("l.minute_utc")} AS minute_utc,
        {sql.text("e.last_minute")} AS last_minute FROM latest l
        JOIN (SELECT symbol, ingestion_mode, record_type,
                max(minute_utc) + to_hours(CASE WHEN symbol < 'f' THEN 1 ELSE 0 END) AS last_minute
              FROM monitoring GROUP BY symbol, ingestion_mode, record_type) e
          USING (symbol, ingestion_mode, record_type)
        WHERE l.minute_utc <> e.last_minute""",
    ),
)
def latest_uses_source_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart is moved an hour ahead for some symbols after the latest rows were taken."""
    chain = marts(spark, sf_dir)
    stored = chain.publish_monitoring()
    hour = F.when(F.col("symbol") < "f", 3600).otherwise(0)
    later = F.timestamp_seconds(F.unix_seconds("minute_utc") + hour)
    moved = stored.withColumn("minute_utc", later)
    return quality.latest_uses_source_time(chain.mart_stock_latest(stored), moved).select(
        *key(), text("last_minute").alias("last_minute")
    )


@query(
    "symbols_collected",
    sql.upto(
        "stg",
        """SELECT count(DISTINCT symbol) AS symbol_count FROM stg
        HAVING count(DISTINCT symbol) <> 4""",
    ),
)
def symbols_collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.symbols_collected(marts(spark, sf_dir).stg_prices(), 4)


@query(
    "not_empty",
    "SELECT count(*) AS row_count FROM events WHERE value < 0 HAVING count(*) = 0",
)
def not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No event has a negative value, so the check of those reports the empty relation."""
    return quality.not_empty(table(spark, sf_dir, "events").where(F.col("value") < 0))


@query(
    "recheck_signals",
    sql.upto(
        "monitoring",
        f"""SELECT count(*) AS "rows",
        count(*) FILTER (strategy_signal IS DISTINCT FROM {sql.SIGNAL_RULE.format(ready=sql.READY)})
          AS mismatches FROM monitoring""",
    ),
)
def recheck_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.recheck_signals(monitoring(spark, sf_dir), RULES)


def _both_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bar's averages through the rule as a column, and through the SQL function."""
    register_signal_function(spark)
    features = marts(spark, sf_dir).int_stock_features()
    names = [
        "moving_average_short", "moving_average_long", "previous_short_ma", "previous_long_ma",
    ]
    averages = [F.col(name) for name in names]
    ready = signal_ready(
        *[F.col(n) for n in ("ma_observation_count", "previous_ma_count", "consecutive_minute")],
        F.col("usd_idr"), RULES.long_bars,
    )
    return features.withColumn("ready", ready).withColumns(
        {
            "strategy_signal": crossover_signal(*averages, F.col("ready")),
            "expected_signal": F.expr(f"crossover_signal({', '.join(names)}, ready)"),
        }
    )


@query(
    "scenario_signals",
    sql.upto(
        "monitoring",
        f"SELECT {SQL_KEY}, strategy_signal, strategy_signal AS expected_signal FROM monitoring",
    ),
)
def scenario_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_rules(spark, sf_dir).select(*key(), "strategy_signal", "expected_signal")


@query(
    "scenario_mismatches",
    sql.upto("features", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS mismatches FROM features"),
)
def scenario_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scenario_mismatches(_both_rules(spark, sf_dir))


@query(
    "readiness",
    sql.upto(
        "latest",
        """SELECT *, CASE WHEN batch_nonempty_unique_valid AND history_nonempty_unique
          AND four_stocks_with_fx AND replay_labelled AND latest_four_aligned
          AND synthetic_scenarios_match THEN 'passed' ELSE 'failed' END AS status
        FROM (SELECT count(*) > 0 AND count(*) = count(DISTINCT jisdor_date)
            AND count(*) FILTER (usd_idr IS NULL OR usd_idr <= 0 OR currency <> 'USD') = 0
            AS batch_nonempty_unique_valid FROM fx),
          (SELECT count(*) > 0 AND count(*) = count(DISTINCT event_id) AS history_nonempty_unique,
            count(DISTINCT symbol) = 5 AND count(*) FILTER (usd_idr IS NULL) = 0
              AS four_stocks_with_fx,
            count(*) FILTER (data_kind <> 'real_historical_replay') = 0 AS replay_labelled
           FROM monitoring),
          (SELECT count(*) = 5 AND coalesce(bool_and(aligned_with_latest AND comparison_complete), false)
            AS latest_four_aligned FROM latest),
          (SELECT true AS synthetic_scenarios_match)""",
    ),
)
def readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = marts(spark, sf_dir)
    stored = chain.publish_monitoring()
    return reports.readiness(
        chain.fx, stored, chain.mart_stock_latest(stored), quality.signal_scenarios(spark),
        RULES.universe_size,
    )


# --- rates --------------------------------------------------------------------------------


@query("top_fx", sql.with_fx(f"""SELECT {sql.day("jisdor_date")} AS jisdor_date, currency,
    {sql_rounded("usd_idr")} FROM fx ORDER BY fx.jisdor_date DESC LIMIT 10"""))
def top_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.top_fx(fx_fact(spark, sf_dir)).select(
        day("jisdor_date").alias("jisdor_date"), "currency", *rounded("usd_idr")
    )


@query("fx_audit", sql.with_fx(f"""SELECT count(*) AS row_count,
    count(DISTINCT jisdor_date) AS dates, {sql.day("min(jisdor_date)")} AS first_date,
    {sql.day("max(jisdor_date)")} AS last_date,
    count(*) FILTER (usd_idr IS NULL OR usd_idr <= 0 OR currency <> 'USD') AS invalid FROM fx"""))
def fx_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fx_audit(fx_fact(spark, sf_dir)).withColumns(
        {"first_date": day("first_date"), "last_date": day("last_date")}
    )


@query("rates_per_date", sql.with_fx(f"""SELECT {sql.day("jisdor_date")} AS jisdor_date,
    count(*) AS row_count, round(CAST(max(usd_idr) AS DOUBLE), 6) AS usd_idr
    FROM fx WHERE currency = 'USD' GROUP BY fx.jisdor_date"""))
def rates_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rates_per_date(fx_fact(spark, sf_dir)).select(
        day("jisdor_date").alias("jisdor_date"), "row_count", *rounded("usd_idr")
    )


@query("first_date", sql.with_fx(f"SELECT {sql.day('min(jisdor_date)')} AS first_date FROM fx"))
def first_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.first_date(fx_fact(spark, sf_dir)).withColumn("first_date", day("first_date"))


_COVERAGE = f"""
coverage AS (
  SELECT d AS calendar_date, coalesce(n, 0) AS row_count, usd_idr,
    CASE WHEN n > 1 THEN 'duplicate' WHEN n = 1 THEN 'available'
         WHEN d = DATE '{AS_OF}' THEN 'today_not_available_yet'
         WHEN dayofweek(d) IN (0, 6) THEN 'weekend_no_record'
         ELSE 'weekday_missing_unverified' END AS coverage_status
  FROM (SELECT CAST(unnest(generate_series((SELECT min(jisdor_date) FROM fx)::TIMESTAMP,
          TIMESTAMP '{AS_OF}', INTERVAL 1 DAY)) AS DATE) AS d)
  LEFT JOIN (SELECT jisdor_date, count(*) AS n, max(usd_idr) AS usd_idr FROM fx
             WHERE currency = 'USD' GROUP BY jisdor_date) ON d = jisdor_date)"""


@query("date_coverage", sql.with_fx(f"""SELECT {sql.day("calendar_date")} AS calendar_date,
    row_count, {sql_rounded("usd_idr")}, coverage_status FROM coverage""", _COVERAGE))
def date_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.date_coverage(fx_fact(spark, sf_dir), AS_OF).select(
        day("calendar_date").alias("calendar_date"), "row_count", *rounded("usd_idr"),
        "coverage_status",
    )


def _list(label: str) -> str:
    return (f"coalesce(string_agg(CAST(calendar_date AS VARCHAR), ',' ORDER BY calendar_date) "
            f"FILTER (coverage_status = '{label}'), '')")


@query("coverage_report", sql.with_fx(f"""SELECT {_list("duplicate")} AS duplicate_dates,
    {_list("weekday_missing_unverified")} AS weekday_gaps_to_review,
    (SELECT coalesce(string_agg(CAST(d AS VARCHAR), ',' ORDER BY d), '') FROM (
       SELECT DISTINCT d FROM local_days
       WHERE d NOT IN (SELECT calendar_date FROM coverage WHERE row_count > 0)))
      AS confirmed_missing_published_dates,
    'failed' AS status FROM coverage""", _COVERAGE))
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every local day with events counts as published, so weekends are missing dates."""
    from fxtape import constants as c
    from fxtape.functions.scalars import local_date
    from fxtape.shared import published
    from registry.tables import utc

    fx = published(fx_fact(spark, sf_dir), "fx")
    days = table(spark, sf_dir, "events").select(
        local_date(utc("ts"), c.LOCAL_ZONE).alias("jisdor_date")
    )
    report = quality.coverage_report(quality.date_coverage(fx, AS_OF), days)
    lists = [name for name, kind in report.dtypes if kind.startswith("array")]
    return report.withColumns({name: F.concat_ws(",", name) for name in lists})


@query("key_quality", sql.with_fx(f"""SELECT count(*) AS total_rows,
    count(*) - count(DISTINCT strftime(jisdor_date, '%Y-%m-%d') || '|' || currency)
      AS duplicate_keys,
    count(*) FILTER (usd_idr <= 0 OR currency <> 'USD' OR ingested_at IS NULL) AS invalid_rows,
    {sql.day("min(jisdor_date)")} AS first_date, {sql.day("max(jisdor_date)")} AS last_date
    FROM fx"""))
def key_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.key_quality(
        fx_fact(spark, sf_dir), ["jisdor_date", "currency"], quality.fx_invalid()
    )
    return checked.withColumns({"first_date": day("first_date"), "last_date": day("last_date")})
