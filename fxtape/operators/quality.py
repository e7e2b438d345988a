"""Data-quality checks. Row checks return the violating rows, so an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.functions.labels import coverage_status, crossover_signal
from fxtape.functions.scalars import differs, is_bad_number, is_run_id, try_rate, zoned_time
from fxtape.rules import MarketRules


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Repeated combinations; missing values are left to ``not_null``."""
    present = df
    for name in cols:
        present = present.where(F.col(name).isNotNull())
    return duplicate_keys(present, cols)


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def relationship(df: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose value is not a key of the parent."""
    keys = parent.select(F.col(key).alias("_parent"))
    return df.where(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("_parent"), "left_anti")


def accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is not among the accepted ones."""
    return df.where(~F.col(col).isin(list(values)))


def contributions_reconcile(risk: DataFrame, tol: float = 0.01) -> DataFrame:
    """Rows whose three effects do not add up to the total change."""
    parts = F.col("asset_effect_idr") + F.col("fx_effect_idr") + F.col("interaction_effect_idr")
    off = F.abs(F.col("total_change_idr") - parts)
    return risk.where(F.col("total_change_idr").isNotNull() & F.coalesce(off > tol, F.lit(True)))


def symbol_count(df: DataFrame, n: int) -> DataFrame:
    """The number of symbols, as a row, when it is not ``n``."""
    counted = df.agg(F.countDistinct("symbol").alias("symbol_count"))
    return counted.where(F.col("symbol_count") != n)


def symbols_collected(mart: DataFrame, n: int = len(c.SYMBOLS)) -> DataFrame:
    return symbol_count(mart, n)


def latest_mismatch(latest: DataFrame, mart: DataFrame) -> DataFrame:
    """Latest rows that are not at the last bar of their symbol, mode and type."""
    keys = ["symbol", "ingestion_mode", "record_type"]
    last = mart.groupBy(*keys).agg(F.max("minute_utc").alias("last_minute"))
    return latest.join(last, keys).where(F.col("minute_utc") != F.col("last_minute"))


latest_uses_source_time = latest_mismatch


def is_empty(df: DataFrame) -> DataFrame:
    """One row with the count 0 when there is nothing, no row otherwise."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") == 0)


def not_empty(df: DataFrame) -> DataFrame:
    return is_empty(df)


def no_future_fx(fact: DataFrame) -> DataFrame:
    """Rows valued with a rate that was not known at their time."""
    rate_day, local_day = F.col("jisdor_date"), F.col("event_date_wib")
    available = F.col("fx_available_at")
    return fact.where(
        (rate_day > local_day)
        | (available > F.col("event_timestamp"))
        | (available.isNull() & (rate_day == local_day))
    )


def scenarios_match(df: DataFrame) -> DataFrame:
    """Rows whose signal is not the expected one."""
    return df.where(differs(F.col("strategy_signal"), F.col("expected_signal")))


def monitoring_contract(mart: DataFrame) -> DataFrame:
    """Rows that break what the monitoring mart promises."""
    signal, ready = F.col("strategy_signal"), F.col("data_status") == "ready"
    known = F.coalesce(signal.isin(c.SIGNALS), F.lit(False))
    compared = F.col("peer_average_return").isNotNull() | F.col("peer_rank").isNotNull()
    return mart.where(
        ~known
        | (~ready & (signal != c.SIGNALS[-1]))
        | (~F.col("comparison_complete") & compared)
        | (F.col("signal_available_at") < F.col("event_timestamp"))
    )


def valid_prices(
    df: DataFrame, symbols: Sequence[str] = tuple(c.SYMBOLS), currency: str = c.CURRENCY
) -> DataFrame:
    """Rows with an impossible price or a foreign symbol or currency."""
    price = F.col("price_usd")
    return df.where(
        (price <= 0)
        | is_bad_number(price)
        | (F.col("currency") != currency)
        | ~F.col("symbol").isin(list(symbols))
    )


def key_quality(df: DataFrame, keys: Sequence[str], invalid: Column, date: str | None = None
                ) -> DataFrame:
    """Rows, surplus rows by key, invalid rows, first and last date, as one row.

    Counts per key first, so the exact distinct count is a partial aggregation.
    """
    day = date or keys[0]
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(invalid, F.lit(True))).alias("bad"),
        F.min(day).alias("first"),
        F.max(day).alias("last"),
    )
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_keys"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_rows"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
    )


def fx_invalid() -> Column:
    """A stored rate that is not positive, not in the expected currency, or of unknown ingestion."""
    return (
        (F.col("usd_idr") <= 0) | (F.col("currency") != c.CURRENCY) | F.col("ingested_at").isNull()
    )


def check_fx_batch(df: DataFrame) -> DataFrame:
    """One row on a normalised batch: rows, bad rows, repeated keys, and whether it is accepted."""
    bad = (
        F.col("jisdor_date").isNull()
        | ~F.col("currency").eqNullSafe(F.lit(c.CURRENCY))
        | ~F.coalesce(F.col("usd_idr") > 0, F.lit(False))
    )
    checked = key_quality(df, ["jisdor_date", "currency"], bad)
    clean = (F.col("duplicate_keys") == 0) & (F.col("invalid_rows") == 0)
    return checked.withColumn("accepted", (F.col("total_rows") > 0) & clean)


_DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_LONG_FRACTION = r"\.\d{10,}\s*$"


def check_fx_record(df: DataFrame) -> DataFrame:
    """Add ``error`` to rate records whose fields are text.

    The number of decimals is checked on the text, as a cast would round surplus digits.
    """
    rate_text = F.col("usd_idr")
    rate = F.when(rate_text.rlike(_DECIMAL_TEXT), try_rate(rate_text))
    plain_scale = ~rate_text.rlike(_LONG_FRACTION)
    exponent_scale = ~rate_text.rlike("[eE]") | (
        rate.cast("decimal(38,9)") == rate_text.try_cast("decimal(38,18)")
    )
    available = F.col("fx_available_at")
    checks = {
        "date": F.col("jisdor_date").rlike(r"^\d{4}-\d{2}-\d{2}$")
        & F.col("jisdor_date").try_cast("date").isNotNull(),
        "rate": (rate > 0) & plain_scale & F.coalesce(exponent_scale, F.lit(True)),
        "currency": F.col("currency") == c.CURRENCY,
        "ingested_at": zoned_time(F.col("ingested_at")).isNotNull(),
        "fx_available_at": available.isNull() | zoned_time(available).isNotNull(),
        "source": F.length("source") > 0,
    }
    broken = [F.when(~F.coalesce(ok, F.lit(False)), code) for code, ok in checks.items()]
    return df.withColumn("error", F.coalesce(*broken))


def outside_interval(df: DataFrame, start: str, end: str, max_days: int = 365) -> DataFrame:
    """Rows dated outside the requested interval; the interval itself spans 0..``max_days``."""
    from datetime import date

    span = (date.fromisoformat(end) - date.fromisoformat(start)).days
    if not 0 <= span <= max_days:
        raise ValueError(f"interval must span 0..{max_days} days")
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return df.where(~F.coalesce(F.col("jisdor_date").between(first, last), F.lit(False)))


def check_processed_vs_raw(raw: DataFrame, processed: DataFrame, source: str) -> DataFrame:
    """Processed rates that do not match the raw document, by date.

    ``raw`` is normalised; ``processed`` holds text records. Both must cover the same dates with
    equal rates, and a processed record needs provenance, a zoned ingestion time and no invented
    publication time.
    """
    told = raw.select("jisdor_date", F.col("usd_idr").alias("raw_rate"))
    made = processed.select(
        F.col("jisdor_date").try_cast("date").alias("jisdor_date"),
        try_rate(F.col("usd_idr")).alias("rate"),
        F.struct("currency", "source", "ingested_at", "fx_available_at").alias("record"),
    )
    problem = (
        F.when(F.col("record").isNull(), "not_processed")
        .when(F.col("raw_rate").isNull(), "not_in_source")
        .when(differs(F.col("rate"), F.col("raw_rate")), "rate")
        .when(differs(F.col("record.currency"), F.lit(c.CURRENCY)), "currency")
        .when(differs(F.col("record.source"), F.lit(source)), "source")
        .when(zoned_time(F.col("record.ingested_at")).isNull(), "ingested_at")
        .when(F.col("record.fx_available_at").isNotNull(), "fx_available_at")
    )
    return (
        told.join(made, "jisdor_date", "full")
        .select("jisdor_date", problem.alias("problem"))
        .where(F.col("problem").isNotNull())
    )


def check_bars(
    df: DataFrame, key: str = "symbol", time: str = "bar_start_utc", number: Sequence[str] = ()
) -> DataFrame:
    """Problems of source bars per symbol: repeated or zone-less times, currency, price.

    ``number`` names what tells bars of one time apart, where a source has that.
    """
    price = F.col("price_usd")
    good_price = F.coalesce(~is_bad_number(price) & (price > 0), F.lit(False))
    per_key = df.groupBy(key, time, *number).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(zoned_time(F.col(time)).isNull()).alias("unzoned"),
        F.count_if(~F.col("currency").eqNullSafe(F.lit(c.CURRENCY))).alias("foreign"),
        F.count_if(~good_price).alias("bad_prices"),
    )
    counted = per_key.groupBy(key).agg(
        F.sum("rows").alias("rows"),
        F.sum(F.col("rows") - 1).alias("repeated_times"),
        F.sum("unzoned").alias("unzoned_times"),
        F.sum("foreign").alias("foreign_currency"),
        F.sum("bad_prices").alias("bad_prices"),
    )
    faults = F.col("repeated_times") + F.col("unzoned_times") + F.col("foreign_currency")
    return counted.where(faults + F.col("bad_prices") > 0)


def check_export(
    df: DataFrame, max_rows: int | None = None, mode: str = c.REPLAY_MODE
) -> DataFrame:
    """One row: export size, foreign modes, and whether the export is allowed.

    Counted over the whole relation; there is a largest size only where the caller names one.
    """
    probed = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("ingestion_mode").eqNullSafe(F.lit(mode))).alias("other_modes"),
    )
    fits = F.col("rows") >= 1 if max_rows is None else F.col("rows").between(1, max_rows)
    allowed = fits & (F.col("other_modes") == 0)
    return probed.withColumn("allowed", allowed)


def recheck_signals(mart: DataFrame, rules: MarketRules = MarketRules()) -> DataFrame:
    """Every signal computed again from the stored columns, by the sign of the averages' gap.

    One row: rows and mismatches.
    """
    gap = F.signum(F.col("moving_average_short") - F.col("moving_average_long"))
    before = F.signum(F.col("previous_short_ma") - F.col("previous_long_ma"))
    turned = F.coalesce((gap != 0) & (gap * before <= 0), F.lit(False))
    usable = (
        F.col("ma_observation_count").eqNullSafe(F.lit(rules.long_bars))
        & F.col("previous_ma_count").eqNullSafe(F.lit(rules.long_bars))
        & F.col("consecutive_minute").eqNullSafe(F.lit(True))
        & F.col("usd_idr").isNotNull()
    )
    buy, sell, hold, none = c.SIGNALS
    expected = (
        F.when(~usable, none).when(turned & (gap > 0), buy).when(turned, sell).otherwise(hold)
    )
    return mart.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(differs(expected, F.col("strategy_signal"))).alias("mismatches"),
    )


def signal_scenarios(spark) -> DataFrame:
    """The literal signal scenarios with the signal the rule gives them."""
    names = ["scenario_id", "short_ma", "long_ma", "prev_short", "prev_long", "ready", "expected_signal"]
    scenarios = spark.createDataFrame(c.SIGNAL_SCENARIOS, names)
    inputs = [F.col(name) for name in names[1:6]]
    return scenarios.withColumns(
        {
            "strategy_signal": crossover_signal(*inputs),
            "data_kind": F.lit(c.SCENARIO_DATA_KIND),
            "signal_rule_version": F.lit(c.SIGNAL_RULE_VERSION),
        }
    )


def scenario_mismatches(df: DataFrame) -> DataFrame:
    wrong = differs(F.col("strategy_signal"), F.col("expected_signal"))
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(wrong).alias("mismatches"))


def rates_per_date(fx: DataFrame, currency: str = c.CURRENCY) -> DataFrame:
    """Rows and highest rate of every date, for one currency."""
    return (
        fx.where(F.col("currency") == currency)
        .groupBy("jisdor_date")
        .agg(F.count(F.lit(1)).alias("row_count"), F.max("usd_idr").alias("usd_idr"))
    )


def first_date(fx: DataFrame) -> DataFrame:
    return fx.agg(F.min("jisdor_date").alias("first_date"))


def date_coverage(fx: DataFrame, as_of: str, currency: str = c.CURRENCY) -> DataFrame:
    """Every calendar date from the first rate to ``as_of`` with its rates and a label."""
    last = F.lit(as_of).cast("date")
    calendar = first_date(fx).where(F.col("first_date") <= last).select(
        F.explode(F.sequence("first_date", last)).alias("calendar_date")
    )
    facts = rates_per_date(fx, currency)
    return calendar.join(facts, F.col("calendar_date") == F.col("jisdor_date"), "left").select(
        "calendar_date",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "usd_idr",
        coverage_status(F.col("row_count"), F.col("calendar_date"), last).alias("coverage_status"),
    )


def missing_published(coverage: DataFrame, published: DataFrame) -> DataFrame:
    """Published dates for which no rate is stored."""
    found = coverage.where(F.col("row_count") > 0).select("calendar_date")
    dates = published.select(F.col("jisdor_date").alias("calendar_date")).distinct()
    return dates.join(found, "calendar_date", "left_anti")


def coverage_report(coverage: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """One row: repeated dates, published dates that are missing, weekdays to review, status.

    The lists hold calendar dates, at most one per day of the calendar.
    """
    repeated, unverified = c.COVERAGE_LABELS[0], c.COVERAGE_LABELS[-1]

    def dates(label: str) -> Column:
        hit = F.col("coverage_status") == label
        return F.array_sort(F.collect_list(F.when(hit, F.col("calendar_date").cast("string"))))

    report = coverage.agg(
        dates(repeated).alias("duplicate_dates"), dates(unverified).alias("weekday_gaps_to_review")
    )
    if published is None:
        lost = F.array().cast("array<string>")
        report = report.withColumn("confirmed_missing_published_dates", lost)
    else:
        lost = missing_published(coverage, published).agg(
            F.array_sort(F.collect_list(F.col("calendar_date").cast("string"))).alias(
                "confirmed_missing_published_dates"
            ),
            F.lit(1).alias("_one"),
        )
        report = report.withColumn("_one", F.lit(1)).join(lost, "_one").drop("_one")
    faults = F.size("duplicate_dates") + F.size("confirmed_missing_published_dates")
    return report.withColumn("status", F.when(faults > 0, "failed").otherwise("passed"))


def bad_run_ids(df: DataFrame, column: str = "source_run_id") -> DataFrame:
    """Rows whose run id has the wrong form."""
    return df.where(~F.coalesce(is_run_id(F.col(column)), F.lit(False)))
