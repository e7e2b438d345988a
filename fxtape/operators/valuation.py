"""Minute table, stock dimension, as-of exchange rate and valuation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.functions.labels import fx_policy, valuation_status
from fxtape.functions.scalars import (
    as_double,
    bar_start,
    days_between,
    local_date,
    local_midnight,
)
from fxtape.rules import MarketRules
from fxtape.schemas import STOCK


def dim_stock(spark: SparkSession, rows: list | None = None) -> DataFrame:
    """The stock dimension as an inline relation."""
    return spark.createDataFrame(rows or [stock[:3] for stock in c.STOCKS], STOCK)


def join_stock(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Company name by symbol and currency, kept NULL for stocks outside the dimension.

    Unhinted: Catalyst broadcasts the dimension when its known size is below the session's
    threshold and shuffles both sides, with skew splitting, when it is not.
    """
    return df.join(dim.select("symbol", "currency", "company_name"), ["symbol", "currency"], "left")


def minute_columns(df: DataFrame, rules: MarketRules) -> DataFrame:
    """Bar start, local date and trading session of every event."""
    ts = F.col("event_timestamp")
    session = local_date(ts, rules.session_zone)
    if rules.session_unit != "day":
        session = F.to_date(F.date_trunc(rules.session_unit, session))
    return df.withColumns(
        {
            "minute_utc": bar_start(ts, rules.bar_seconds),
            "event_date_wib": local_date(ts, rules.local_zone),
            "session_date": session,
        }
    )


def _stamped(rates: DataFrame, zone: str) -> DataFrame:
    """Every rate with the instant from which it may be used.

    A rate with a known publication counts from then on, but not before its own date begins in
    ``zone``; one without counts from the next local midnight.
    """
    available = F.greatest("fx_available_at", local_midnight(F.col("jisdor_date"), zone))
    assumed = local_midnight(F.date_add("jisdor_date", 1), zone)
    known = rates.where(F.col("jisdor_date").isNotNull() & F.col("currency").isNotNull())
    return known.select(
        "currency",
        F.when(F.col("fx_available_at").isNull(), assumed).otherwise(available).alias("valid_from"),
        F.struct("jisdor_date", "usd_idr", "fx_available_at", "source_run_id").alias("rate"),
    )


def fx_intervals(rates: DataFrame, zone: str = c.LOCAL_ZONE) -> DataFrame:
    """For every currency, which rate counts from when until when.

    A late publication of an older date never replaces a newer date, hence the running maximum by
    date. Rates are first reduced to one per currency and instant, which for daily rates is about
    one per calendar day, and that is what a currency's window partition holds.
    """
    per_instant = (
        _stamped(rates, zone).groupBy("currency", "valid_from").agg(F.max("rate").alias("rate"))
    )
    timeline = W.partitionBy("currency").orderBy("valid_from")
    so_far = timeline.rowsBetween(W.unboundedPreceding, W.currentRow)
    return per_instant.select(
        "currency",
        "valid_from",
        F.lead("valid_from").over(timeline).alias("valid_until"),
        F.max("rate").over(so_far).alias("rate"),
    ).select("currency", "valid_from", "valid_until", "rate.*")


def asof_fx(events: DataFrame, rates: DataFrame, zone: str = c.LOCAL_ZONE) -> DataFrame:
    """The rate in force at each event, NULL and labelled when there is none.

    Rate intervals do not overlap, so an event meets at most one of them and is neither ranked
    nor multiplied. They are spread over the days they touch and joined by currency and day,
    which leaves an event a few intervals to test instead of the whole history. Days after the
    last change of any rate all share the last day's intervals.

    One lazy plan: the last day is a subquery, and the join carries no hint. Where the rates are
    too large to broadcast, a currency and day holds a few rate rows, so adaptive execution splits
    the events of a busy one, or those after the last change, over as many tasks as they need.
    """
    intervals = fx_intervals(rates, zone)
    start = F.to_date("valid_from")
    changes = _stamped(rates, zone).agg(F.max(start).alias("last"))
    last_day = F.coalesce(changes.scalar(), F.current_date())
    end = F.least(F.coalesce(F.to_date("valid_until"), last_day), last_day)
    by_day = intervals.select(
        F.col("currency").alias("_currency"),
        F.explode(F.sequence(start, end)).alias("_day"),
        "valid_from",
        "valid_until",
        "jisdor_date",
        "usd_idr",
        "fx_available_at",
        F.col("source_run_id").alias("fx_source_run_id"),
    )
    ts = F.col("event_timestamp")
    matches = (
        (F.col("currency") == F.col("_currency"))
        & (F.least(F.to_date(ts), last_day) == F.col("_day"))
        & (ts >= F.col("valid_from"))
        & (F.col("valid_until").isNull() | (ts < F.col("valid_until")))
    )
    joined = events.join(by_day, matches, "left")
    helpers = ["_currency", "_day", "valid_from", "valid_until"]
    return joined.drop(*helpers).withColumn(
        "fx_join_policy", fx_policy(F.col("jisdor_date"), F.col("fx_available_at"))
    )


def valuation(df: DataFrame, quantity: int = 1) -> DataFrame:
    """Value in local currency, age of the rate in days, and whether there is a value at all."""
    return df.withColumns(
        {
            "quantity": F.lit(quantity),
            "exposure_idr": F.col("price_usd") * as_double(F.col("usd_idr")) * F.lit(quantity),
            "fx_age_calendar_days": days_between(F.col("event_date_wib"), F.col("jisdor_date")),
            "valuation_status": valuation_status(F.col("usd_idr")),
        }
    )
