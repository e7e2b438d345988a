"""The domain relations, derived by Spark from the given tables.

``registry/sql.py`` states the same derivations in SQL. Mapping: an event type is a symbol, an
event value a price. Every event is delivered twice, the second time later or elsewhere, so the
deduplication has work to do. The reference rate of a business day comes from that day's events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fxtape import MarketRules, pin_utc
from fxtape import constants as c
from fxtape.functions.scalars import local_date
from fxtape.plans.marts import Marts
from fxtape.schemas import MARKET_EVENT, RATE, STOCK
from fxtape.shared import published

# Hourly bars and weekly sessions give the events table enough history per session.
RULES = MarketRules(bar_seconds=3600, session_unit="week", universe_size=5)
SMOKE_RULES = MarketRules(bar_seconds=14400, session_unit="week", universe_size=5)
AS_OF = "2024-02-01"
RUN_ID = "20240201T210000000000Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def utc(column: str) -> Column:
    """A zone-less timestamp read as UTC."""
    return F.col(column).cast("timestamp")


def text(column: str) -> Column:
    """A timestamp or date as text, the same on every engine."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def raw_market(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    """Market events, each delivered twice."""
    events = table(spark, sf_dir, "events").withColumn(
        "delivery", F.explode(F.array(F.lit(0), F.lit(1)))
    )
    ts, first = utc("ts"), F.col("delivery") == 0
    late_minutes = F.when(first, 60).otherwise(60 + F.col("event_id") % 2)
    ingested = F.timestamp_micros(F.unix_micros(ts) + late_minutes * 60_000_000)
    partition = F.when(first, F.col("user_id") % 3).otherwise(F.col("user_id") % 2)
    columns = {
        "schema_version": F.lit(c.SCHEMA_VERSION).cast("long"),
        "event_id": F.col("event_id").cast("string"),
        "symbol": F.col(symbol).cast("string"),
        "currency": F.lit(c.CURRENCY),
        "price_usd": F.col("value"),
        "event_timestamp": ts,
        "event_date": F.to_date(ts),
        "ingested_at": ingested,
        "replayed_at": ingested,
        "source": F.lit(c.EVENT_SOURCE),
        "record_type": F.lit(c.BAR_RECORD),
        "source_interval": F.lit(c.BAR_INTERVAL),
        "ingestion_mode": F.lit(c.REPLAY_MODE),
        "raw_payload": F.col("props"),
        "kafka_topic": F.lit("events"),
        "kafka_partition": partition.cast("long"),
        "kafka_offset": F.col("event_id") * 2 + F.col("delivery"),
    }
    return events.select(*[columns[f.name].alias(f.name) for f in MARKET_EVENT])


def stocks(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    """The stock dimension: every symbol that occurs."""
    events = table(spark, sf_dir, "events")
    name = F.col(symbol).cast("string")
    return events.select(
        name.alias("symbol"),
        F.concat(F.lit("Company "), name).alias("company_name"),
        F.lit(c.CURRENCY).alias("currency"),
    ).distinct().select(*STOCK.names)


def fx_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per business day, from all events of the local day.

    Weekend events count for Monday; the 17th is taken as a holiday, its events count for the
    18th. Rates of odd days have a known publication at 09:00 UTC, those of even days have none.
    """
    local = F.col("local")
    moved = (
        F.when(F.dayofweek(local) == 7, F.date_add(local, 2))
        .when(F.dayofweek(local) == 1, F.date_add(local, 1))
        .when(F.dayofmonth(local) == 17, F.date_add(local, 1))
        .otherwise(local)
    )
    daily = (
        table(spark, sf_dir, "events")
        .withColumn("local", local_date(utc("ts"), c.LOCAL_ZONE))
        .select(moved.alias("jisdor_date"), F.round(F.col("value") * 100).cast("long").alias("cents"))
        .groupBy("jisdor_date")
        .agg(F.sum("cents").alias("cents"))
    )
    noon = F.col("jisdor_date").cast("timestamp")
    published_at = F.timestamp_seconds(F.unix_seconds(noon) + 9 * 3600)
    return daily.select(
        "jisdor_date",
        F.lit(c.CURRENCY).alias("currency"),
        (F.lit(15000) + (F.col("cents") % 100000).cast("decimal(20,2)") / 100)
        .cast(RATE)
        .alias("usd_idr"),
        F.lit("daily events").alias("source"),
        F.timestamp_seconds(F.unix_seconds(noon) + 21 * 3600).alias("ingested_at"),
        F.when(F.dayofmonth("jisdor_date") % 2 == 1, published_at).alias("fx_available_at"),
        F.concat(F.date_format("jisdor_date", "yyyyMMdd"), F.lit("T210000000000Z")).alias(
            "source_run_id"
        ),
    )


def marts(
    spark: SparkSession, sf_dir: str, rules: MarketRules = RULES, symbol: str = "event_type"
) -> Marts:
    """The mart chain; rates and dimension are stored first, as they are in production."""
    fx = published(fx_fact(spark, sf_dir), "fact_jisdor_daily")
    dim = published(stocks(spark, sf_dir, symbol), "dim_stock")
    return Marts(raw_market(spark, sf_dir, symbol), fx, dim, rules)
