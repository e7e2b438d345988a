"""Small builders for literal fixtures."""

from __future__ import annotations

from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from fxtape.schemas import FX_FACT


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def fx_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rates from (date, rate, available_at) with optional currency and ingestion time."""
    built = []
    for row in rows:
        day, rate, available = row[:3]
        currency = row[3] if len(row) > 3 else "USD"
        ingested = row[4] if len(row) > 4 else "2026-09-10T00:00:00"
        built.append(
            (
                date.fromisoformat(day), currency, Decimal(str(rate)), "fixture", ts(ingested),
                ts(available) if available else None, "20260909T214210877646Z",
            )
        )
    return spark.createDataFrame(built, FX_FACT)


def by(df: DataFrame, key: str) -> dict:
    return {row[key]: row for row in df.collect()}
