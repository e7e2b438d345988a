"""Explicit schemas of every relation that is read or written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fxtape import constants as c

RATE = T.DecimalType(38, 9)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in fields])


_STRING, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
_DATE, _TIME, _BYTES = T.DateType(), T.TimestampType(), T.BinaryType()

FX_DOCUMENT = _struct(
    (c.FX_DATE_TAG, _STRING, True),
    (c.FX_CURRENCY_TAG, _STRING, True),
    (c.FX_RATE_TAG, _STRING, True),
)

FX_RECORD_TEXT = _struct(
    ("jisdor_date", _STRING, True),
    ("currency", _STRING, True),
    ("usd_idr", _STRING, True),
    ("source", _STRING, True),
    ("ingested_at", _STRING, True),
    ("fx_available_at", _STRING, True),
)

FX_RATE = _struct(("jisdor_date", _DATE, True), ("currency", _STRING, True), ("usd_idr", RATE, True))

FX_FACT = _struct(
    ("jisdor_date", _DATE, False),
    ("currency", _STRING, False),
    ("usd_idr", RATE, False),
    ("source", _STRING, False),
    ("ingested_at", _TIME, False),
    ("fx_available_at", _TIME, True),
    ("source_run_id", _STRING, False),
)

BAR = _struct(
    ("symbol", _STRING, True),
    ("bar_start_utc", _STRING, True),
    ("price_usd", _DOUBLE, True),
    ("volume", _LONG, True),
    ("source", _STRING, True),
    ("source_interval", _STRING, True),
    ("record_type", _STRING, True),
    ("currency", _STRING, True),
)

BAR_STORED = T.StructType([*BAR.fields, T.StructField("bar_date", _DATE, True)])

TICK = _struct(
    ("id", _STRING, True),
    ("price", _DOUBLE, True),
    ("currency", _STRING, True),
    ("time", _LONG, True),
)

ENVELOPE = _struct(
    ("value_base64", _STRING, True),
    ("kafka_topic", _STRING, True),
    ("kafka_partition", _LONG, True),
    ("kafka_offset", _LONG, True),
)

# The shape of a Kafka read.
MESSAGE = _struct(
    ("key", _BYTES, True),
    ("value", _BYTES, True),
    ("topic", _STRING, True),
    ("partition", T.IntegerType(), True),
    ("offset", _LONG, True),
    ("timestamp", _TIME, True),
)

MARKET_EVENT = _struct(
    ("schema_version", _LONG, True),
    ("event_id", _STRING, True),
    ("symbol", _STRING, True),
    ("currency", _STRING, True),
    ("price_usd", _DOUBLE, True),
    ("event_timestamp", _TIME, True),
    ("event_date", _DATE, True),
    ("ingested_at", _TIME, True),
    ("replayed_at", _TIME, True),
    ("source", _STRING, True),
    ("record_type", _STRING, True),
    ("source_interval", _STRING, True),
    ("ingestion_mode", _STRING, True),
    ("raw_payload", _STRING, True),
    ("kafka_topic", _STRING, True),
    ("kafka_partition", _LONG, True),
    ("kafka_offset", _LONG, True),
)

RUN_EVENT = T.StructType(
    MARKET_EVENT.fields
    + [
        T.StructField("demo_run_id", _STRING),
        T.StructField("consumer_received_at", _TIME),
        T.StructField("sink_requested_at", _TIME),
    ]
)

STOCK = _struct(
    ("symbol", _STRING, False),
    ("company_name", _STRING, True),
    ("currency", _STRING, False),
)

MANIFEST_OBJECT = _struct(
    ("name", _STRING, True),
    ("content_type", _STRING, True),
    ("sha256", _STRING, True),
    ("bytes", _LONG, True),
)

MANIFEST = T.StructType(
    [
        T.StructField("run_id", _STRING),
        T.StructField("records", _LONG),
        T.StructField("source", _STRING),
        T.StructField("objects", T.ArrayType(MANIFEST_OBJECT)),
    ]
)


def same_columns(df: DataFrame, schema: T.StructType) -> bool:
    """Same names and types in the same order; nullability is left to the checks."""
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Refuse a frame whose columns differ from the declared ones."""
    if not same_columns(df, schema):
        raise ValueError(
            f"schema differs: expected {schema.simpleString()}, got {df.schema.simpleString()}"
        )
    return df
