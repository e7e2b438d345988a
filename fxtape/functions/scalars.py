"""Scalar column functions: time, numbers, text. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fxtape import constants as c

# --- time -------------------------------------------------------------------------------


def epoch(ts: Column) -> Column:
    return F.unix_seconds(ts)


def bar_start(ts: Column, seconds: int = 60) -> Column:
    """Start of the bar of ``seconds`` length that holds ``ts``."""
    if seconds == 60:
        return F.date_trunc("minute", ts)
    return F.timestamp_seconds(F.floor(epoch(ts) / F.lit(seconds)) * F.lit(seconds))


def local_date(ts: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def local_midnight(day: Column, zone: str) -> Column:
    """The instant at which ``day`` begins in ``zone``."""
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def seconds_between(later: Column, earlier: Column) -> Column:
    return epoch(later) - epoch(earlier)


def add_seconds(ts: Column, seconds: int) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(seconds))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def day_of_week(day: Column) -> Column:
    """Sunday is 1, Saturday is 7."""
    return F.dayofweek(day)


def date_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per calendar date, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("calendar_date"))


def from_millis(n: Column) -> Column:
    return F.timestamp_millis(n)


_OFFSET = r"(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)$"


def zoned_time(text: Column) -> Column:
    """ISO-8601 text to an instant; NULL when it does not parse or names no offset."""
    return F.when(text.rlike(_OFFSET), F.try_to_timestamp(text))


def iso_text(ts: Column) -> Column:
    """``2026-09-02T13:30:00+00:00``, with six digits of fraction only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(exact)


def is_run_id(text: Column) -> Column:
    return text.rlike(c.RUN_ID_PATTERN)


def run_time(run_id: Column) -> Column:
    """The instant written into a run id, NULL for anything that is not one."""
    return F.when(is_run_id(run_id), F.try_to_timestamp(run_id, F.lit("yyyyMMdd'T'HHmmssSSSSSSX")))


# --- numbers ----------------------------------------------------------------------------


def choose(condition: Column, yes: Column, no: Column) -> Column:
    return F.when(condition, yes).otherwise(no)


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def as_double(x: Column) -> Column:
    return x.cast("double")


def is_bad_number(x: Column) -> Column:
    """NaN or infinite; false for NULL, as a separate check covers missing values."""
    return F.coalesce(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(False))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~is_bad_number(x)


def differs(a: Column, b: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)


def in_set(x: Column, values: Sequence) -> Column:
    return x.isin(list(values))


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


def try_rate(text: Column) -> Column:
    """Text to the rate type; NULL when it is no number or out of range."""
    return text.try_cast(T.DecimalType(38, 9))


def try_time(text: Column) -> Column:
    return F.try_to_timestamp(text)


# --- text -------------------------------------------------------------------------------


def clean_code(text: Column) -> Column:
    return F.upper(F.trim(text))


def key_text(*parts: Column) -> Column:
    """The parts as one text, joined by a bar."""
    return F.concat_ws("|", *[part.cast("string") for part in parts])


def sha256_hex(x: Column) -> Column:
    return F.sha2(x, 256)


def b64(data: Column) -> Column:
    return F.base64(data)


def try_b64(text: Column) -> Column:
    return F.try_to_binary(text, F.lit("base64"))


def utf8_text(data: Column) -> Column:
    """Bytes to text, NULL when they are not UTF-8."""
    return F.try_validate_utf8(data.cast("string"))


def json_text(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def try_json(text: Column, schema: T.StructType) -> Column:
    """JSON object text to a struct; NULL when the text is no strict JSON."""
    return F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, schema))


# Printable ASCII without quote and backslash needs no escape in JSON.
_PLAIN_TEXT = r"^[ !#-\[\]-~]*$"


def json_quoted(text: Column) -> Column:
    """A text as a JSON string literal, ``null`` when it is missing.

    Only texts that need escaping go through the JSON writer.
    """
    array = F.to_json(F.array(text))
    return (
        F.when(text.isNull(), F.lit("null"))
        .when(text.rlike(_PLAIN_TEXT), F.concat(F.lit('"'), text, F.lit('"')))
        .otherwise(F.substring(array, F.lit(2), F.length(array) - 2))
    )
