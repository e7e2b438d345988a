"""Replay bars: completeness, overlap, sessions and staleness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.functions.scalars import add_seconds, local_date


def completed_bars(
    df: DataFrame, as_of: Column, bar_seconds: int = 60, start: str = "bar_start"
) -> DataFrame:
    """Bars that have ended by ``as_of``."""
    return df.where(add_seconds(F.col(start), bar_seconds) <= as_of)


def symbol_coverage(bars: DataFrame, key: str = "symbol", time: str = "bar_start") -> DataFrame:
    """Rows, first and last bar of every symbol."""
    return bars.groupBy(key).agg(
        F.count(F.lit(1)).alias("downloaded"), F.min(time).alias("first"), F.max(time).alias("last")
    )


def overlap_period(df: DataFrame, key: str, time: str) -> DataFrame:
    """The period all symbols share: latest first and earliest last bar, as one row."""
    return symbol_coverage(df, key, time).agg(
        F.max("first").alias("overlap_first"), F.min("last").alias("overlap_last")
    )


def align_overlap(df: DataFrame, key: str = "symbol", time: str = "bar_start") -> DataFrame:
    """Rows inside the period all symbols share; no row when there is none.

    The period is a scalar subquery, so the filter needs no join and no shuffle.
    """
    period = overlap_period(df, key, time)
    first, last = period.select("overlap_first").scalar(), period.select("overlap_last").scalar()
    return df.where((F.col(time) >= first) & (F.col(time) <= last))


def latest_sessions(
    df: DataFrame, n: int = 5, zone: str = c.SESSION_ZONE, time: str = "bar_start"
) -> DataFrame:
    """Rows of the last ``n`` session dates.

    The ``n`` dates come from a distinct over dates, and the oldest of them is a scalar, so the
    rows themselves are only filtered.
    """
    session = local_date(F.col(time), zone)
    dates = df.select(session.alias("_session")).distinct().orderBy(F.desc("_session")).limit(n)
    oldest = dates.agg(F.min("_session").alias("_oldest")).scalar()
    return df.where(session >= oldest)


def window_violations(
    df: DataFrame, required: Sequence[str] = tuple(c.SYMBOLS), max_rows: int | None = None
) -> DataFrame:
    """One row on an active window: rows, required symbols that are absent, unexpected ones, and
    whether it is accepted.

    Counted by symbol first, so only distinct symbols are compared. A largest size holds only where
    the caller names one.
    """
    wanted = F.col("symbol").isin(list(required))
    counted = (
        df.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            (F.lit(len(set(required))) - F.count_if(wanted)).alias("absent_symbols"),
            F.count_if(~F.coalesce(wanted, F.lit(False))).alias("foreign_symbols"),
        )
    )
    complete = (F.col("absent_symbols") == 0) & (F.col("foreign_symbols") == 0)
    fits = F.col("rows") >= 1 if max_rows is None else F.col("rows").between(1, max_rows)
    return counted.withColumn("accepted", fits & complete)


def is_stale(incoming: DataFrame, archive: DataFrame, time: str = "bar_start") -> DataFrame:
    """One row: newest incoming and archived bar, and whether the incoming data is older."""
    archived = archive.agg(F.max(time)).scalar()
    older = F.col("newest_incoming") < F.col("newest_archived")
    return (
        incoming.agg(F.max(time).alias("newest_incoming"))
        .withColumn("newest_archived", archived)
        .withColumn("stale", F.coalesce(older, F.lit(False)))
    )
