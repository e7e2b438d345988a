"""Row selection: one row per key, ordering, limits, set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fxtape.functions.scalars import bar_start

BAR_KEYS = ["symbol", "ingestion_mode", "record_type"]


def first_rows(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of every key in the given order.

    Spark cuts each map partition to ``n`` rows per key before the shuffle, so a key that holds
    a large share of all rows still reaches its reducer as a handful of rows.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    return first_rows(df, keys, order, 1)


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per event id: newest ingestion, then lower partition, then higher offset."""
    return keep_first(
        events,
        ["event_id"],
        [
            F.desc_nulls_last("ingested_at"),
            F.asc_nulls_first("kafka_partition"),
            F.desc_nulls_last("kafka_offset"),
        ],
    )


def dedup_run_events(events: DataFrame) -> DataFrame:
    """The read view of the streaming table: one row per run and event, newest sink time wins."""
    return keep_first(
        events,
        ["demo_run_id", "event_id"],
        [F.desc_nulls_last("sink_requested_at"), F.desc_nulls_last("kafka_offset")],
    )


def last_in_bar(events: DataFrame, bar_seconds: int = 60) -> DataFrame:
    """The last observation of every symbol, mode, type and bar.

    Afterwards a session of a symbol holds at most one row per bar, which bounds every session
    window further down.
    """
    if "minute_utc" not in events.columns:
        events = events.withColumn("minute_utc", bar_start(F.col("event_timestamp"), bar_seconds))
    return keep_first(
        events,
        [*BAR_KEYS, "minute_utc"],
        [
            F.desc_nulls_last("event_timestamp"),
            F.desc_nulls_last("ingested_at"),
            F.desc_nulls_last("event_id"),
        ],
    )


def latest_per(df: DataFrame, keys: Sequence[str] = tuple(BAR_KEYS)) -> DataFrame:
    """The latest row of every key by source time."""
    return keep_first(
        df,
        list(keys),
        [
            F.desc_nulls_last("minute_utc"),
            F.desc_nulls_last("ingested_at"),
            F.desc_nulls_last("event_id"),
        ],
    )


def last_rows(
    df: DataFrame, by: Sequence[str] = ("symbol", "session_date"), n: int = 8
) -> DataFrame:
    """The last ``n`` rows of every selection."""
    order = [F.desc_nulls_last("minute_utc"), F.desc_nulls_last("event_id")]
    return first_rows(df, list(by), order, n)


def top_fx(fx: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` latest rates."""
    return fx.orderBy(F.desc("jisdor_date"), F.asc("currency")).limit(n)


def tail_bars(df: DataFrame, n: int, time: str = "bar_start_utc") -> DataFrame:
    """The last ``n`` bars, in chronological order."""
    newest = df.orderBy(F.desc(time), F.desc("symbol")).limit(n)
    return newest.orderBy(F.asc(time), F.asc("symbol"))


def time_ordered(df: DataFrame, time: str = "bar_start_utc") -> DataFrame:
    """Total order by time, then symbol; a range-partitioned sort."""
    return df.orderBy(F.asc(time), F.asc("symbol"))


def ordered_export(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """All rows in a total order: a range-partitioned sort."""
    return df.orderBy(*[F.asc_nulls_first(name) for name in order])


def first_messages(messages: DataFrame, n: int = 3) -> DataFrame:
    """The first messages of a topic, with key, partition and offset."""
    return messages.orderBy("partition", "offset").limit(n)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def union_rows(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def missing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` does not have; each once.

    Both sides are reduced to distinct keys before the shuffle, so a frequent key costs no more
    than a rare one.
    """
    mine, theirs = left.select(*keys).distinct(), right.select(*keys).distinct()
    return mine.join(theirs, list(keys), "left_anti")


def captured_only(stored: DataFrame, raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose coordinate was captured."""
    return stored.join(raw.select(*keys).distinct(), list(keys), "left_semi")


def _id_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    sides = a.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        b.select(key, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    return sides.groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))


def same_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: ids only in ``a``, only in ``b``, and whether the two sets are equal.

    One aggregation over both sides; repeated ids shrink before the shuffle.
    """
    return (
        _id_counts(a, b, key)
        .agg(
            F.count_if(F.col("b") == 0).alias("only_left"),
            F.count_if(F.col("a") == 0).alias("only_right"),
        )
        .withColumn("same", (F.col("only_left") == 0) & (F.col("only_right") == 0))
    )


def missing_members(df: DataFrame, column: str, required: Sequence) -> DataFrame:
    """Required values that do not occur in the column."""
    wanted = df.sparkSession.createDataFrame(
        [(value,) for value in required], [column]
    )
    return wanted.join(df.select(column).distinct(), column, "left_anti")
