"""Bar archive: merge newly collected bars and choose the active replay window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fxtape import constants as c
from fxtape import versions
from fxtape.functions.scalars import zoned_time
from fxtape.operators import bars, merge, quality
from fxtape.plans.rates import RefusedBatch
from fxtape.schemas import BAR, BAR_STORED
from fxtape.shared import published
from fxtape.sinks import partitions, writers
from fxtape.sources import readers
from fxtape.versions import RefusedWrite


DATE = "bar_date"


def numbered(schema: T.StructType, number: Sequence[str]) -> T.StructType:
    """The schema of bars that have numbers beside their symbol and time."""
    return T.StructType([*schema.fields, *[T.StructField(name, T.LongType()) for name in number]])


def stored_bars(spark: SparkSession, root: str, number: Sequence[str] = ()) -> DataFrame:
    """The archive, partitioned by the UTC date of its bars; empty before the first refresh."""
    return partitions.stored_table(spark, root, numbered(BAR_STORED, number)).select(
        *BAR.names, *number, DATE
    )


def dated(bars_: DataFrame) -> DataFrame:
    return bars_.withColumn(DATE, F.to_date(zoned_time(F.col("bar_start_utc"))))


def recent_dates(spark: SparkSession, root: str, sessions: int) -> list[date]:
    """UTC dates that hold the last sessions of the archive, from the names of its partitions.

    A session of a local day lies in two UTC dates at most.
    """
    found = [name.partition("=")[2] for name in versions.names(spark, root) if name.startswith(f"{DATE}=")]
    return [date.fromisoformat(text) for text in found if text[:1].isdigit()][-(2 * sessions + 1):]


def timed(df: DataFrame) -> DataFrame:
    return df.withColumn("bar_start", zoned_time(F.col("bar_start_utc")))


def clean_bars(
    collected: DataFrame, as_of: str, bar_seconds: int = 60, number: Sequence[str] = ()
) -> DataFrame:
    """Completed, valid bars inside the period all symbols share."""
    faults = quality.check_bars(collected, number=number)
    if not faults.isEmpty():
        raise RefusedBatch("source bars are invalid or repeated")
    completed = bars.completed_bars(timed(collected), F.lit(as_of).cast("timestamp"), bar_seconds)
    aligned = bars.align_overlap(completed)
    if aligned.isEmpty():
        raise RefusedBatch("no overlapping source period")
    return aligned.drop("bar_start")


def refresh_archive(
    spark: SparkSession,
    path: str,
    archive_root: str,
    active_root: str,
    version: str,
    as_of: str,
    sessions: int = 5,
    required: Sequence[str] = tuple(c.SYMBOLS),
    max_rows: int | None = None,
    number: Sequence[str] = (),
) -> DataFrame:
    """Merge collected bars into the archive's dates they touch and publish the window of its last
    sessions.

    Returns one row with the total, added and revised bars. Repeated keys, stale input and a window that
    lacks symbols are refused before any stored date is replaced. Dates that the bars do not touch are
    read for the window alone, and only the most recent of them.

    A symbol has one bar a time, unless ``number`` names columns of whole numbers, kept with the bars, that
    tell several apart; they belong to the key then.
    """
    collected = readers.read_bars(spark, path, numbered(BAR, number))
    incoming = published(dated(clean_bars(collected, as_of, number=number)), "incoming_bars")
    recent = recent_dates(spark, archive_root, sessions)
    stored = partitions.only(stored_bars(spark, archive_root, number), DATE, recent)
    if bars.is_stale(timed(incoming), timed(stored)).first().stale:
        raise RefusedBatch("incoming bars are older than the archive")
    batch_dates = partitions.touched(incoming, DATE)
    others = partitions.only(stored_bars(spark, archive_root, number), DATE, [d for d in recent if d not in batch_dates])
    active: list[DataFrame] = []

    def window_of(merged: DataFrame) -> None:
        latest = bars.latest_sessions(timed(merged.unionByName(others)), sessions).drop("bar_start", DATE)
        window = published(latest, "active_window")
        if not bars.window_violations(window, required, max_rows).first().accepted:
            raise RefusedBatch("active window lacks symbols or has the wrong size")
        active.append(window)

    try:
        commit = partitions.merge_bars(
            archive_root, incoming, (DATE, *merge.BAR_KEY, *number), DATE, ("symbol",), before=window_of
        )
    except RefusedWrite as error:
        raise RefusedBatch(str(error)) from error
    writers.replace_snapshot(active[0], active_root, version)
    total = stored_bars(spark, archive_root).agg(F.count(F.lit(1)).alias("total"), F.lit(1).alias("_one"))
    changed = commit.changes.agg(
        *[F.coalesce(F.sum(F.when(F.col("change") == n, F.col("rows"))), F.lit(0)).alias(n) for n in ("added", "revised")],
        F.lit(1).alias("_one"),
    )
    return total.join(changed, "_one").drop("_one")
