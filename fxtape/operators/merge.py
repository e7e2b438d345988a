"""Upsert and archive merge as joins; ``sinks/partitions.py`` commits them by partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxtape.functions.scalars import differs
from fxtape.operators.quality import duplicate_keys, key_quality
from fxtape.shared import published

FX_KEYS = ("jisdor_date", "currency")
BAR_KEY = ("symbol", "bar_start_utc")


def _unique(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """One row per key with its fields as a struct; a repeated key fails the job.

    The aggregation is dealt by the keys the join needs anyway, so it adds no shuffle, and the refusal
    is part of the value, so no later step can prune it.
    """
    row = F.struct(F.lit(1).alias("_in"), *fields)
    grouped = df.select(*keys, row.alias(name)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.any_value(name).alias(name)
    )
    kind = grouped.schema[name].dataType
    refuse = F.raise_error(F.lit("repeated key in a merge")).cast(kind)
    return grouped.select(*keys, F.when(F.col("_rows") > 1, refuse).otherwise(F.col(name)).alias(name))


def _side_by_side(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two relations of the same columns, each side as one struct per key."""
    fields = [name for name in left.columns if name not in keys]
    a = _unique(left, keys, fields, "_left")
    return a.join(_unique(right, keys, fields, "_right"), list(keys), "full")


def _taken(df: DataFrame, take_right: Column, columns: Sequence[str], keys: Sequence[str],
           *more: str) -> DataFrame:
    chosen = df.withColumn("_row", F.when(take_right, F.col("_right")).otherwise(F.col("_left")))
    fields = [F.col(f"_row.{name}") for name in columns if name not in keys]
    return chosen.select(*keys, *fields, *more).select(*columns, *more)


def merge_latest(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str] = FX_KEYS,
    version: str = "ingested_at",
    with_action: bool = False,
) -> DataFrame:
    """Upsert: insert new keys, replace rows whose staged version is strictly newer.

    A key that is repeated on either side fails the job. ``with_action`` adds what happened to each
    row.
    """
    both = _side_by_side(target, staged, keys)
    newer = F.col(f"_right.{version}") > F.col(f"_left.{version}")
    action = (
        F.when(F.col("_left").isNull(), "insert").when(newer, "update").otherwise("keep")
    )
    both = both.withColumn("action", action)
    more = ["action"] if with_action else []
    return _taken(both, F.col("action") != "keep", target.columns, keys, *more)


def merge_mismatches(
    staged: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = FX_KEYS,
    version: str = "ingested_at",
    fields: Sequence[str] = ("usd_idr", "source", "fx_available_at"),
) -> DataFrame:
    """Staged rows the target does not reflect: absent, older there, or different at the same
    version."""
    stored = target.select(*keys, F.struct(version, *fields).alias("_stored"))
    joined = staged.join(stored, list(keys), "left")
    same = F.col(f"_stored.{version}") == F.col(version)
    other = F.lit(False)
    for name in fields:
        other = other | differs(F.col(f"_stored.{name}"), F.col(name))
    bad = (
        F.col("_stored").isNull()
        | (F.col(f"_stored.{version}") < F.col(version))
        | (same & other)
    )
    return joined.where(F.coalesce(bad, F.lit(False))).drop("_stored")


def merge_gate(
    merged: DataFrame, staged: DataFrame, keys: Sequence[str], version: str, fields: Sequence[str],
    invalid: Column,
) -> DataFrame:
    """One row: the quality of a merged relation, the staged rows it does not reflect, the verdict."""
    open_rows = merge_mismatches(staged, merged, keys, version, fields)
    mismatches = open_rows.agg(F.count(F.lit(1)).alias("mismatches"), F.lit(1).alias("_one"))
    gate = key_quality(merged, keys, invalid).withColumn("_one", F.lit(1)).join(mismatches, "_one")
    faults = F.col("duplicate_keys") + F.col("invalid_rows") + F.col("mismatches")
    return gate.drop("_one").withColumn("accepted", faults == 0)


def merge_checked(
    target: DataFrame,
    staged: DataFrame,
    invalid: Column,
    keys: Sequence[str] = FX_KEYS,
    version: str = "ingested_at",
    fields: Sequence[str] = ("usd_idr", "source", "fx_available_at"),
) -> tuple[DataFrame, DataFrame]:
    """The merged relation, and one row that says whether it may be published.

    Repeated keys are counted first, by partial aggregation. Where there are any the merge is
    cancelled and the target returned as it is, so repeated rows never meet in a join. Otherwise the
    merge is written once, and the row also holds its quality and the staged rows that do not reconcile.
    """
    repeated = {
        "target_duplicates": duplicate_keys(target, keys).count(),
        "staged_duplicates": duplicate_keys(staged, keys).count(),
    }
    counts = {name: F.lit(n).cast("long") for name, n in repeated.items()}
    if any(repeated.values()):
        gate = key_quality(target, keys, invalid).withColumns(counts)
        nothing = F.lit(None).cast("long")
        return target, gate.withColumns({"mismatches": nothing, "accepted": F.lit(False)})
    merged = published(merge_latest(target, staged, keys, version), "merged")
    gate = merge_gate(merged, staged, keys, version, fields, invalid)
    return merged, gate.select(
        *[name for name in gate.columns if name not in ("mismatches", "accepted")],
        *[value.alias(name) for name, value in counts.items()], "mismatches", "accepted",
    )


def merge_archive(
    archive: DataFrame, incoming: DataFrame, keys: Sequence[str] = BAR_KEY
) -> DataFrame:
    """Archive and incoming rows in one relation, the incoming row winning.

    ``change`` tells added, revised and unchanged rows apart. A key that is repeated on either side
    fails the job.
    """
    both = _side_by_side(archive, incoming, keys)
    change = (
        F.when(F.col("_left").isNull(), "added")
        .when(F.col("_right").isNotNull() & differs(F.col("_left"), F.col("_right")), "revised")
        .otherwise("unchanged")
    )
    both = both.withColumn("change", change)
    return _taken(both, F.col("_right").isNotNull(), archive.columns, keys, "change")


def archive_counts(merged: DataFrame) -> DataFrame:
    """Rows, added and revised of an archive merge, as one row."""
    return merged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("change") == "added").alias("added"),
        F.count_if(F.col("change") == "revised").alias("revised"),
    )
