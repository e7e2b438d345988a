"""Commits that read and rewrite only the partitions a batch touches.

The partition column belongs to the key, so a key's old row can only be in a partition the batch names.
The merged partitions are written once beside the table and checked there; only then do they replace
the stored ones, by Spark's dynamic partition overwrite, and are read back. Merging the same batch
again changes nothing, so a run that was killed between two partitions is simply repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fxtape.operators import merge, quality
from fxtape.shared import published
from fxtape.sinks.writers import content_digest, layout
from fxtape.sources.readers import read_if_present
from fxtape.versions import RefusedWrite


def stored_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A partitioned table, empty before its first commit."""
    found = read_if_present(spark, root, "parquet", schema)
    return spark.createDataFrame([], schema) if found is None else found.select(*schema.names)


def touched(batch: DataFrame, partition: str) -> list:
    """The partitions a batch names, at most the days of its calendar."""
    return sorted(row[0] for row in batch.select(partition).distinct().collect() if row[0] is not None)


def only(table: DataFrame, partition: str, values: list) -> DataFrame:
    """The rows of some partitions; the filter prunes the scan to their folders."""
    return table.where(F.col(partition).isin(values)) if values else table.limit(0)


def replace_partitions(df: DataFrame, root: str, partition: str, cluster: Sequence[str]) -> None:
    """Put rows in the place of what their partitions held; other partitions keep their files."""
    laid = layout(df, [partition], cluster)
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(root)


@dataclass(frozen=True)
class Commit:
    """``gate`` says in one row what was checked, ``changes`` has a row per kind of change."""

    partitions: list
    gate: DataFrame
    changes: DataFrame


def _commit(
    spark: SparkSession, root: str, merged: DataFrame, change: str, partition: str, cluster: Sequence[str],
    values: list, gate_of: Callable[[DataFrame], DataFrame], before: Callable[[DataFrame], None] | None = None,
) -> Commit:
    """Write merged partitions beside the table, check them there, then replace and read them back."""
    beside = published(merged, "merged_partitions")
    gate = published(gate_of(beside.drop(change)), "merge_gate")
    if not gate.first().accepted:
        raise RefusedWrite(f"{root}: merge refused by its checks: {gate.first().asDict()}")
    rows = beside.drop(change)
    if before is not None:
        before(rows)
    if values:
        replace_partitions(rows, root, partition, cluster)
        back = only(stored_table(spark, root, rows.schema), partition, values)
        if content_digest(back).first() != content_digest(rows).first():
            raise RefusedWrite(f"{root}: the stored partitions are not the merged ones")
    changes = beside.groupBy(F.col(change).alias("change")).agg(F.count(F.lit(1)).alias("rows"))
    return Commit(values, gate, changes)


def upsert(
    root: str, batch: DataFrame, keys: Sequence[str], version: str, fields: Sequence[str], invalid: Column,
    partition: str, cluster: Sequence[str] = (),
) -> Commit:
    """Insert new keys and replace rows whose staged version is strictly newer, partition by partition.

    Refused before anything is replaced: a key repeated in the batch or in a touched partition, a row
    ``invalid`` names, and a staged row the result does not reflect. A row without a partition value is
    refused as well.
    """
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")
    spark = batch.sparkSession
    staged = published(batch, "staged")
    if not staged.where(F.col(partition).isNull()).isEmpty():
        raise RefusedWrite(f"{root}: rows without {partition}")
    values = touched(staged, partition)
    target = only(stored_table(spark, root, batch.schema), partition, values)
    for side in (staged, target):
        if not quality.duplicate_keys(side, keys).isEmpty():
            raise RefusedWrite(f"{root}: repeated keys")
    merged = merge.merge_latest(target, staged, keys, version, with_action=True)

    def gate_of(rows: DataFrame) -> DataFrame:
        return merge.merge_gate(rows, staged, keys, version, fields, invalid)

    return _commit(spark, root, merged, "action", partition, cluster, values, gate_of)


def merge_bars(
    root: str, incoming: DataFrame, keys: Sequence[str], partition: str, cluster: Sequence[str] = (),
    invalid: Column | None = None, before: Callable[[DataFrame], None] | None = None,
) -> Commit:
    """Put incoming rows in the place of archived ones of the same key, partition by partition.

    Changes are ``added``, ``revised`` and ``unchanged`` rows of the touched partitions. Repeated keys
    on either side fail the merge before anything is replaced, and so does ``before`` if it raises on
    the merged partitions.
    """
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")
    spark = incoming.sparkSession
    batch = published(incoming, "incoming")
    if not batch.where(F.col(partition).isNull()).isEmpty():
        raise RefusedWrite(f"{root}: rows without {partition}")
    values = touched(batch, partition)
    target = only(stored_table(spark, root, batch.schema), partition, values)
    for side in (batch, target):
        if not quality.duplicate_keys(side, keys).isEmpty():
            raise RefusedWrite(f"{root}: repeated keys")
    merged = merge.merge_archive(target, batch, keys)

    def gate_of(rows: DataFrame) -> DataFrame:
        checked = quality.key_quality(rows, keys, F.lit(False) if invalid is None else invalid)
        return checked.withColumn("accepted", F.col("duplicate_keys") + F.col("invalid_rows") == 0)

    return _commit(spark, root, merged, "change", partition, cluster, values, gate_of, before)
