"""Writes: write-once, staged, versioned, partitioned, exported.

A write either creates new files or refuses. Row counts come from an Observation on the write
itself, so no second pass is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fxtape import versions
from fxtape.operators.quality import check_export
from fxtape.operators.rows import ordered_export
from fxtape.sources.readers import read_if_present, stored_files
from fxtape.versions import RefusedWrite, observed_write


def layout(df: DataFrame, partition: Sequence[str], cluster: Sequence[str]) -> DataFrame:
    """Rows grouped by partition column and sorted for the cluster columns.

    Rebalancing lets adaptive execution split a partition value that holds much of the data into
    several files, where a plain repartition would send it to one task.
    """
    return df.hint("rebalance", *partition).sortWithinPartitions(*partition, *cluster)


FX_LAYOUT = (["jisdor_date"], ["currency"])
MARKET_LAYOUT = (["event_date"], ["symbol", "ingestion_mode"])
RUN_LAYOUT = (["event_date"], ["demo_run_id", "symbol"])


def write_laid_out(
    df: DataFrame, path: str, partition: Sequence[str], cluster: Sequence[str]
) -> None:
    laid = layout(df, partition, cluster)
    laid.write.mode("errorifexists").partitionBy(*partition).parquet(path)


def content_digest(df: DataFrame) -> DataFrame:
    """One row that identifies a relation's content whatever its order and files.

    Rows are hashed with SHA-256; the digests are added up in two halves.
    """
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)

    def half(start: int) -> Column:
        part = F.conv(F.substring(row, start, 15), 16, 10).cast("decimal(38,0)")
        return F.coalesce(F.sum(part), F.lit(0)).cast("string")

    return df.agg(
        F.count(F.lit(1)).alias("rows"), half(1).alias("digest_a"), half(16).alias("digest_b")
    )


def write_once(df: DataFrame, path: str) -> str:
    """Create ``path``; accept an identical rerun, refuse different content."""
    existing = read_if_present(df.sparkSession, path, "parquet", df.schema)
    if existing is None:
        df.write.mode("errorifexists").parquet(path)
        return "uploaded"
    if content_digest(df).first() != content_digest(existing).first():
        raise RefusedWrite(f"{path} holds different content")
    return "already_present"


def stage(df: DataFrame, path: str, expected: int) -> int:
    """Write a batch to an empty place; its row count must be the expected one."""
    if expected < 1 or df.isEmpty():
        raise RefusedWrite("empty batch")
    written = observed_write(df, path)
    if written != expected:
        raise RefusedWrite(f"{path}: {written} rows stored, {expected} expected")
    return written


def replace_snapshot(df: DataFrame, root: str, version: str, expected: int | None = None) -> int:
    """Write a full new version and make it the newest; readers take that one.

    A wrong number of rows, a name older than the newest version's and a version that another writer
    published in the meantime are refused, and the newest version stays what it was.
    """
    staged = versions.stage(df, root, version, expected)
    versions.publish(df.sparkSession, root, staged)
    return staged.rows


def write_fx_processed(df: DataFrame, root: str, run_id: str) -> int:
    """Rate records as JSON, one file each, by date and run.

    A date the run has written already must have the same content. Returns the number of records
    added.
    """
    places = ["date", "run_id"]
    located = df.withColumns({"date": F.col("jisdor_date").cast("string"), "run_id": F.lit(run_id)})
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.StringType()) for n in places]])
    existing = read_if_present(df.sparkSession, root, "json", schema)
    fresh = located
    if existing is not None:
        mine = existing.where(F.col("run_id") == run_id)
        fields = F.struct(*df.columns)
        both = located.join(mine.select("date", fields.alias("_there")), "date")
        if not both.where(~fields.eqNullSafe(F.col("_there"))).isEmpty():
            raise RefusedWrite("existing processed output differs; use a fresh run")
        fresh = located.join(mine.select("date"), "date", "left_anti")
    observed = Observation("processed")
    (
        fresh.observe(observed, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .option("maxRecordsPerFile", 1)
        .partitionBy(*places)
        .json(root)
    )
    return observed.get["rows"]


_CONTENT_TYPES = {
    "xml": "application/xml",
    "json": "application/json",
    "jsonl": "application/x-ndjson",
}


def manifest_rows(spark: SparkSession, folder: str, run_id: str | None) -> DataFrame:
    """Name, type, digest and length of every file of a run below ``folder``; of every file there if
    ``run_id`` is None."""
    suffix = F.substring_index("name", ".", -1)
    pairs = [F.lit(part) for pair in _CONTENT_TYPES.items() for part in pair]
    kind = F.coalesce(
        F.try_element_at(F.create_map(*pairs), suffix), F.lit("application/octet-stream")
    )
    files = stored_files(spark, folder, contents=False)
    if run_id is not None:
        files = files.where(F.contains("name", F.lit(f"/run_id={run_id}/")))
    return files.select("name", kind.alias("content_type"), "sha256", "bytes")


def write_manifest(
    spark: SparkSession, folder: str, path: str, run_id: str, source: str, records: int,
    whole: bool = False,
) -> None:
    """Manifest of a run's files: one JSON document per file, each with the run's header.

    ``whole`` takes every file of ``folder``, as a published version's folder belongs to one run.

    One document per file keeps a run with many files from being gathered into one task; the
    reader takes documents with any number of objects.
    """
    entry = F.struct("name", "content_type", "sha256", "bytes")
    manifest_rows(spark, folder, None if whole else run_id).select(
        F.lit(run_id).alias("run_id"),
        F.lit(records).cast("long").alias("records"),
        F.lit(source).alias("source"),
        F.array(entry).alias("objects"),
    ).write.mode("errorifexists").json(path)


def append_events(batch: DataFrame, batch_id: int, path: str, run_id: str | None = None) -> None:
    """Append a micro-batch of events under its batch id.

    A retried batch overwrites its own folder, so each event is stored once per batch. The insert
    id names run and event for later deduplication.
    """
    if run_id is not None:
        insert_id = F.concat_ws(":", F.lit(run_id), F.col("event_id"))
        batch = batch.withColumns({"demo_run_id": F.lit(run_id), "insert_id": insert_id})
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def capture_raw(batch: DataFrame, batch_id: int, path: str) -> None:
    """Store the messages of a micro-batch as envelopes, before anything else is done with them.

    The files are gzipped, as they take several times an event otherwise; a task reads one file whole.
    """
    batch.select(
        F.base64("value").alias("value_base64"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("long").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    ).write.mode("overwrite").option("compression", "gzip").json(f"{path}/batch_id={batch_id}")


def write_invalid(batch: DataFrame, batch_id: int, path: str) -> None:
    """Dead letters: the raw record and its error."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


KAFKA_SINK = {"kafka.enable.idempotence": "true", "kafka.acks": "all"}


def keyed_messages(df: DataFrame, value: Column) -> DataFrame:
    """Key and value of a message per event, keyed by symbol."""
    return df.select(
        F.col("symbol").cast("binary").alias("key"), value.cast("binary").alias("value")
    )


def write_events(df: DataFrame, value: Column, path: str | None = None, **kafka: str) -> None:
    """Send events keyed by symbol to Kafka, or as Parquet files of the same shape.

    Kafka writes are idempotent and wait for all replicas; a failed delivery fails the job.
    """
    messages = keyed_messages(df, value)
    if path is not None:
        messages.write.mode("errorifexists").parquet(path)
    else:
        messages.write.format("kafka").options(**KAFKA_SINK, **kafka).save()


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def json_lines(df: DataFrame) -> DataFrame:
    """Each row as JSON text that can stand inside HTML; a NaN or infinity fails the job."""
    columns = []
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            bad = F.isnan(value) | (F.abs(value) == float("inf"))
            refuse = F.raise_error(F.lit(f"{field.name} is not finite")).cast(field.dataType)
            value = F.when(bad, refuse).otherwise(value)
        columns.append(value.alias(field.name))
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(F.replace(text, F.lit("<"), F.lit("\\u003c")).alias("value"))


def export_json(df: DataFrame, path: str, provenance: Mapping[str, str]) -> None:
    """Rows as JSON lines below ``rows``, their provenance as one object below ``provenance``."""
    json_lines(df).write.mode("errorifexists").text(f"{path}/rows")
    header = df.sparkSession.range(1).select(
        *[F.lit(value).alias(name) for name, value in provenance.items()]
    )
    header.write.mode("errorifexists").json(f"{path}/provenance")


def export_checked(
    df: DataFrame, path: str, order: Sequence[str], max_rows: int | None = None
) -> int:
    """CSV of a whole replay-only relation in order; an empty one, one with other modes and, where
    ``max_rows`` is given, a larger one is refused before anything is written."""
    verdict = check_export(df, max_rows).first()
    if not verdict.allowed:
        raise RefusedWrite(f"{verdict.rows} rows, {verdict.other_modes} of another mode")
    export_csv(ordered_export(df, order), path)
    return verdict.rows


def export_workbook_tables(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]], root: str, max_rows: int | None = None
) -> dict[str, int]:
    """One ordered CSV of all rows per table; an empty table, and one above ``max_rows`` where that
    is given, refuses the export before any table is written."""
    sizes = {name: df.count() for name, (df, _) in tables.items()}
    for name, size in sizes.items():
        if size < 1 or (max_rows is not None and size > max_rows):
            raise RefusedWrite(f"{name}: empty or oversize export")
    for name, (df, order) in tables.items():
        export_csv(ordered_export(df, order), f"{root}/{name}")
    return sizes
