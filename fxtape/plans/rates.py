"""Exchange-rate batch: landed document to merged table and coverage report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.functions.scalars import iso_text, run_time
from fxtape.operators import merge, quality
from fxtape.plans.journal import Journal
from fxtape.schemas import FX_FACT, FX_RATE
from fxtape.shared import published
from fxtape.sinks import partitions, writers
from fxtape.sources import readers
from fxtape.versions import RefusedWrite, observed_write


class RefusedBatch(ValueError):
    """A batch that failed a check; nothing was published."""


def _require(holds: bool, message: str) -> None:
    if not holds:
        raise RefusedBatch(message)


@dataclass(frozen=True)
class RateRun:
    """Where a run lands, and what it asked the source for."""

    run_id: str
    document: str
    sha256: str
    source: str
    landing: str
    table: str
    interval: tuple[str, str] | None = None


def current_rates(spark: SparkSession, table: str) -> DataFrame:
    """The rate table, partitioned by date; empty before the first run."""
    return partitions.stored_table(spark, table, FX_FACT)


def clean_document(spark: SparkSession, run: RateRun, zone: str = c.LOCAL_ZONE) -> DataFrame:
    """Normalised rates of a document whose bytes and rows passed every check."""
    _require(readers.verify_hash(spark, run.document, run.sha256).isEmpty(), "document bytes differ")
    rates = published(readers.normalise_fx(readers.read_fx_xml(spark, run.document), zone), "rates")
    _require(quality.check_fx_batch(rates).first().accepted, "invalid, empty or repeated rates")
    if run.interval:
        outside = quality.outside_interval(rates, *run.interval)
        _require(outside.isEmpty(), "rates outside the requested interval")
    return rates


def records_of(run: RateRun, rates: DataFrame) -> DataFrame:
    """Rates as the text records a run stores."""
    return rates.select(
        F.col("jisdor_date").cast("string").alias("jisdor_date"),
        "currency",
        F.col("usd_idr").cast("string").alias("usd_idr"),
        F.lit(run.source).alias("source"),
        iso_text(run_time(F.lit(run.run_id))).alias("ingested_at"),
        F.lit(None).cast("string").alias("fx_available_at"),
    )


def land(spark: SparkSession, run: RateRun, rates: DataFrame) -> int:
    """Write the run's records; those an interrupted try has stored already must be the same."""
    records = records_of(run, rates)
    checked = quality.check_processed_vs_raw(rates, records, run.source)
    _require(checked.isEmpty(), "processed records differ from the document")
    writers.write_fx_processed(records, f"{run.landing}/processed", run.run_id)
    return rates.count()


def merge_rates(run: RateRun, batch: DataFrame) -> partitions.Commit:
    """Merge a batch into the dates it touches; other dates are neither read nor written."""
    date, cluster = writers.FX_LAYOUT
    try:
        return partitions.upsert(
            run.table, batch, merge.FX_KEYS, "ingested_at", ("usd_idr", "source", "fx_available_at"),
            quality.fx_invalid(), date[0], cluster,
        )
    except RefusedWrite as error:
        raise RefusedBatch(str(error)) from error


STEPS = ("clean", "land", "manifest", "verify", "merge", "report")


def rate_batch(spark: SparkSession, run: RateRun, as_of: str) -> tuple[DataFrame, DataFrame]:
    """The whole batch. Returns the merge gate and the coverage report, one row each.

    Each step is written to the run's journal before and after it. A batch that was killed is called
    again with the same run: finished steps keep their results, the step that had begun is repeated,
    and the table ends as if nothing had happened. A finished run that is called again changes nothing.
    """
    journal = Journal(spark, f"{run.landing.rstrip('/')}-journal", run.run_id)

    def clean(folder: str) -> dict:
        return {"rates": observed_write(clean_document(spark, run), folder)}

    journal.step("clean", clean)
    rates = spark.read.schema(FX_RATE).parquet(journal.place("clean"))
    landed = journal.step("land", lambda _: {"records": land(spark, run, rates)})

    def manifest(folder: str) -> dict:
        writers.write_manifest(spark, run.landing, folder, run.run_id, run.source, landed["records"])
        return {"objects": landed["records"]}

    journal.step("manifest", manifest)

    def verify(folder: str) -> dict:
        listed = journal.place("manifest")
        good, violations = readers.read_manifested(spark, listed, run.landing, run.run_id)
        _require(violations.isEmpty(), "landed files differ from the manifest")
        return {"staged": writers.stage(good, folder, landed["records"])}

    journal.step("verify", verify)
    staged = spark.read.schema(FX_FACT).parquet(journal.place("verify"))

    def merged(folder: str) -> dict:
        commit = merge_rates(run, staged)
        stored = current_rates(spark, run.table)
        total = quality.key_quality(stored, merge.FX_KEYS, quality.fx_invalid())
        told = commit.gate.select("mismatches", "accepted", F.lit(1).alias("_one"))
        whole = total.withColumn("_one", F.lit(1)).join(told, "_one").drop("_one")
        whole.write.parquet(folder)
        return {"partitions": [str(value) for value in commit.partitions]}

    journal.step("merge", merged)

    def report(folder: str) -> dict:
        coverage = quality.date_coverage(current_rates(spark, run.table), as_of)
        quality.coverage_report(coverage, rates).write.parquet(folder)
        return {"as_of": as_of}

    journal.step("report", report)
    return spark.read.parquet(journal.place("merge")), spark.read.parquet(journal.place("report"))
