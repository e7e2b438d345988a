"""Scans with declared schemas: rate documents, bars, events, manifests, staged files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fxtape import constants as c
from fxtape import versions
from fxtape.functions.scalars import clean_code, local_date, try_rate, try_time, zoned_time
from fxtape.operators.quality import check_fx_record
from fxtape.schemas import BAR, ENVELOPE, FX_DOCUMENT, FX_RECORD_TEXT, MANIFEST, MESSAGE
from fxtape.shared import published


def read_fx_xml(spark: SparkSession, path: str) -> DataFrame:
    """Rate rows of XML documents at any depth and in any namespace; malformed input fails."""
    return (
        spark.read.format("xml")
        .option("rowTag", c.FX_ROW_TAG)
        .option("ignoreNamespace", True)
        .option("mode", "FAILFAST")
        .schema(FX_DOCUMENT)
        .load(path)
    )


def normalise_fx(raw: DataFrame, zone: str = c.LOCAL_ZONE) -> DataFrame:
    """Typed rates; whatever does not parse becomes NULL.

    The date is the one in ``zone``: an instant is moved there, a text without offset is there.
    """
    stamp = F.col(c.FX_DATE_TAG)
    date = F.coalesce(local_date(zoned_time(stamp), zone), F.to_date(try_time(stamp)))
    return raw.select(
        date.alias("jisdor_date"),
        clean_code(F.col(c.FX_CURRENCY_TAG)).alias("currency"),
        try_rate(F.col(c.FX_RATE_TAG)).alias("usd_idr"),
    )


def read_bars(spark: SparkSession, path: str, schema: T.StructType = BAR) -> DataFrame:
    """Replay bars, one JSON object per line."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Captured messages, one JSON envelope per line."""
    return spark.read.schema(ENVELOPE).option("mode", "FAILFAST").json(path)


def _message_columns(df: DataFrame) -> DataFrame:
    return df.select(*MESSAGE.names)


def read_events(spark: SparkSession, path: str | None = None, **kafka: str) -> DataFrame:
    """All messages from the earliest offset on, as one bounded scan.

    Either a folder of Parquet files of the message shape, or the options of the Kafka source
    (``subscribe``, ``kafka.bootstrap.servers``), whose connector the session must provide.
    """
    if path is not None:
        return _message_columns(spark.read.schema(MESSAGE).parquet(path))
    reader = spark.read.format("kafka").option("startingOffsets", "earliest")
    return _message_columns(reader.options(**kafka).load())


def stream_events(
    spark: SparkSession, path: str | None = None, files_per_trigger: int | None = None, **kafka: str
) -> DataFrame:
    """The same messages as a stream; offsets live in the query's checkpoint."""
    if path is not None:
        reader = spark.readStream.schema(MESSAGE)
        if files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return _message_columns(reader.parquet(path))
    reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
    return _message_columns(reader.options(**kafka).load())


def stored_files(spark: SparkSession, root: str, contents: bool = True) -> DataFrame:
    """Every file below ``root``: name relative to it, size and digest."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    )
    base = root.rstrip("/").removeprefix("file:").removeprefix("//") + "/"
    columns: list[Column] = [
        F.substring_index("path", base, -1).alias("name"),
        F.length("content").cast("long").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    ]
    if contents:
        columns.append(F.col("content"))
    return files.select(*columns)


def verify_hash(spark: SparkSession, path: str, sha: str) -> DataFrame:
    """Files whose bytes do not have the collected digest; empty when all do."""
    files = spark.read.format("binaryFile").load(path)
    digest = F.sha2("content", 256)
    return files.select("path", digest.alias("sha256")).where(F.col("sha256") != sha)


def read_manifest(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Objects of manifests, one row each with the run, the source and the number of records.

    A manifest is one JSON object per line, or with ``multiline`` one object per file.
    """
    document = spark.read.schema(MANIFEST).option("multiLine", multiline).json(path)
    return document.select("run_id", "source", "records", F.inline_outer("objects"))


def read_manifested(
    spark: SparkSession,
    manifest_path: str,
    root: str,
    run_id: str,
    prefixes: tuple[str, str] = ("raw/", "processed/"),
    multiline: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Records of a run whose files agree with its manifest, and everything that does not agree.

    Every listed object must exist once with its length and digest, belong to the run and lie
    below a known prefix. A processed record must be valid, lie in its date's partition, carry the
    manifest's source and be unique, and their number must be the manifest's. Any violation is a
    row with the object's name and the broken rule; the batch is good when there is none.
    """
    listed = read_manifest(spark, manifest_path, multiline)
    per_name = listed.groupBy("name").agg(
        F.count(F.lit(1)).alias("listings"),
        *[F.max(n).alias(f"listed_{n}") for n in ("run_id", "source", "records", "bytes", "sha256")],
    )
    checked = per_name.join(stored_files(spark, root), "name", "left")
    raw, processed = prefixes
    is_record = F.col("name").startswith(processed)
    object_problem = (
        F.when(F.col("name").isNull(), "empty_manifest")
        .when(~F.col("listed_run_id").eqNullSafe(F.lit(run_id)), "foreign_manifest")
        .when(F.col("listings") > 1, "listed_twice")
        .when(~F.col("name").contains(f"/run_id={run_id}/"), "foreign_run")
        .when(~F.col("name").startswith(raw) & ~is_record, "unexpected_prefix")
        .when(F.col("bytes").isNull(), "absent")
        .when(F.col("bytes") != F.col("listed_bytes"), "length")
        .when(F.col("sha256") != F.col("listed_sha256"), "digest")
    )
    content = F.from_json(F.col("content").cast("string"), FX_RECORD_TEXT)
    opened = (
        checked.withColumn("problem", object_problem)
        .withColumn("record", F.when(is_record & F.col("problem").isNull(), content))
        .select("name", "listed_source", "listed_records", "problem", "record")
    )
    # Every file is opened and hashed once; the rules below read this small relation.
    opened = published(opened, "manifest_objects")
    records = check_fx_record(
        opened.where(is_record & F.col("problem").isNull()).select(
            "name", "listed_source", "listed_records", "record.*"
        )
    )
    place = F.concat(F.lit("/date="), F.col("jisdor_date"), F.lit("/"))
    records = records.withColumn(
        "problem",
        F.when(F.col("error").isNotNull(), F.concat(F.lit("record_"), F.col("error")))
        .when(~F.col("name").contains(place), "partition_date")
        .when(F.col("source") != F.col("listed_source"), "source"),
    )
    repeated = (
        records.where(F.col("problem").isNull())
        .groupBy("jisdor_date", "currency")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("name").alias("name"))
        .where(F.col("rows") > 1)
        .select("name", F.lit("repeated_key").alias("problem"))
    )
    counted = (
        opened.agg(
            F.max("listed_records").alias("expected"), F.count_if(is_record).alias("found")
        )
        .where(~F.col("expected").eqNullSafe(F.col("found")))
        .select(F.lit(None).cast("string").alias("name"), F.lit("record_count").alias("problem"))
    )
    violations = (
        opened.where(F.col("problem").isNotNull())
        .select("name", "problem")
        .unionByName(records.where(F.col("problem").isNotNull()).select("name", "problem"))
        .unionByName(repeated)
        .unionByName(counted)
    )
    good = records.where(F.col("problem").isNull()).select(
        F.col("jisdor_date").cast("date").alias("jisdor_date"),
        "currency",
        try_rate(F.col("usd_idr")).alias("usd_idr"),
        "source",
        zoned_time(F.col("ingested_at")).alias("ingested_at"),
        zoned_time(F.col("fx_available_at")).alias("fx_available_at"),
        F.lit(run_id).alias("source_run_id"),
    )
    return good, violations


def load_ndjson(
    spark: SparkSession, uri: str, schema: T.StructType
) -> tuple[DataFrame, Observation]:
    """Typed JSON lines with an observed row count.

    ``loaded_as_expected`` tells, once the frame has been written, whether the count was right.
    """
    observed = Observation("load")
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(uri)
    return rows.observe(observed, F.count(F.lit(1)).alias("rows")), observed


def loaded_as_expected(observed: Observation, expected: int) -> bool:
    return expected > 0 and observed.get["rows"] == expected


def read_if_present(spark: SparkSession, path: str, form: str, schema: T.StructType
                    ) -> DataFrame | None:
    """A stored relation, or None where nothing has been written yet."""
    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest published version below ``root``; only its folder is listed and read."""
    version = versions.newest(spark, root)
    if version is None:
        raise FileNotFoundError(f"{root} has no published version")
    return versions.read(spark, root, version, schema)


def snapshot_or_empty(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest version, or no rows before the first one."""
    version = versions.newest(spark, root)
    return spark.createDataFrame([], schema) if version is None else versions.read(spark, root, version, schema)
