"""Queries for what is committed: partitions of a table, versions behind a log, whole batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape import versions
from fxtape.plans import archive, rates, replay
from fxtape.schemas import BAR, MARKET_EVENT
from fxtape.shared import new_folder, published
from fxtape.sinks import partitions
from fxtape.sources import readers
from registry import sql
from registry.market import rounded
from registry.messages import ID_SQL, SYMBOLS, replay_bars
from registry.tables import RUN_ID, day, fx_fact, table, text

QUERIES: dict = {}
SQL: dict[str, str] = {}
EARLIER, LATER = "20240120T210000000000Z", "20240131T210000000000Z"


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            SQL[name] = oracle
        return function

    return register


def _files(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).select(F.input_file_name().alias("file")).distinct()


def _with_kept(spark: SparkSession, root: str, before: DataFrame) -> DataFrame:
    """Stored rows, and whether their file was there before the last commit."""
    stored = spark.read.parquet(root).withColumn("file", F.input_file_name())
    old = before.withColumn("kept", F.lit(True))
    return stored.join(old, "file", "left").withColumn("file_kept", F.coalesce("kept", F.lit(False)))


# Orders by month. All but those of status P are there at version 0 to 2; those of two years are staged
# again at version 1 with another price.
@query("upsert_partitions", """WITH target AS (SELECT o_orderkey, o_orderdate, o_totalprice, o_orderkey % 3 AS version
      FROM orders WHERE o_orderstatus <> 'P'),
    staged AS (SELECT o_orderkey, o_orderdate, o_totalprice + 1 AS o_totalprice, CAST(1 AS BIGINT) AS version FROM orders
      WHERE year(o_orderdate) IN (1996, 1999))
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
      CASE WHEN t.version IS NULL OR s.version > t.version THEN s.version ELSE t.version END AS version,
      CASE WHEN t.version IS NULL OR s.version > t.version THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
      year(coalesce(t.o_orderdate, s.o_orderdate)) NOT IN (1996, 1999) AS file_kept
    FROM target t FULL JOIN staged s USING (o_orderkey)""")
def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert rewrites the months its batch touches; the files of all other months stay."""
    root = new_folder(spark, "orders")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.to_date("o_orderdate").alias("day")
    )
    month = F.trunc("day", "month").alias("month")
    target = orders.where(F.col("o_orderstatus") != "P").select(
        month, "o_orderkey", "o_totalprice", (F.col("o_orderkey") % 3).alias("version")
    )
    price = (F.col("o_totalprice") + 1).alias("o_totalprice")
    staged = orders.where(F.year("day").isin(1996, 1999)).select(
        month, "o_orderkey", price, F.lit(1).cast("long").alias("version")
    )

    def commit(batch: DataFrame) -> None:
        partitions.upsert(root, batch, ["month", "o_orderkey"], "version", [], F.col("o_totalprice") <= 0, "month", ["o_orderkey"])

    commit(target)
    before = published(_files(spark, root), "files")
    commit(staged)
    return _with_kept(spark, root, before).select("o_orderkey", "version", "o_totalprice", "file_kept")


_ALIGNED = """SELECT * FROM (SELECT event_id, event_type AS symbol, ts, value + 1 AS price FROM events WHERE {when})
    WHERE ts BETWEEN (SELECT max(a) FROM (SELECT min(ts) AS a FROM events WHERE {when} GROUP BY event_type))
      AND (SELECT min(b) FROM (SELECT max(ts) AS b FROM events WHERE {when} GROUP BY event_type))"""
_ARCHIVE = f"""old AS ({_ALIGNED.format(when="ts < TIMESTAMP '2024-01-20'")}),
  new AS ({_ALIGNED.format(when="ts >= TIMESTAMP '2024-01-18'")}),
  merged AS (SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.ts, o.ts) AS ts,
      CASE WHEN n.event_id IS NULL THEN o.price WHEN n.symbol = 'click' THEN n.price + 1 ELSE n.price END AS price,
      o.event_id IS NULL AS added, o.event_id IS NOT NULL AND n.symbol = 'click' AND n.event_id IS NOT NULL AS revised
    FROM old o FULL JOIN new n USING (event_id)),
  dated AS (SELECT *, CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS d FROM merged)"""


# Two events of a type may have one time, so the archive keeps the number of the event with its bar.
NUMBER = ["event_id"]


def _collected(spark: SparkSession, sf_dir: str, when: str, raised: bool) -> str:
    """Events of a time as a file of collected bars; ``raised`` revises one symbol's prices."""
    folder = new_folder(spark, "collected")
    bars = replay_bars(spark, sf_dir).withColumn("price_usd", F.col("price_usd") + 1)
    if raised:
        more = F.when(F.col("symbol") == "click", 1).otherwise(0)
        bars = bars.withColumn("price_usd", F.col("price_usd") + more)
    bars.where(f"bar_start_utc {when}").select(*BAR.names, *NUMBER).write.json(folder)
    return folder


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[str, str, DataFrame]:
    """Two refreshes of a bar archive that overlap by two days."""
    stored, active = new_folder(spark, "archive"), new_folder(spark, "active")
    for version, when, raised in ((EARLIER, "< '2024-01-20'", False), (LATER, ">= '2024-01-18'", True)):
        counts = archive.refresh_archive(
            spark, _collected(spark, sf_dir, when, raised), stored, active, version, "2024-02-01 00:00:00",
            required=SYMBOLS, number=NUMBER,
        )
    return stored, active, counts


@query("archive_refresh", f"""WITH {_ARCHIVE} SELECT symbol, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS bar_start, price AS price_usd,
    d >= (SELECT min(d) FROM (SELECT DISTINCT d FROM dated ORDER BY d DESC LIMIT 5)) AS active FROM dated""")
def archive_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive after both refreshes, and which bars are in its active window."""
    stored, active, _ = _refreshed(spark, sf_dir)
    key = ["symbol", "bar_start_utc", *NUMBER]
    window = readers.read_snapshot(spark, active, archive.numbered(BAR, NUMBER)).select(*key, F.lit(True).alias("shown"))
    start = F.date_format(archive.zoned_time(F.col("bar_start_utc")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return archive.stored_bars(spark, stored, NUMBER).join(window, key, "left").select(
        "symbol", start.alias("bar_start"), "price_usd", F.coalesce("shown", F.lit(False)).alias("active")
    )


@query("archive_refresh_counts", f"""WITH {_ARCHIVE} SELECT count(*) AS total, count(*) FILTER (added) AS added,
    count(*) FILTER (revised) AS revised FROM dated""")
def archive_refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir)[2]


def rate_document(spark: SparkSession, fx: DataFrame) -> tuple[str, str]:
    """Rates as one XML document, at most a row per calendar day, and the digest of its bytes."""
    folder = new_folder(spark, "document")
    before = F.timestamp_seconds(F.unix_seconds(F.col("jisdor_date").cast("timestamp")) - 7 * 3600)
    fx.select(
        F.date_format(before, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(c.FX_DATE_TAG),
        F.lit(" usd ").alias(c.FX_CURRENCY_TAG), F.col("usd_idr").cast("string").alias(c.FX_RATE_TAG),
    ).coalesce(1).write.format("xml").option("rowTag", c.FX_ROW_TAG).option("rootTag", "NewDataSet").save(folder)
    path = f"{folder}/part-*"
    return path, spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]


@query("rate_batch", sql.with_fx(f"""SELECT {sql.day("jisdor_date")} AS jisdor_date, currency,
    round(CAST(usd_idr + CASE WHEN day(jisdor_date) >= 15 THEN 1 ELSE 0 END AS DOUBLE), 6) AS usd_idr,
    CASE WHEN day(jisdor_date) >= 15 THEN '{LATER}' ELSE '{EARLIER}' END AS source_run_id,
    CASE WHEN day(jisdor_date) >= 15 THEN '2024-01-31 21:00:00' ELSE '2024-01-20 21:00:00' END AS ingested_at
    FROM fx"""))
def rate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rate documents through the whole batch; the second revises the days they share."""
    landing, stored = new_folder(spark, "landing"), new_folder(spark, "rates")
    fx = fx_fact(spark, sf_dir)
    parts = (
        (EARLIER, fx.where(F.dayofmonth("jisdor_date") <= 20)),
        (LATER, fx.where(F.dayofmonth("jisdor_date") >= 15).withColumn("usd_idr", (F.col("usd_idr") + 1).cast("decimal(38,9)"))),
    )
    for run_id, part in parts:
        run = rates.RateRun(run_id, *rate_document(spark, part), "daily events", landing, stored)
        rates.rate_batch(spark, run, "2024-01-31")
    return rates.current_rates(spark, stored).select(
        day("jisdor_date").alias("jisdor_date"), "currency", *rounded("usd_idr"), "source_run_id",
        text("ingested_at").alias("ingested_at"),
    )


_LATER_ID = ID_SQL.replace("CAST(value AS VARCHAR)", "CAST(value + 1 AS VARCHAR)")


@query("replay_publish", f"""SELECT {_LATER_ID} AS event_id, event_type AS symbol, value + 1 AS price_usd,
    dense_rank() OVER (ORDER BY event_type) - 1 AS kafka_partition,
    row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS kafka_offset,
    CAST(1 AS BIGINT) AS versions FROM events""")
def replay_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars replayed as a stream, stored, reconciled as they read back, and published."""
    root, market = new_folder(spark, "replay"), new_folder(spark, "market")
    bars = replay_bars(spark, sf_dir).drop("event_id").withColumn("price_usd", F.col("price_usd") + 1)
    received = F.lit("2024-01-31 01:00:00").cast("timestamp")
    replay.replay_and_publish(spark, bars, received, root, market, RUN_ID, SYMBOLS, files=4)
    return readers.read_snapshot(spark, market, MARKET_EVENT).select(
        "event_id", "symbol", "price_usd", "kafka_partition", "kafka_offset",
        F.lit(versions.newest(spark, market).number).cast("long").alias("versions"),
    )
