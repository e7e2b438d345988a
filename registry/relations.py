"""Queries for keys, joins, merges, bars and scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.functions import scalars as s
from fxtape.operators import bars, compare, merge, quality, rows
from registry import sql
from registry.tables import day, fx_fact, marts, table, text, utc

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            SQL[name] = oracle
        return function

    return register


# --- keys ---------------------------------------------------------------------------------


@query("duplicate_keys", """SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("unique_keys", """SELECT user_id, event_type, count(*) AS "rows" FROM events
    GROUP BY user_id, event_type HAVING count(*) > 1""")
def unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query("not_null", """SELECT o_orderkey, o_custkey FROM orders LEFT JOIN customer
    ON o_custkey = c_custkey AND c_acctbal > 0 WHERE c_custkey IS NULL""")
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined with customers in credit: the customer is missing for the others."""
    solvent = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(solvent, F.col("o_custkey") == F.col("c_custkey"), "left")
    return quality.not_null(joined, "c_custkey").select("o_orderkey", "o_custkey")


@query("orphan_keys", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)""")
def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose part is not among the larger ones."""
    parent = table(spark, sf_dir, "part").where(F.col("p_size") > 10)
    items = table(spark, sf_dir, "lineitem")
    return quality.relationship(items, "l_partkey", parent, "p_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query("accepted_values", """SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderstatus NOT IN ('F', 'O')""")
def accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"]).select(
        "o_orderkey", "o_orderstatus"
    )


@query("missing_keys", """SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN
    (SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000)""")
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 1000)
    right = suppliers.select(F.col("s_suppkey").alias("l_suppkey"))
    return rows.missing_keys(table(spark, sf_dir, "lineitem"), right, ["l_suppkey"])


@query("set_difference", """SELECT c_custkey AS custkey FROM customer
    EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 450000""")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    large = table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 450000)
    buyers = large.select(F.col("o_custkey").alias("custkey"))
    return rows.missing_keys(customers, buyers, ["custkey"])


@query("captured_only", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN
    (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def captured_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    keys = returned.select(F.col("l_orderkey").alias("o_orderkey"))
    return rows.captured_only(table(spark, sf_dir, "orders"), keys, ["o_orderkey"]).select(
        "o_orderkey", "o_totalprice"
    )


@query("id_set_equality", """SELECT
    count(*) FILTER (b IS NULL) AS only_left, count(*) FILTER (a IS NULL) AS only_right,
    count(*) FILTER (a IS NULL OR b IS NULL) = 0 AS same
    FROM (SELECT DISTINCT o_orderkey AS a FROM orders)
    FULL JOIN (SELECT DISTINCT l_orderkey AS b FROM lineitem) ON a = b""")
def id_set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return rows.same_ids(orders, items, "id")


@query("compare_ids", sql.upto("minutes", """SELECT count(*) AS keys,
    count(*) FILTER (m.event_id IS NULL) AS missing, CAST(0 AS BIGINT) AS extra,
    count(*) FILTER (m.event_id IS NOT NULL AND s.price_usd IS DISTINCT FROM m.price_usd) AS different,
    'failed' AS status FROM stg s LEFT JOIN (
      SELECT event_id, price_usd + CASE WHEN price_usd > 50 THEN 1 ELSE 0 END AS price_usd
      FROM minutes) m ON s.event_id = m.event_id"""))
def compare_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events against the minute table with high prices changed."""
    chain = marts(spark, sf_dir)
    bump = F.when(F.col("price_usd") > 50, 1).otherwise(0)
    table_rows = chain.int_market_minutes().withColumn("price_usd", F.col("price_usd") + bump)
    return compare.compare_ids(chain.stg_prices(), table_rows, "event_id", ["price_usd"])


@query("required_members", """SELECT event_type FROM (VALUES ('click'), ('view'), ('refund'))
    v(event_type) WHERE event_type NOT IN (SELECT event_type FROM events)""")
def required_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return rows.missing_members(events, "event_type", ["click", "view", "refund"])


@query("scenario_union", """SELECT 'customer' AS origin, c_custkey AS id, c_acctbal AS amount
    FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier
    UNION ALL SELECT 'order', o_custkey, o_totalprice FROM orders""")
def scenario_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(name: str, origin: str, id_column: str, amount: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(origin).alias("origin"), F.col(id_column).alias("id"),
            F.col(amount).alias("amount"),
        )

    return rows.union_rows(
        part("customer", "customer", "c_custkey", "c_acctbal"),
        part("supplier", "supplier", "s_suppkey", "s_acctbal"),
        part("orders", "order", "o_custkey", "o_totalprice"),
    )


# --- upsert and archive -------------------------------------------------------------------

# Orders are the target unless their status is P; all orders are staged again at version 1 with
# another price. So there are inserts, updates of older rows, and rows that stay.
_MERGE = """
target AS (SELECT o_orderkey, o_orderkey % 3 AS version, o_totalprice, o_orderpriority
           FROM orders WHERE o_orderstatus <> 'P'),
staged AS (SELECT o_orderkey, CAST(1 AS BIGINT) AS version,
           o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS o_totalprice,
           o_orderpriority FROM orders)"""
ORDER_KEY = ["o_orderkey"]


def _merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    kept = orders.where(F.col("o_orderstatus") != "P")
    columns = ["o_orderkey", "version", "o_totalprice", "o_orderpriority"]
    target = kept.withColumn("version", F.col("o_orderkey") % 3).select(*columns)
    raised = F.col("o_totalprice") + F.when(F.col("o_orderpriority") == "1-URGENT", 0).otherwise(1)
    staged = orders.withColumns({"version": F.lit(1).cast("long"), "o_totalprice": raised})
    return target, staged.select(*columns)


@query("merge_latest", f"""WITH {_MERGE}
    SELECT s.o_orderkey,
      CASE WHEN t.o_orderkey IS NULL OR s.version > t.version THEN s.version ELSE t.version END
        AS version,
      CASE WHEN t.o_orderkey IS NULL OR s.version > t.version THEN s.o_totalprice
           ELSE t.o_totalprice END AS o_totalprice,
      s.o_orderpriority,
      CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.version > t.version THEN 'update'
           ELSE 'keep' END AS action
    FROM staged s LEFT JOIN target t USING (o_orderkey)""")
def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staged = _merge_sides(spark, sf_dir)
    return merge.merge_latest(target, staged, ORDER_KEY, "version", with_action=True)


@query("merge_reconcile", f"""WITH {_MERGE}
    SELECT s.* FROM staged s LEFT JOIN target t USING (o_orderkey)
    WHERE t.o_orderkey IS NULL OR t.version < s.version
      OR (t.version = s.version AND t.o_totalprice <> s.o_totalprice)""")
def merge_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staged = _merge_sides(spark, sf_dir)
    return merge.merge_mismatches(staged, target, ORDER_KEY, "version", ["o_totalprice"])


@query("merge_checked", f"""WITH {_MERGE}
    SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS duplicate_keys,
      CAST(0 AS BIGINT) AS invalid_rows,
      min(o_orderkey) AS first_date, max(o_orderkey) AS last_date,
      CAST(0 AS BIGINT) AS target_duplicates, CAST(0 AS BIGINT) AS staged_duplicates,
      (SELECT count(*) FROM staged s JOIN target t USING (o_orderkey)
       WHERE t.version = s.version AND t.o_totalprice <> s.o_totalprice) AS mismatches,
      false AS accepted FROM staged""")
def merge_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staged = _merge_sides(spark, sf_dir)
    _, gate = merge.merge_checked(
        target, staged, F.col("o_totalprice") <= 0, ORDER_KEY, "version", ["o_totalprice"]
    )
    return gate


_ARCHIVE = """
archive AS (SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
            WHERE o_orderdate < TIMESTAMP '2000-01-01'),
incoming AS (SELECT o_orderkey, o_totalprice + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END
             AS o_totalprice, o_orderpriority FROM orders
             WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
merged AS (SELECT coalesce(i.o_orderkey, a.o_orderkey) AS o_orderkey,
  coalesce(i.o_totalprice, a.o_totalprice) AS o_totalprice,
  coalesce(i.o_orderpriority, a.o_orderpriority) AS o_orderpriority,
  CASE WHEN a.o_orderkey IS NULL THEN 'added'
       WHEN i.o_totalprice <> a.o_totalprice THEN 'revised' ELSE 'unchanged' END AS change
  FROM archive a FULL JOIN incoming i USING (o_orderkey))"""


def _archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    old = orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    new = orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    raised = F.col("o_totalprice") + F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(0)
    new = new.withColumn("o_totalprice", raised)
    return merge.merge_archive(old.select(*columns), new.select(*columns), ORDER_KEY)


@query("archive_merge", f"WITH {_ARCHIVE} SELECT * FROM merged")
def archive_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archive(spark, sf_dir)


@query("archive_counts", f"""WITH {_ARCHIVE} SELECT count(*) AS total,
    count(*) FILTER (change = 'added') AS added, count(*) FILTER (change = 'revised') AS revised
    FROM merged""")
def archive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.archive_counts(_archive(spark, sf_dir))


# --- bars ---------------------------------------------------------------------------------


def _bars(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col(symbol).cast("string").alias("symbol"), utc("ts").alias("bar_start"),
        F.col("value").alias("price_usd"),
    )


@query("completed_bars", """SELECT event_id, event_type AS symbol FROM events
    WHERE ts + INTERVAL 3600 SECOND <= TIMESTAMP '2024-01-16 12:30:00'""")
def completed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit("2024-01-16 12:30:00").cast("timestamp")
    return bars.completed_bars(_bars(spark, sf_dir), as_of, 3600).select("event_id", "symbol")


@query("symbol_coverage", """SELECT CAST(user_id AS VARCHAR) AS symbol, count(*) AS downloaded,
    strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last
    FROM events GROUP BY user_id""")
def symbol_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = bars.symbol_coverage(_bars(spark, sf_dir, "user_id"))
    return covered.withColumns({"first": text("first"), "last": text("last")})


@query("overlap_align", """SELECT event_id, CAST(user_id AS VARCHAR) AS symbol FROM events
    WHERE ts BETWEEN (SELECT max(f) FROM (SELECT min(ts) AS f FROM events GROUP BY user_id))
                 AND (SELECT min(l) FROM (SELECT max(ts) AS l FROM events GROUP BY user_id))""")
def overlap_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.align_overlap(_bars(spark, sf_dir, "user_id")).select("event_id", "symbol")


@query("latest_sessions", """WITH s AS (SELECT event_id,
      CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS d FROM events)
    SELECT event_id FROM s WHERE d IN (SELECT DISTINCT d FROM s ORDER BY d DESC LIMIT 5)""")
def latest_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.latest_sessions(_bars(spark, sf_dir), 5).select("event_id")


@query("window_check", """SELECT count(*) AS "rows", CAST(1 AS BIGINT) AS absent_symbols,
    CAST(3 AS BIGINT) AS foreign_symbols,
    false AS accepted FROM events""")
def window_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three symbols are required, of which one does not occur."""
    return bars.window_violations(_bars(spark, sf_dir), ["click", "view", "refund"])


@query("is_stale", """SELECT strftime(i, '%Y-%m-%d %H:%M:%S') AS newest_incoming,
    strftime(a, '%Y-%m-%d %H:%M:%S') AS newest_archived, i < a AS stale
    FROM (SELECT max(ts) FILTER (event_type = 'click') AS i,
                 max(ts) FILTER (event_type <> 'click') AS a FROM events)""")
def is_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = _bars(spark, sf_dir)
    clicks = F.col("symbol") == "click"
    return bars.is_stale(every.where(clicks), every.where(~clicks)).withColumns(
        {"newest_incoming": text("newest_incoming"), "newest_archived": text("newest_archived")}
    )


@query("check_bars", """WITH b AS (SELECT CAST(user_id AS VARCHAR) AS symbol,
      date_trunc('hour', ts) AS t, value - 2 AS p FROM events),
    k AS (SELECT symbol, t, count(*) AS n, count(*) FILTER (p <= 0) AS bad FROM b GROUP BY symbol, t)
    SELECT symbol, CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(n - 1) AS BIGINT) AS repeated_times,
    CAST(0 AS BIGINT) AS unzoned_times, CAST(0 AS BIGINT) AS foreign_currency, CAST(sum(bad) AS BIGINT) AS bad_prices
    FROM k GROUP BY symbol HAVING sum(n - 1) + sum(bad) > 0""")
def check_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of every user by hour, with prices lowered by two."""
    raw = _bars(spark, sf_dir, "user_id").select(
        "symbol", s.iso_text(F.date_trunc("hour", "bar_start")).alias("bar_start_utc"),
        (F.col("price_usd") - 2).alias("price_usd"), F.lit(c.CURRENCY).alias("currency"),
    )
    return quality.check_bars(raw)


@query("tail_bars", """SELECT event_type AS symbol, event_id FROM (
    SELECT * FROM events ORDER BY ts DESC, event_type DESC LIMIT 200)""")
def tail_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.tail_bars(_bars(spark, sf_dir), 200, "bar_start").select("symbol", "event_id")


@query("time_ordered", "SELECT event_type AS symbol, event_id FROM events ORDER BY ts, event_type")
def time_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.time_ordered(_bars(spark, sf_dir), "bar_start").select("symbol", "event_id")


# --- rates --------------------------------------------------------------------------------


@query("fx_batch_check", sql.with_fx("""SELECT count(*) + 1 AS total_rows, CAST(1 AS BIGINT) AS duplicate_keys,
    CAST(0 AS BIGINT) AS invalid_rows, strftime(min(jisdor_date), '%Y-%m-%d') AS first_date,
    strftime(max(jisdor_date), '%Y-%m-%d') AS last_date, false AS accepted FROM fx"""))
def fx_batch_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch holds its latest rate twice."""
    fx = fx_fact(spark, sf_dir)
    batch = rows.union_rows(fx, rows.top_fx(fx, 1))
    checked = quality.check_fx_batch(batch)
    return checked.withColumns({"first_date": day("first_date"), "last_date": day("last_date")})


@query("fx_record_check", """SELECT event_id,
    CASE WHEN event_id % 7 = 1 THEN 'date' WHEN event_id % 7 IN (2, 3) THEN 'rate'
         WHEN event_id % 7 = 4 THEN 'currency' WHEN event_id % 7 = 5 THEN 'ingested_at'
         WHEN event_id % 7 = 6 THEN 'source' ELSE NULL END AS error FROM events""")
def fx_record_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate record per event, six out of seven broken in a known way."""
    kind = F.col("event_id") % 7
    rate = F.round(F.col("value") + 1, 2).cast("string")  # some events have the value zero, which is no rate
    stamp = s.iso_text(utc("ts"))
    records = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == 1, F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("jisdor_date"),
        F.when(kind == 4, "EUR").otherwise("USD").alias("currency"),
        F.when(kind == 2, F.concat(F.lit("-"), rate))
        .when(kind == 3, F.concat(rate, F.lit("00000000001"))).otherwise(rate).alias("usd_idr"),
        F.when(kind != 6, "daily events").alias("source"),
        F.when(kind == 5, F.regexp_replace(stamp, r"\+00:00$", "")).otherwise(stamp)
        .alias("ingested_at"),
        F.lit(None).cast("string").alias("fx_available_at"),
    )
    return quality.check_fx_record(records).select("event_id", "error")


@query("outside_interval", sql.with_fx("""SELECT strftime(jisdor_date, '%Y-%m-%d') AS jisdor_date
    FROM fx WHERE jisdor_date NOT BETWEEN DATE '2024-01-08' AND DATE '2024-01-19'"""))
def outside_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fx_fact(spark, sf_dir)
    return quality.outside_interval(fx, "2024-01-08", "2024-01-19").select(
        day("jisdor_date").alias("jisdor_date")
    )


@query("processed_vs_raw", sql.with_fx("""SELECT strftime(jisdor_date, '%Y-%m-%d') AS jisdor_date,
    CASE WHEN day(jisdor_date) < 5 THEN 'not_processed' WHEN day(jisdor_date) < 10 THEN 'rate'
         WHEN day(jisdor_date) < 15 THEN 'ingested_at' ELSE 'fx_available_at' END AS problem
    FROM fx WHERE day(jisdor_date) < 15 OR fx_available_at IS NOT NULL"""))
def processed_vs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed records lack the first days and carry other faults later in the month."""
    fx, number = fx_fact(spark, sf_dir), F.dayofmonth("jisdor_date")
    rate = F.when(number < 10, F.col("usd_idr") + 1).otherwise(F.col("usd_idr"))
    stamp = s.iso_text(F.col("ingested_at"))
    processed = fx.where(number >= 5).select(
        F.col("jisdor_date").cast("string").alias("jisdor_date"), "currency",
        rate.cast("string").alias("usd_idr"), "source",
        F.when(number < 15, F.substring(stamp, 1, 19)).otherwise(stamp).alias("ingested_at"),
        s.iso_text(F.col("fx_available_at")).alias("fx_available_at"),
    )
    return quality.check_processed_vs_raw(fx, processed, "daily events").withColumn(
        "jisdor_date", day("jisdor_date")
    )


# --- scalar functions ---------------------------------------------------------------------


@query("text_functions", """SELECT event_id, upper(trim(' ' || event_type || ' ')) AS code,
    CAST(user_id AS VARCHAR) || '|' || event_type AS key, sha256(props) AS digest,
    to_base64(encode(props)) AS encoded, props AS decoded,
    CAST(json_extract(props, '$.k') AS BIGINT) AS k, '"' || replace(props, '"', '\\"') || '"' AS quoted,
    regexp_full_match(strftime(ts, '%Y%m%dT%H%M%S%f') || CASE WHEN user_id > 50 THEN 'Z' ELSE '' END,
      '\\d{8}T\\d{12}Z') AS is_run
    FROM events""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    run = F.concat(
        F.date_format("ts", "yyyyMMdd'T'HHmmssSSSSSS"), F.when(F.col("user_id") > 50, "Z").otherwise("")
    )
    encoded = s.b64(props.cast("binary"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        s.clean_code(F.concat(F.lit(" "), F.col("event_type"), F.lit(" "))).alias("code"),
        s.key_text(F.col("user_id"), F.col("event_type")).alias("key"),
        s.sha256_hex(props).alias("digest"),
        encoded.alias("encoded"),
        s.utf8_text(s.try_b64(encoded)).alias("decoded"),
        s.try_json(props, "k BIGINT").getField("k").alias("k"),
        s.json_quoted(props).alias("quoted"),
        s.is_run_id(run).alias("is_run"),
    )


@query("time_functions", """SELECT event_id,
    strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute,
    strftime(time_bucket(INTERVAL 900 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS quarter,
    strftime(timezone('Asia/Jakarta', timezone('UTC', ts)), '%Y-%m-%d') AS jakarta,
    strftime(timezone('America/New_York', timezone('UTC', ts)), '%Y-%m-%d') AS new_york,
    CAST(floor(epoch(ts)) AS BIGINT) AS seconds,
    strftime(ts + INTERVAL 90 SECOND, '%Y-%m-%d %H:%M:%S') AS later,
    date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days,
    dayofweek(ts) + 1 AS weekday,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN extract('microsecond' FROM ts) % 1000000 = 0
      THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS iso,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed,
    strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S') AS from_ms,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS run,
    CAST(NULL AS VARCHAR) AS naive FROM events""")
def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = utc("ts")
    iso = s.iso_text(ts)
    run = F.concat(F.date_format("ts", "yyyyMMdd'T'HHmmssSSSSSS"), F.lit("Z"))

    def shown(value):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")

    return table(spark, sf_dir, "events").select(
        "event_id",
        shown(s.bar_start(ts)).alias("minute"),
        shown(s.bar_start(ts, 900)).alias("quarter"),
        F.date_format(s.local_date(ts, c.LOCAL_ZONE), "yyyy-MM-dd").alias("jakarta"),
        F.date_format(s.local_date(ts, c.SESSION_ZONE), "yyyy-MM-dd").alias("new_york"),
        s.epoch(ts).alias("seconds"),
        shown(s.add_seconds(ts, 90)).alias("later"),
        s.days_between(F.to_date(ts), F.lit("2024-01-01").cast("date")).cast("long").alias("days"),
        s.day_of_week(F.to_date(ts)).cast("long").alias("weekday"),
        iso.alias("iso"),
        shown(s.zoned_time(iso)).alias("parsed"),
        shown(s.from_millis(F.unix_millis(ts))).alias("from_ms"),
        shown(s.run_time(run)).alias("run"),
        shown(s.zoned_time(F.substring(iso, 1, 19))).alias("naive"),
    )


@query("number_functions", """SELECT event_id,
    round(value / nullif(user_id % 10, 0), 6) AS ratio, abs(value - 50) AS distance,
    coalesce(CASE WHEN value > 50 THEN value END, 0.0) AS filled,
    CASE WHEN value > 100 THEN 'high' ELSE 'low' END AS level,
    CAST(CAST(value AS DECIMAL(38,9)) AS DOUBLE) AS as_double,
    value < 1 AS infinite, NOT value < 1 AS finite,
    CASE WHEN value > 50 THEN value END IS DISTINCT FROM value AS differs,
    user_id IN (1, 2, 3) AS member FROM events""")
def number_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    odd = F.when(value < 1, F.lit(float("inf"))).otherwise(value)
    high = F.when(value > 50, value)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.round(s.safe_div(value, F.col("user_id") % 10), 6).alias("ratio"),
        F.abs(value - 50).alias("distance"),
        F.coalesce(high, F.lit(0.0)).alias("filled"),
        s.choose(value > 100, F.lit("high"), F.lit("low")).alias("level"),
        s.as_double(s.try_rate(value.cast("string"))).alias("as_double"),
        s.is_bad_number(odd).alias("infinite"),
        s.is_finite(odd).alias("finite"),
        s.differs(high, value).alias("differs"),
        s.in_set(F.col("user_id"), [1, 2, 3]).alias("member"),
    )


@query("run_dedup", """WITH r AS (SELECT e.*, n FROM events e CROSS JOIN (VALUES (0), (1), (2)) v(n))
    SELECT CASE WHEN n = 2 THEN 'run_b' ELSE 'run_a' END AS demo_run_id, event_id,
    event_id * 3 + n AS kafka_offset FROM r
    QUALIFY row_number() OVER (PARTITION BY CASE WHEN n = 2 THEN 'run_b' ELSE 'run_a' END, event_id
      ORDER BY ts + to_minutes(CASE WHEN user_id > 70 THEN n ELSE 0 END) DESC,
        event_id * 3 + n DESC) = 1""")
def run_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is stored three times, twice in one run and once in another."""
    stored = table(spark, sf_dir, "events").withColumn("n", F.explode(F.array(*map(F.lit, range(3)))))
    delay = F.when(F.col("user_id") > 70, F.col("n")).otherwise(0)
    stored = stored.select(
        F.when(F.col("n") == 2, "run_b").otherwise("run_a").alias("demo_run_id"), "event_id",
        (F.col("event_id") * 3 + F.col("n")).alias("kafka_offset"),
        F.timestamp_micros(F.unix_micros(utc("ts")) + delay * 60_000_000).alias("sink_requested_at"),
    )
    return rows.dedup_run_events(stored).select("demo_run_id", "event_id", "kafka_offset")
