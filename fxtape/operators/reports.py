"""Aggregations over the marts, the rates and the stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.operators.rows import BAR_KEYS

SELECTION = ("symbol", "session_date")


def fx_audit(fx: DataFrame) -> DataFrame:
    """Rows, dates, first and last date, and invalid rates, as one row."""
    invalid = (
        F.col("usd_idr").isNull() | (F.col("usd_idr") <= 0) | (F.col("currency") != c.CURRENCY)
    )
    return fx.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("jisdor_date").alias("dates"),
        F.min("jisdor_date").alias("first_date"),
        F.max("jisdor_date").alias("last_date"),
        F.count_if(invalid).alias("invalid"),
    )


def history_audit(mart: DataFrame) -> DataFrame:
    """Rows, events, symbols, missing rates, wrong modes, first and last bar, as one row.

    Event ids are grouped once; symbols are few and ride along as a set.
    """
    per_event = mart.groupBy("event_id", "symbol").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("usd_idr").isNull()).alias("missing_fx"),
        F.count_if(F.col("data_kind") != c.REPLAY_KIND).alias("wrong_mode"),
        F.min("minute_utc").alias("first_minute"),
        F.max("minute_utc").alias("last_minute"),
    )
    return per_event.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.countDistinct("event_id").alias("unique_events"),
        F.countDistinct("symbol").alias("symbols"),
        F.coalesce(F.sum("missing_fx"), F.lit(0)).alias("missing_fx"),
        F.coalesce(F.sum("wrong_mode"), F.lit(0)).alias("wrong_mode"),
        F.min("first_minute").alias("first_minute"),
        F.max("last_minute").alias("last_minute"),
    )


def signal_distribution(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return mart.groupBy(*by, "strategy_signal").agg(F.count(F.lit(1)).alias("row_count"))


def signal_counts() -> list[Column]:
    return [F.count_if(F.col("strategy_signal") == name).alias(name) for name in c.SIGNALS]


def signal_pivot(mart: DataFrame) -> DataFrame:
    """Bars, signals, missing rates and incomplete comparisons of every symbol."""
    return mart.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"),
        *signal_counts(),
        F.count_if(F.col("usd_idr").isNull()).alias("missing_fx"),
        F.count_if(~F.coalesce("comparison_complete", F.lit(False))).alias("incomplete_comparison"),
    )


def last_minute(mart: DataFrame, keys: Sequence[str] = tuple(BAR_KEYS)) -> DataFrame:
    return mart.groupBy(*keys).agg(F.max("minute_utc").alias("last_minute"))


def run_metrics(events: DataFrame, by: str = "run_id") -> DataFrame:
    """Records, valid and invalid ones, unique ids, modes, first and last processing time and mean
    delay of every run.

    ``events`` are decoded, with ``error``, ``processed_at`` and the run. Counted per event id
    first, so a run that holds most rows is aggregated by many tasks. Delays are summed as decimals: those
    of a replay may be years, of which a long holds a hundred thousand in microseconds.
    """
    valid = F.col("error").isNull()
    delay = (F.unix_micros("processed_at") - F.unix_micros("ingested_at")).cast("decimal(20,0)")
    per_id = events.groupBy(by, F.when(valid, F.col("event_id")).alias("event_id"),
                            F.when(valid, F.col("ingestion_mode")).alias("mode")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(valid).alias("valid"),
        F.min(F.when(valid, F.col("processed_at"))).alias("first"),
        F.max(F.when(valid, F.col("processed_at"))).alias("last"),
        F.sum(F.when(valid, delay)).alias("delay"),
    )
    per_mode = per_id.groupBy(by, "mode").agg(
        F.sum("records").alias("records"),
        F.sum("valid").alias("valid"),
        F.count("event_id").alias("ids"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("delay").alias("delay"),
    )
    mean = F.try_divide(F.sum("delay").cast("double"), F.sum("valid") * F.lit(1e6))
    return per_mode.groupBy(by).agg(
        F.sum("records").alias("kafka_records"),
        F.sum("valid").alias("valid"),
        (F.sum("records") - F.sum("valid")).alias("invalid"),
        F.sum("ids").alias("unique_event_ids"),
        F.array_sort(F.collect_set("mode")).alias("modes"),
        F.min("first").alias("first_processed_at"),
        F.max("last").alias("last_processed_at"),
        mean.alias("mean_replay_processing_seconds"),
    )


def stream_progress(sink: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows and last sink time of every run, or of one."""
    shown = sink if run_id is None else sink.where(F.col("demo_run_id") == run_id)
    return shown.groupBy("demo_run_id").agg(
        F.count(F.lit(1)).alias("visible_records"), F.max("sink_requested_at").alias("last_sink_at")
    )


def _last(value: Column) -> Column:
    return F.max_by(value, F.struct("minute_utc", "event_id"))


def _first(value: Column) -> Column:
    return F.min_by(value, F.struct("minute_utc", "event_id"))


def selection_summary(mart: DataFrame, by: Sequence[str] = SELECTION) -> DataFrame:
    """Last price and value, observations, missing rates, review and insufficient counts, signals."""
    return mart.groupBy(*by).agg(
        _last(F.col("price_usd")).alias("last_price_usd"),
        _last(F.col("exposure_idr")).alias("last_exposure_idr"),
        F.count(F.lit(1)).alias("observations"),
        F.count_if(F.col("usd_idr").isNull()).alias("missing_fx"),
        F.count_if(F.col("risk_indicator") == c.RISK_LABELS[1]).alias("review"),
        F.count_if(F.col("risk_indicator") == c.RISK_LABELS[0]).alias("insufficient"),
        *signal_counts(),
    )


def selection_contribution(mart: DataFrame, by: Sequence[str] = SELECTION) -> DataFrame:
    """Split of the change from the first to the last bar of a selection.

    NULL when either end has no rate.
    """
    state = F.struct("price_usd", F.col("usd_idr").cast("double").alias("rate"), "exposure_idr")
    ends = mart.groupBy(*by).agg(_first(state).alias("a"), _last(state).alias("z"))
    price = F.col("z.price_usd") - F.col("a.price_usd")
    rate = F.col("z.rate") - F.col("a.rate")
    known = rate.isNotNull()
    return ends.select(
        *by,
        F.when(known, price * F.col("a.rate")).alias("asset_effect_idr"),
        F.when(known, F.col("a.price_usd") * rate).alias("fx_effect_idr"),
        F.when(known, price * rate).alias("interaction_effect_idr"),
        F.when(known, F.col("z.exposure_idr") - F.col("a.exposure_idr")).alias("total_change_idr"),
    )


def selection_last(mart: DataFrame, by: Sequence[str] = SELECTION) -> DataFrame:
    """The latest row of every selection."""
    return mart.groupBy(*by).agg(_last(F.struct(*mart.columns)).alias("row")).select("row.*")


def readiness(
    fx: DataFrame, mart: DataFrame, latest: DataFrame, scenarios: DataFrame, universe_size: int
) -> DataFrame:
    """Six named checks and their status, as one row."""
    one = F.lit(1).alias("_one")
    batch = fx_audit(fx).select(
        (
            (F.col("row_count") > 0)
            & (F.col("row_count") == F.col("dates"))
            & (F.col("invalid") == 0)
        ).alias("batch_nonempty_unique_valid"),
        one,
    )
    history = history_audit(mart).select(
        ((F.col("row_count") > 0) & (F.col("row_count") == F.col("unique_events"))).alias(
            "history_nonempty_unique"
        ),
        ((F.col("symbols") == universe_size) & (F.col("missing_fx") == 0)).alias(
            "four_stocks_with_fx"
        ),
        (F.col("wrong_mode") == 0).alias("replay_labelled"),
        one,
    )
    aligned = F.col("aligned_with_latest") & F.col("comparison_complete")
    newest = latest.agg(
        (
            (F.count(F.lit(1)) == universe_size)
            & (F.count_if(F.coalesce(aligned, F.lit(False))) == universe_size)
        ).alias("latest_four_aligned"),
        one,
    )
    wrong = ~F.col("strategy_signal").eqNullSafe(F.col("expected_signal"))
    rules = scenarios.agg(
        ((F.count(F.lit(1)) > 0) & (F.count_if(wrong) == 0)).alias("synthetic_scenarios_match"), one
    )
    joined = batch.join(history, "_one").join(newest, "_one").join(rules, "_one").drop("_one")
    passed = F.lit(True)
    for name in joined.columns:
        passed = passed & F.col(name)
    return joined.withColumn("status", F.when(passed, "passed").otherwise("failed"))
