"""Audit of all marts and the exports that depend on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fxtape import constants as c
from fxtape.operators import quality, reports
from fxtape.plans.marts import Marts
from fxtape.shared import published
from fxtape.sinks import writers


def mart_checks(
    marts: Marts, stored: DataFrame, latest: DataFrame, symbols: Sequence[str] = tuple(c.SYMBOLS)
) -> dict[str, DataFrame]:
    """Every row check of the chain, by name; each holds its violating rows.

    The stored monitoring mart has every row and column of the valuation and of the risk mart, so
    their checks read it instead of computing the chain again. The staged prices are stored first
    because several checks read them.
    """
    stg = published(marts.stg_prices(), "stg_prices")
    fact = risk = stored
    checks = {
        "stg_event_id_unique": quality.unique(stg, ["event_id"]),
        "stg_price_present": quality.not_null(stg, "price_usd"),
        "stg_symbol_known": quality.relationship(stg, "symbol", marts.dim, "symbol"),
        "dim_symbol_unique": quality.unique(marts.dim, ["symbol"]),
        "dim_currency_present": quality.not_null(marts.dim, "currency"),
        "fact_event_id_unique": quality.unique(fact, ["event_id"]),
        "fact_quantity": quality.accepted(fact, "quantity", [marts.rules.quantity]),
        "risk_event_id_unique": quality.unique(risk, ["event_id"]),
        "risk_labels": quality.accepted(risk, "risk_indicator", c.RISK_LABELS),
        "monitoring_event_id_unique": quality.unique(stored, ["event_id"]),
        "latest_event_id_unique": quality.unique(latest, ["event_id"]),
        "contributions_reconcile": quality.contributions_reconcile(risk),
        "all_symbols_collected": quality.symbols_collected(stored, len(symbols)),
        "latest_uses_source_time": quality.latest_uses_source_time(latest, stored),
        "market_not_empty": quality.not_empty(stg),
        "no_future_fx": quality.no_future_fx(fact),
        "monitoring_contract": quality.monitoring_contract(stored),
        "valid_prices": quality.valid_prices(stg, symbols),
    }
    for name, frame in (("stg", stg), ("fact", fact), ("risk", risk), ("monitoring", stored),
                        ("latest", latest)):
        checks[f"{name}_event_id_present"] = quality.not_null(frame, "event_id")
    return checks


def check_report(checks: dict[str, DataFrame]) -> DataFrame:
    """Name and number of violations of every check."""
    counted = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, rows in checks.items()
    ]
    report = counted[0]
    for row in counted[1:]:
        report = report.unionByName(row)
    return report


def audit_and_export(
    marts: Marts, root: str, exported_at: str, max_rows: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Readiness row of the chain, and the exported monitoring mart with its counters.

    The exports hold every row; an empty mart, foreign modes, and more than ``max_rows`` rows where
    that is given, are refused.
    """
    spark = marts.raw.sparkSession
    stored = marts.publish_monitoring()
    latest = marts.mart_stock_latest(stored)
    ready = reports.readiness(
        marts.fx, stored, latest, quality.signal_scenarios(spark), marts.rules.universe_size
    )
    order = ["symbol", "ingestion_mode", "minute_utc"]
    exported = writers.export_checked(stored, f"{root}/csv", order, max_rows)
    provenance = {"exported_at": exported_at, "source": "mart_stock_monitoring", "mode": c.REPLAY_MODE}
    writers.export_json(stored, f"{root}/json", provenance)
    counters = stored.agg(
        F.count_if(F.col("usd_idr").isNull()).alias("missing_fx"),
        F.count_if(F.col("risk_indicator") == c.RISK_LABELS[1]).alias("review_movements"),
    ).first()
    return ready, {"rows": exported, **counters.asDict()}
