"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registry import commits, market, messages, relations, reports
from registry.tables import SMOKE_RULES, marts

_GROUPS = (market, reports, relations, messages, commits)
QUERIES = {name: run for group in _GROUPS for name, run in group.QUERIES.items()}
SQL = {name: text for group in _GROUPS for name, text in group.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.monitoring_columns(marts(spark, sf_dir, SMOKE_RULES).mart_stock_monitoring())
