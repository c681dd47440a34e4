"""All queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldloom.plans import articles, data_problems, feeds, mapping, models, panels

MODULES = [data_problems, feeds, mapping, panels, articles, models]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}


def flagship(spark: SparkSession, root: str) -> DataFrame:
    """The forecasting table: last observed and next score of every district and month."""
    return panels.forecast_targets(spark, root)
