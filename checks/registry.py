"""All registered queries and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from checks import dashboard, features, loading, models, pages, plans, reviews
from termscope.session import local_scratch, tune

MODULES = (features, reviews, dashboard, loading, pages, models, plans)


def _tuned(run: Callable) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(local_scratch(tune(spark)), sf_dir)

    return call


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _tuned(run) for m in MODULES for name, run in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
