"""Registry of checked queries: Spark query + DuckDB oracle + shared output spec.

Each Spark query reads the driver tables of ``sf_dir`` (or data Spark derives from them) and runs over
whole tables.  Oracles are independent plain-SQL formulations (global windows, cross joins, recursive
CTEs) of the same semantics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from raretide.plans.spec import spark_project, sql_project

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, spec: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle ``sql``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return spark_project(fn(spark, sf_dir), spec)
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql_project(sql, spec)
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from raretide.plans import q_series, q_eval, q_misc, q_models, q_online, q_training  # noqa: F401
