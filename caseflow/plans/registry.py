"""Query catalogue: one Spark query per inventory group, with its SQL oracle.

Each query takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables.  The oracle, when present, is an independent DuckDB text over
the same parquet tables (pre-registered as views by name).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(name: str, covers: str, oracle: str | None = None):
    """Register a query under ``name`` (``covers`` lists inventory ids)."""

    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        COVERS[name] = covers
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import q_cases, q_scoring, q_evolve, q_validate, q_features, q_report, q_model, q_sketch  # noqa: F401
