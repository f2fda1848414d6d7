"""The registry of the base package's queries and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_ALL: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function of (spark, sf_dir) under its own name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        _ALL[f.__name__] = Query(f, sql)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; those of texts, on which work is heavy, dealt out if they are small."""
    from .operators.spread import dealt

    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt(rows) if name in ("documents", "pages") else rows


def _load() -> None:
    from .plans import register  # noqa: F401  fills the registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: q.run for name, q in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: q.sql for name, q in _ALL.items() if q.sql}
