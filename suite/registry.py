"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def query(name: str, operators: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name``; ``operators`` lists the inventory entries it covers."""
    def add(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql, operators)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round result columns, as the SQL side does: sums of doubles depend on their order."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
