"""The registered queries: each reads whole tables of a folder, most with SQL for a side-by-side check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tenure.plans.adapters import Tables


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register the decorated function under its own name."""

    def register(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name or run.__name__] = Query(run, sql)
        return run

    return register
