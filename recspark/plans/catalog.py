"""Registry of named queries over the driver's tables.

Every query is registered with the Spark callable ``(spark, sf_dir) ->
DataFrame`` and, when it is SQL-expressible, the DuckDB oracle text that
computes the same columns from the same parquet views.  Names are the
operator IDs of the blueprint (``R4_swing``, ``N1_auc``, ...).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco
