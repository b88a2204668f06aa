"""Data profiling aggregates.

All are single aggregate jobs with map-side partial aggregation; the result
size is bounded by the number of profiled columns (and, for value counts, by
the number of distinct values, which is returned as a DataFrame, never
collected).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.quantiles import exact_quantiles


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, value, count)`` for every listed column (one unpivot, one grouping)."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("_kv"))
    return stacked.groupBy("_kv.column", "_kv.value").agg(F.count(F.lit(1)).alias("count"))


def numeric_profile(df: DataFrame, cols: list[str], probs: list[float] | None = None,
                    approx: bool = False) -> DataFrame:
    """A12 (+A6, A7, A9): one row per column with count, nulls, min, max, mean,
    std (population) and the requested percentiles - all from one aggregate."""
    probs = probs or [0.0, 0.25, 0.5, 0.75, 1.0]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        parts = [F.lit(c).alias("column"), F.count(x).alias("count"), F.sum(x.isNull().cast("long")).alias("nulls"),
                 F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")]
        if approx:
            parts.append(F.percentile_approx(x, probs, 10000).alias("percentiles"))
        aggs.append(F.struct(*parts).alias(f"c{i}"))
    row = df.agg(*aggs)
    prof = row.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(cols))])).alias("p")).select("p.*")
    if approx:
        return prof
    # exact percentiles without a single-task value map (see ``quantiles``); one row per column
    qs = exact_quantiles(df, cols, probs)
    pct = df.sparkSession.createDataFrame([(c, qs[c]) for c in cols], "column string, percentiles array<double>")
    return prof.join(F.broadcast(pct), "column")


def all_null_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, all_null)`` in one pass."""
    row = df.agg(*[(F.count(F.col(c)) == 0).alias(c) for c in cols])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("all_null"))
                                          for c in cols])).alias("p")).select("p.*")


def list_length_counts(df: DataFrame, col: str) -> DataFrame:
    """``(length, count)`` of a list column."""
    return df.groupBy(F.size(col).alias("length")).agg(F.count(F.lit(1)).alias("count"))
