"""Exact quantiles and modes without a single-task buffer.

Spark's exact ``percentile`` / ``median`` / ``mode`` aggregates keep a
value -> count map that is merged in one task for a whole-table aggregate.
Here the same exact answers come from distributed steps:

* counts per distinct value - ``groupBy(feature, value).count()``;
* the number of rows below each value - the bucketed prefix sum also used
  for AUC: values are cut into ranges by approximate quantiles, each range
  gets the count of all earlier ranges from a table of ``buckets`` rows per
  feature, plus its own running sum;
* every wanted rank is routed to its range by that small table and found by
  an equi-join on ``(feature, range)`` plus a range filter.

The interpolation is the one of Spark's ``percentile``: position ``(n - 1) *
p`` between the two neighbouring order statistics, each weighted by the
distance to the other.  All columns take this path, whatever their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.session import cut_lineage


def _stack(df: DataFrame, cols: list[str]) -> DataFrame:
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                             for c in cols]))
    return df.select(kv.alias("_kv")).select("_kv.*").where(F.col("value").isNotNull() & ~F.isnan("value"))


def value_counts_with_rank(df: DataFrame, cols: list[str], buckets: int = 64) -> DataFrame:
    """``(feature, value, c, below, n, _b)``: ``below`` = rows with a smaller value."""
    g = _stack(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
    probs = [i / buckets for i in range(1, buckets)] or [0.5]
    # cut off: approximate edges worked out twice may differ with the order of arrival, and the ranges read them twice
    edges = cut_lineage(g.groupBy("feature").agg(F.percentile_approx("value", probs, 10000).alias("_e"),
                                                 F.sum("c").alias("n")))
    gb = (g.join(F.broadcast(edges), "feature")  # one row per feature: bounded
          .withColumn("_b", F.size(F.filter("_e", lambda e: e < F.col("value")))).drop("_e"))
    bt = gb.groupBy("feature", "_b").agg(F.sum("c").alias("_bc"))
    off = bt.withColumn("_off", F.coalesce(F.sum("_bc").over(
        Window.partitionBy("feature").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.coalesce(F.sum("c").over(
        Window.partitionBy("feature", "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (gb.withColumn("_w", within).join(F.broadcast(off.select("feature", "_b", "_off", "_bc")),
                                               ["feature", "_b"])
            .withColumn("below", F.col("_off") + F.col("_w")).drop("_w"))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], buckets: int = 64) -> dict[str, list]:
    """``{column: [quantile for each p]}`` (``None`` for an all-null column)."""
    if not cols:
        return {}
    ranked = cut_lineage(value_counts_with_rank(df, cols, buckets))  # read three times below
    spark = df.sparkSession
    ns = {r["feature"]: r["n"] for r in ranked.select("feature", "n").distinct().collect()}
    targets = []
    for c, n in ns.items():
        for i, p in enumerate(probs):
            pos = (n - 1) * p
            lo = int(pos)
            hi = min(lo + 1, n - 1) if pos > lo else lo
            targets += [(c, i, 0, lo, float(pos - lo)), (c, i, 1, hi, float(pos - lo))]
    if not targets:
        return {c: None for c in cols}
    t = spark.createDataFrame(targets, "feature string, i int, side int, r long, frac double")
    # route each wanted rank to the range holding it (small table: features x buckets)
    ranges = ranked.select("feature", "_b", "_off", "_bc").distinct()
    routed = t.join(F.broadcast(ranges), "feature").where(
        (F.col("r") >= F.col("_off")) & (F.col("r") < F.col("_off") + F.col("_bc"))).select("feature", "i", "side",
                                                                                              "r", "frac", "_b")
    hit = ranked.join(F.broadcast(routed), ["feature", "_b"]).where(
        (F.col("r") >= F.col("below")) & (F.col("r") < F.col("below") + F.col("c"))).select(
        "feature", "i", "side", "frac", "value")
    got = {}
    for row in hit.collect():  # features x probs x 2 rows
        got[(row["feature"], row["i"], row["side"])] = (row["value"], row["frac"])
    out = {}
    for c in cols:
        if c not in ns:
            out[c] = None
            continue
        vals = []
        for i in range(len(probs)):
            lo, frac = got[(c, i, 0)]
            hi, _ = got[(c, i, 1)]
            vals.append((1 - frac) * lo + frac * hi if frac else lo)
        out[c] = vals
    return out


def exact_modes(df: DataFrame, cols: list[str]) -> dict[str, object]:
    """Most frequent non-null value per column; ties -> smallest value (pandas ``mode()[0]``).

    A T3 arg-max over distributed counts: ``min_by(value, (-count, value))``.
    """
    out: dict[str, object] = {}
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for cs in by_type.values():
        kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in cs]))
        counts = (df.select(kv.alias("_kv")).select("_kv.*").where(F.col("value").isNotNull())
                  .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
        best = counts.groupBy("feature").agg(
            F.min_by("value", F.struct((-F.col("n")).alias("a"), F.col("value").alias("b"))).alias("mode"))
        out.update({r["feature"]: r["mode"] for r in best.collect()})
    return {c: out.get(c) for c in cols}
