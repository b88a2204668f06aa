"""A1 / P5: distinct users by mergeable sketches, stored per key and day.

``daily_sketches`` keeps one HyperLogLog sketch per key and day (at most
``2**lg_k`` bytes, less while few users are seen), built by partial aggregation.
Any later question - all time, the last N days as of each day - is a union of
stored sketches and never reads the log again; an exact count would have to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: 2**14 registers: a standard error of about 0.8 %.
LG_K = 14


def daily_sketches(log: DataFrame, key: str, user: str, day: Column, lg_k: int = LG_K) -> DataFrame:
    """``(key, day, users)``: a sketch of the distinct users of each key and day; null users count for nothing."""
    seen = log.where(F.col(user).isNotNull() & day.isNotNull())
    return seen.groupBy(key, day.cast("date").alias("day")).agg(
        F.hll_sketch_agg(F.col(user).cast("string"), F.lit(lg_k)).alias("users"))


def approx_users(sketches: DataFrame, key: str, out: str = "n_users") -> DataFrame:
    """``(key, out)``: estimated distinct users of each key over all stored days."""
    return sketches.groupBy(key).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias(out))


def rolling_users(sketches: DataFrame, key: str, days: int, out: str = "n_users") -> DataFrame:
    """``(key, day, out)``: for each stored day, estimated distinct users of the ``days`` days that end with it.

    A sketch is sent to the days it counts for (``days`` rows of bounded size),
    not the log's rows; days without a sketch of the key give no row.
    """
    spread = sketches.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    spread = spread.select(key, F.date_add("day", F.col("at")).alias("day"), "users")
    rolled = spread.groupBy(key, "day").agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias(out))
    return rolled.join(sketches.select(key, "day"), [key, "day"], "left_semi")


def exact_rolling_users(seen: DataFrame, key: str, user: str, days: int, out: str = "n_users") -> DataFrame:
    """``(key, day, out)``: distinct users of the ``days`` days that end with each day, from distinct ``(key, user, day)``.

    A user counts from a day seen until ``days`` later, or until the next day seen:
    one step up and one down a row, added up along the days of a key.  Nothing is
    sent to the days between; a key's sums are one row a day.
    """
    known = seen.where(F.col(user).isNotNull() & F.col("day").isNotNull())
    after = F.lead("day").over(Window.partitionBy(key, user).orderBy("day"))
    spans = known.select(key, "day", F.least(F.date_add("day", days), after).alias("_end"))
    steps = F.array(F.struct(F.col("day"), F.lit(1).alias("_step")), F.struct(F.col("_end").alias("day"), F.lit(-1).alias("_step")))
    daily = spans.select(key, F.explode(steps).alias("_s")).select(key, "_s.*").groupBy(key, "day").agg(F.sum("_step").alias("_step"))
    return daily.select(key, "day", F.sum("_step").over(Window.partitionBy(key).orderBy("day")).alias(out))
