"""Behaviour history before each event.

For every row: the ``max_len`` most recent non-null items of the same user
(rows without a user share one history) strictly before it (order ``ts`` then a unique tie-break), oldest first, optionally
right-padded to ``max_len``.

A plain ``collect_list`` over ``partitionBy(user)`` would put a hot user -
possibly a third of the log - into one window task.  Here the window is
partitioned by ``(user, bucket)`` instead; what a bucket needs from earlier
buckets is only their last ``max_len`` items, gathered per bucket
(``<= max_len`` rows each) and passed forward with a second window over the
one-row-per-bucket table, whose frame covers the previous ``max_len`` buckets
that hold an item.

Buckets: ``bucket="range"`` (default) uses the range partitions of
``(user, ts, tie)`` - sized by Spark's sampling, so every bucket is bounded
whatever the skew; the partition ids are fixed by a reliable checkpoint.  A
time unit (``"day"``, ``"hour"``, ...) buckets by ``date_trunc`` instead (no
extra job, but one user-day stays one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.scalars import padding


def _last(arr: Column, n: int) -> Column:
    return F.slice(arr, F.greatest(F.size(arr) - F.lit(n) + 1, F.lit(1)), n)


def build_history(df: DataFrame, user: str, item: str, ts: str, tie: list[str], max_len: int,
                  bucket: str = "range", pad_value=None, out: str = "history",
                  partitions: int | None = None) -> DataFrame:
    """Add ``out`` (array, oldest first), ``out_len`` and, with ``pad_value``, ``out_padded``."""
    order = [F.col(ts), *[F.col(t) for t in tie]]
    if bucket == "range":
        from recspark.session import cut_lineage
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        e = cut_lineage(df.repartitionByRange(n, F.col(user), *order).withColumn("_b", F.spark_partition_id()))
    else:
        e = df.withColumn("_b", F.date_trunc(bucket, F.col(ts)))
    # frames count items, not rows: a null item is no part of a history and takes no place in it
    seen = Window.partitionBy(user, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("_k", F.count(item).over(seen))
    e = e.withColumn("_within", F.collect_list(item).over(
        Window.partitionBy(user, "_b").orderBy("_k").rangeBetween(-max_len, -1)))
    newest = Window.partitionBy(user, "_b").orderBy(F.col(item).isNull(), *[o.desc() for o in order])
    tails = (e.select(user, "_b", ts, *tie, item).withColumn("_rd", F.row_number().over(newest))
             .where(F.col("_rd") <= max_len).groupBy(user, "_b")
             .agg(F.array_sort(F.collect_list(F.when(F.col(item).isNotNull(), F.struct(ts, *tie, item)))).alias("_t")))
    tails = tails.select(user, "_b", F.when(F.size("_t") > 0, F.transform("_t", lambda s: s[item])).alias("_tail"))
    earlier = Window.partitionBy(user).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (tails.withColumn("_k", F.count("_tail").over(earlier))
             .withColumn("_prev", F.collect_list("_tail").over(
                 Window.partitionBy(user).orderBy("_k").rangeBetween(-max_len, -1)))
             .select(F.col(user).alias("_u"), F.col("_b").alias("_cb"), _last(F.flatten("_prev"), max_len).alias("_carry")))
    res = (e.join(carry, e[user].eqNullSafe(F.col("_u")) & e["_b"].eqNullSafe(F.col("_cb")))
           .withColumn(out, _last(F.concat("_carry", "_within"), max_len)))
    res = res.withColumn(f"{out}_len", F.size(out)).drop("_b", "_k", "_within", "_carry", "_u", "_cb")
    if pad_value is not None:
        res = res.withColumn(f"{out}_padded", padding(out, max_len, pad_value))
    return res
