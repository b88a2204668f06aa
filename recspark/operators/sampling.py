"""Rare-value folding, negative sampling and repeatable splits.

Everything is keyed on hashes of the data, so results do not depend on the
partitioning or on task retries (an executor lost mid-job recomputes the same
rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.functions.hashing import hex_prefix_bucket
from recspark.llm.common import join_small
from recspark.session import store_rows


def fold_rare(df: DataFrame, cols: list[str], min_count: int, token: str = "__rare__") -> DataFrame:
    """Values seen fewer than ``min_count`` times become ``token``.

    Counts are a grouped aggregate per column; the frequent-value table is
    joined back (broadcast by AQE when it is small).
    """
    out = df
    for c in cols:
        keep = (df.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_count)
                .select(F.col(c).alias("_v"), F.lit(True).alias("_keep")))
        out = (out.join(keep, out[c].eqNullSafe(keep["_v"]), "left")
               .withColumn(c, F.when(F.col("_keep") | F.col(c).isNull(), F.col(c).cast("string"))
                           .otherwise(F.lit(token)))
               .drop("_v", "_keep"))
    return out


def distinct_draws(key: Column, size: Column, n: Column) -> Column:
    """``n`` distinct numbers of ``[0, size)`` in the random order of ``key`` (``n <= size``): a keyed partial shuffle.

    Draw ``j`` is uniform among the ``size - j + 1`` numbers not yet drawn: a
    hash of key and ``j``, moved up past every earlier draw at or below it.  All
    ordered tuples are equally likely, whatever the size; the cost is ``n``
    squared a key, with no table of ``size`` rows.
    """
    def nth(drawn: Column, j: Column) -> Column:
        h = F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), j.cast("string"))), 1, 15), 16, 10).cast("long")
        place = F.pmod(h, size - j + 1)
        return F.aggregate(F.array_sort(drawn), place, lambda x, seen: F.when(x >= seen, x + 1).otherwise(x))

    steps = F.when(n > 0, F.sequence(F.lit(1).cast("long"), n.cast("long"))).otherwise(F.array().cast("array<long>"))
    return F.aggregate(steps, F.array().cast("array<long>"), lambda drawn, j: F.concat(drawn, F.array(nth(drawn, j))))


_SLICES = 256
HEAVY_ROWS = 1_000_000


def _user_keys(df: DataFrame, user: str) -> DataFrame:
    """Add the columns ``_key`` and ``_none``: the user without null, and whether it is null.

    Windows, sums and joins on these two are dealt alike, so one shuffle serves them.
    """
    kind = df.schema[user].dataType
    if isinstance(kind, T.NumericType):
        return df.withColumns({"_key": F.coalesce(user, F.lit(0).cast(kind)), "_none": F.col(user).isNull()})
    return df.withColumns({"_key": F.coalesce(F.col(user).cast("string"), F.lit("")), "_none": F.col(user).isNull()})


_USER = ["_key", "_none"]


def _before(df: DataFrame, value: str, count: Column, out: str, ties: list[str], heavy: bool) -> DataFrame:
    """Add the sum of ``count`` over the user's rows before each row in the order of ``value`` and ``ties``.

    The order of a user with very many rows is cut into slices (``_slice``, -1
    for all others), so a window never holds more than one slice; with ``heavy``
    the sums of their earlier slices come from a table of at most ``_SLICES``
    rows for each such user.
    """
    inside = Window.partitionBy(*_USER, "_slice").orderBy(value, *ties).rowsBetween(Window.unboundedPreceding, -1)
    got = df.withColumn(out, F.coalesce(F.sum(count).over(inside), F.lit(0)))
    if not heavy:
        return got
    sums = df.where(F.col("_slice") >= 0).groupBy(*_USER, "_slice").agg(F.sum(count).alias("_sum"))
    earlier = Window.partitionBy(*_USER).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*_USER, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_off"))
    return (join_small(got, sums, [*_USER, "_slice"], "left")
            .withColumn(out, F.col(out) + F.coalesce("_off", F.lit(0))).drop("_off"))


def negative_samples(pos: DataFrame, items: DataFrame, n: int = 2, seed: int = 7, user: str = "user_id",
                     item: str = "item_id", draws: str = "strides") -> DataFrame:
    """Pair every positive ``(user, item)`` with ``n`` distinct items the user has none of.

    Items are numbered densely.  A user with ``c`` known items has ``m = N - c``
    others; a positive's start among those is an md5 hash of ``(user, item,
    seed)`` modulo ``m``, and its further draws follow at equal strides, so they
    differ.  With ``draws="independent"`` a positive's draws are a keyed partial
    shuffle of its own (``distinct_draws``) instead: none follows from another.  The ``r``-th other item is the item numbered ``r`` plus the known
    items at or below it, which one merge of draws and known items counts.  Only
    a user who has all but fewer than ``n`` items gets fewer (all there are).
    Positives and known items are each stored once (Parquet), as they are read several times, and the merge
    too if a user has more than ``HEAVY_ROWS`` positives.
    Output ``(user, item, label)`` with the positives (label 1) included.
    """
    from recspark.operators.ranking import dense_codes
    catalogue = items.select(F.col(item).alias("_neg")).where(F.col("_neg").isNotNull()).distinct()
    cat = dense_codes(catalogue, [], [F.col("_neg")], out="_slot")
    n_items = cat.agg(F.count(F.lit(1))).scalar()

    pos = store_rows(pos.select(user, item))
    many = _user_keys(pos, user).groupBy(*_USER).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > HEAVY_ROWS)
    many = store_rows(many.select(*_USER, F.lit(True).alias("_heavy")))
    heavy = not many.isEmpty()

    def sliced(df: DataFrame, at: str) -> DataFrame:
        if not heavy:
            return df.withColumn("_slice", F.lit(-1))
        own = F.when(F.col("_heavy"), F.floor(F.col(at) * _SLICES / n_items)).otherwise(-1).cast("int")
        return join_small(df, many, _USER, "left").withColumn("_slice", own).drop("_heavy")

    base = store_rows(_user_keys(pos.select(user, F.col(item).alias("_neg")).distinct().join(cat, "_neg").select(
        user, "_slot"), user))
    known = _before(sliced(base, "_slot"), "_slot", F.lit(1), "_i", [], heavy)
    known = known.select(user, *_USER, (F.col("_slot") - F.col("_i")).alias("_r"), F.lit(0).alias("_draw"))
    free = base.groupBy(*_USER).agg((n_items - F.count(F.lit(1))).alias("_m"))
    key = F.concat_ws("|", F.col(user).cast("string"), F.col(item).cast("string"), F.lit(str(seed)))
    first60 = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")  # 15 hex digits: always >= 0
    if draws not in ("strides", "independent"):
        raise ValueError("draws must be 'strides' or 'independent'")
    drawn = (_user_keys(pos, user).join(free, _USER, "left")
             .withColumn("_m", F.coalesce("_m", n_items)).where(F.col("_m") > 0)
             .withColumn("_n", F.least(F.lit(n).cast("long"), F.col("_m"))))
    if draws == "strides":
        drawn = drawn.withColumn("_draw", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).withColumn(
            "_r", (F.pmod(first60, "_m") + (F.col("_draw") - 1) * F.floor(F.col("_m") / F.col("_n"))) % F.col("_m"))
    else:
        drawn = drawn.select("*", F.posexplode(distinct_draws(key, F.col("_m"), F.col("_n"))).alias("_at", "_r")).withColumn(
            "_draw", F.col("_at") + 1)
    both = sliced(known.unionByName(drawn.select(user, *_USER, "_r", F.col("_draw").cast("int"))), "_r")
    both = _before(store_rows(both) if heavy else both, "_r", (F.col("_draw") == 0).cast("long"), "_known", ["_draw"], heavy)
    negs = (both.where(F.col("_draw") > 0).withColumn("_slot", F.col("_r") + F.col("_known"))
            .join(cat, "_slot").select(user, F.col("_neg").alias(item), F.lit(0).alias("label")))
    return pos.select(user, item, F.lit(1).alias("label")).unionByName(negs)


def split_by_hash(df: DataFrame, key_cols: list[str], fractions: dict[str, float], seed: int = 0,
                  out: str = "split") -> DataFrame:
    """Repeatable train/val/test labels from an md5 bucket of the key."""
    total = sum(fractions.values())
    bucket = hex_prefix_bucket(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])),
                               1_000_000) / 1_000_000.0
    expr, acc = None, 0.0
    for name, frac in fractions.items():
        acc += frac / total
        cond = bucket < F.lit(acc)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(out, expr.otherwise(F.lit(list(fractions)[-1])))


def split_by_time(df: DataFrame, ts: str, cuts: list, names: list[str], out: str = "split") -> DataFrame:
    """E20 (time cut): ``names[i]`` for ``ts < cuts[i]``, the last name after."""
    expr = None
    for cut, name in zip(cuts, names):
        cond = F.col(ts) < F.lit(cut).cast("timestamp")
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(out, expr.otherwise(F.lit(names[-1])))
