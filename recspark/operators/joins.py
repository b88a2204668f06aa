"""Join helpers.

Broadcast rule used everywhere in the package: a side is hinted for broadcast
only if it is bounded by construction (a codebook of ``K`` rows, a one-row
statistic).  Everything else is left to Catalyst/AQE, which turns a sort-merge
join into a broadcast join at run time only when the measured bytes are under
``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.session import store_rows


def join_with_suffixes(left: DataFrame, right: DataFrame, on: list[str] | str, how: str = "inner",
                       suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Pandas-style merge - clashing non-key columns get ``_x`` / ``_y``."""
    keys = [on] if isinstance(on, str) else list(on)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    lren = left.withColumnsRenamed({c: c + suffixes[0] for c in clash}) if clash else left
    rren = right.withColumnsRenamed({c: c + suffixes[1] for c in clash}) if clash else right
    return lren.join(rren, keys, how)


def combo_merge(base: DataFrame, extra: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """Merge a side table on one or several keys (``how`` inner/left)."""
    if how not in ("inner", "left", "left_outer", "right", "outer", "full"):
        raise ValueError(f"unsupported join type {how!r}")
    return base.join(extra, [on] if isinstance(on, str) else list(on), how)


def vocab_lookup(df: DataFrame, col: str, vocab: DataFrame, out: str, default: int | None = 0,
                 value_col: str = "value", code_col: str = "code") -> DataFrame:
    """``value -> code`` through a vocab table; unseen/null get ``default``.

    The vocabulary grows with the data (one row per distinct value), so the
    join carries no hint: AQE broadcasts it when its measured size is small.
    """
    v = vocab.select(F.col(value_col).alias("__v"), F.col(code_col).alias("__code"))
    joined = df.join(v, F.col(col).cast(v.schema["__v"].dataType) == F.col("__v"), "left")
    code = F.col("__code") if default is None else F.coalesce(F.col("__code"), F.lit(default))
    return joined.withColumn(out, code.cast("long")).drop("__v", "__code")


def embedding_lookup(df: DataFrame, key: str, ids_col: str, table: DataFrame, out: str,
                     pool: str = "sum", id_col: str = "idx", vec_col: str = "vec") -> DataFrame:
    """J8 + A13: look up a vector per id of an ``array<long>`` column and pool it.

    Rows whose list is empty or has no match get ``null``.  ``key`` must be
    unique.  ``df`` is stored once (Parquet), as its lists are read three times.

    The rows of the table that any list names are looked at first.  Up to
    ``HELD_ROWS`` rows and ``HELD_CELLS`` elements go to every task: the ids
    alone are shuffled, gathered by key and joined to ``df``, and each list is
    pooled behind that join, so no vector of a lookup is shuffled.  More are
    joined to the exploded ids, and whole vectors summed per key, combined
    before the shuffle; a hot id's rows are dealt over ``SALTS`` copies of its
    vector, so no id is one task; ids are hot that hold more than ``1 / SALTS``
    of a seeded sample of the lookups.

    The join with ``df`` is never a broadcast: its size is guessed from packed
    files and grows with ``df``, and AQE keeps a broadcast that was guessed too
    small, as any other join has more shuffles.
    """
    if pool not in ("sum", "mean"):
        raise ValueError("pool must be 'sum' or 'mean'")
    from recspark.operators.vectors import sum_vectors
    df = store_rows(df)
    ids = df.select(key, F.explode(ids_col).alias("_id")).where(F.col("_id").isNotNull())
    t = table.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec"))
    held = held_rows(ids.select("_id"), t)
    if held is None:
        pooled = sum_vectors(dealt_join(ids, t, "_id"), [key], "_vec", out, pool)
        return df.join(pooled.hint("merge"), key, "left")
    lists = ids.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.col("_id").cast("long")).alias("_ids"))
    both = df.join(lists.hint("merge"), key, "left")
    return both.select(*[both[c] for c in df.columns], _pooled(df.sparkSession, held, pool)("_ids").alias(out))


HELD_ROWS = 20_000
HELD_CELLS = 2_000_000
_STEP = 1 << 15


def held_rows(ids: DataFrame, table: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """The rows ``(id, vector)`` of ``table`` that ``ids`` names, sorted by id, if there are few enough for every task.

    ``None`` if there are more than ``HELD_ROWS`` or ``HELD_CELLS`` elements,
    if the ids aren't whole numbers, or if the vectors differ in length.
    """
    name, vec = table.columns
    kinds = {ids.schema[0].dataType.typeName(), table.schema[0].dataType.typeName()}
    if not kinds <= {"byte", "short", "integer", "long"}:
        return None
    wanted = store_rows(ids.distinct())
    rows = table.where(F.col(vec).isNotNull()).join(wanted.toDF(name), name, "left_semi")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(vec)).alias("least"), F.max(F.size(vec)).alias("most")).first()
    if size["n"] > HELD_ROWS or size["least"] != size["most"] or size["n"] * size["most"] > HELD_CELLS:
        return (np.zeros(0, np.int64), np.zeros((0, 0))) if not size["n"] else None
    from pyspark.ml.functions import array_to_vector, vector_to_array
    plain = vector_to_array(array_to_vector(F.col(vec).cast("array<double>")))
    found = rows.select(F.col(name).cast("long"), plain.alias(vec)).toArrow()
    at = found[name].to_numpy()
    matrix = found[vec].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(at), size["most"])
    order = np.argsort(at, kind="stable")
    return at[order], np.ascontiguousarray(matrix[order])


def list_sums(lists, ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each list of ids: the sum of the rows that it names, their number, and the sum of their squared norms.

    A null list is as an empty one.
    """
    size = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lists)), size)
    sums, many, squares = np.zeros((len(lists), matrix.shape[1])), np.zeros(len(lists), np.int64), np.zeros(len(lists))
    norms = (matrix * matrix).sum(1)
    for at in range(0, len(flat), _STEP):  # a long list is taken in steps
        part, mine = flat[at:at + _STEP], owner[at:at + _STEP]
        lo, hi = np.searchsorted(ids, part), np.searchsorted(ids, part, side="right")
        n = hi - lo  # an id may have no row or several
        rows = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        mine = np.repeat(mine, n)
        for b in range(0, len(rows), _STEP):
            r, o = rows[b:b + _STEP], mine[b:b + _STEP]
            first = np.flatnonzero(np.diff(o, prepend=-1))
            sums[o[first]] += np.add.reduceat(matrix[r], first)
        many += np.bincount(mine, minlength=len(lists))
        squares += np.bincount(mine, norms[rows], len(lists))
    return sums, many, squares


def _pooled(spark: SparkSession, held: tuple[np.ndarray, np.ndarray], pool: str):
    """UDF of a list of ids: sum or mean of the held rows; null if it names none."""
    shared = spark.sparkContext.broadcast(held)  # bounded by HELD_ROWS and HELD_CELLS

    def run(lists: pa.Array) -> pa.Array:
        sums, many, _ = list_sums(lists, *shared.value)
        some = many > 0
        found = sums[some] / (many[some][:, None] if pool == "mean" else 1)
        ends = np.concatenate([[0], np.cumsum(some * sums.shape[1])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel(), pa.float64()), mask=pa.array(~some))

    return F.arrow_udf(run, "array<double>").asNondeterministic()  # not to be worked out again for a filter


SALTS = 16


def dealt_join(df: DataFrame, table: DataFrame, key: str, sample: float = 0.01) -> DataFrame:
    """Inner join of ``df`` with one row per key, the rows of hot keys dealt over ``SALTS`` copies.

    Hot keys are those above ``1 / SALTS`` of a sample (at most ``2 * SALTS`` of
    them), so their list is bounded; which keys are hot changes no result.
    """
    counts = df.select(F.col(key).alias("_k")).sample(sample, 7).groupBy("_k").count()
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"))
    hot = counts.where(F.col("count") * SALTS > F.greatest(total.scalar(), F.lit(64 * SALTS)))
    hot = [r["_k"] for r in hot.orderBy(F.desc("count")).limit(2 * SALTS).collect()]
    if not hot:
        return df.join(table, key)
    is_hot = F.col(key).isin(hot)
    left = df.withColumn("_salt", F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0).cast("long"))
    copies = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return left.join(table.withColumn("_salt", F.explode(copies)), [key, "_salt"]).drop("_salt")
