"""Factorisation-machine tables and model application.

``fm_score`` evaluates ``w0 + sum_f w[i_f] + 0.5 * sum_d ((sum_f v_fd)^2 -
sum_f v_fd^2)`` from weight tables ``(idx, w)`` and ``(idx, vec)`` in long
form.  The table rows that the samples name go to every task while they are few,
and Arrow batches of index lists are summed there; else one row per (sample,
field) is joined to the tables, whole vectors summed by a typed aggregate that
combines before the shuffle - no row per dimension.  Field indexes are shifted by per-field offsets so the
fields share one table (``unify_embedding``).
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm.common import join_small
from recspark.operators.joins import dealt_join, held_rows, list_sums


def field_offsets(vocab_sizes: list[int]) -> list[int]:
    return [0] + list(accumulate(vocab_sizes))[:-1]


def fm_second_order_long(df: DataFrame, key: str, vec: str) -> DataFrame:
    """M6 (long form): rows ``(key, vec)`` one per field -> ``(key, fm2)``.

    Sums and sums of squares come from one typed aggregate over whole vectors,
    each followed by its squares.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    x = F.col(vec).cast("array<double>")
    rows = df.where(F.col(vec).isNotNull()).select(
        key, array_to_vector(F.concat(x, F.transform(x, lambda v: v * v))).alias("_v"))
    both = rows.groupBy(key).agg(vector_to_array(Summarizer.sum(F.col("_v"))).alias("_m"))
    dim = (F.size("_m") / 2).cast("int")
    terms = F.zip_with(F.slice("_m", 1, dim), F.slice("_m", dim + 1, dim), lambda s, q: s * s - q)
    return both.select(key, (F.lit(0.5) * F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)).alias("fm2"))


def fm_score(samples: DataFrame, key: str, idx_col: str, w0: float, w: DataFrame, v: DataFrame,
             offsets: list[int] | None = None) -> DataFrame:
    """M7: ``(key, linear, fm2, logit)`` for samples with ``idx_col array<long>``.

    If the table rows that any sample names are few (``held_rows``), they go to
    every task and only the indexes are shuffled, gathered by key; else the
    exploded indexes are joined to the tables and whole vectors summed by key.
    """
    idx = F.col(idx_col)
    if offsets is not None:
        off = F.array(*[F.lit(o).cast("long") for o in offsets])
        idx = F.transform(idx, lambda i, f: i + F.element_at(off, f + 1))
    moved = samples.select(key, idx.alias("_is"))
    ex = moved.select(key, F.explode("_is").alias("_i"))
    wt = w.select(F.col("idx").alias("_i"), F.col("w").cast("double").alias("_w"))
    vt = v.select(F.col("idx").alias("_i"), F.col("vec").alias("_vec"))
    held_v = held_rows(ex.select("_i").where(F.col("_i").isNotNull()), vt)
    if held_v is None:
        linear = ex.join(wt, "_i", "left").groupBy(key).agg(F.sum(F.coalesce("_w", F.lit(0.0))).alias("linear"))
        fm2 = fm_second_order_long(dealt_join(ex.select(key, "_i"), vt, "_i").select(key, F.col("_vec").alias("vec")), key, "vec")
    else:
        wanted = ex.select("_i").distinct()
        named = wt.join(wanted, "_i", "left_semi")
        linear = (join_small(ex, named, ["_i"], "left").groupBy(key)
                  .agg(F.sum(F.coalesce("_w", F.lit(0.0))).alias("linear")))
        lists = moved.where(F.col(key).isNotNull()).groupBy(key).agg(F.flatten(F.collect_list("_is")).alias("_is"))
        lists = lists.select(key, F.filter("_is", lambda i: i.isNotNull()).cast("array<long>").alias("_is"))
        fm2 = lists.select(key, _second_order(samples.sparkSession, held_v)("_is").alias("fm2"))
    return (linear.join(fm2, key, "left").withColumn("fm2", F.coalesce("fm2", F.lit(0.0)))
            .withColumn("logit", F.lit(float(w0)) + F.col("linear") + F.col("fm2")))


def _second_order(spark: SparkSession, held: tuple[np.ndarray, np.ndarray]):
    """UDF of a list of indexes: the second-order term over the held rows."""
    shared = spark.sparkContext.broadcast(held)

    @F.arrow_udf("double")
    def run(lists: pa.Array) -> pa.Array:
        sums, _, squares = list_sums(lists, *shared.value)
        return pa.array(0.5 * ((sums * sums).sum(1) - squares))

    return run


def hashed_features(df: DataFrame, cols: list[str], num_features: int, out: str = "features") -> DataFrame:
    """Sparse one-hot features of ``col=value`` tokens (MLlib ``FeatureHasher``)."""
    from pyspark.ml.feature import FeatureHasher
    return FeatureHasher(inputCols=cols, outputCol=out, numFeatures=num_features,
                         categoricalCols=cols).transform(df.select(*cols, *[c for c in df.columns if c not in cols]))


def fm_fit(df: DataFrame, label: str, cols: list[str], num_features: int = 1 << 12, factor_size: int = 4,
           max_iter: int = 20, seed: int = 7):
    """M8: train an FM classifier on hashed categorical features (MLlib ``FMClassifier``)."""
    from pyspark.ml.classification import FMClassifier
    data = hashed_features(df, cols, num_features).withColumn("label", F.col(label).cast("double"))
    return FMClassifier(featuresCol="features", labelCol="label", factorSize=factor_size, maxIter=max_iter,
                        seed=seed, stepSize=0.1).fit(data)


def wide_fit(df: DataFrame, label: str, cols: list[str], crosses: list[list[str]], num_features: int = 1 << 14,
             max_iter: int = 20):
    """M9: the linear ("wide") part - logistic regression on raw and crossed categorical features."""
    from pyspark.ml.classification import LogisticRegression

    from recspark.functions.scalars import cross_string
    names = ["_".join(c) + "_cross" for c in crosses]
    d = df.withColumns({n: cross_string(c) for n, c in zip(names, crosses)})
    data = hashed_features(d, cols + names, num_features).withColumn("label", F.col(label).cast("double"))
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter).fit(data)


def score_batches(df: DataFrame, make_predict, input_cols: list[str], out: str = "prediction",
                  batch_size: int = 4096) -> DataFrame:
    """Apply a user model through Arrow batches (``predict_batch_udf``).

    ``make_predict()`` is called once per Python worker and returns a function
    from a numpy matrix (one column per input) to a numpy array of scores.
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql import types as T
    udf = predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch_size,
                            input_tensor_shapes=[[len(input_cols)]])
    return df.withColumn(out, udf(F.array(*[F.col(c).cast("double") for c in input_cols])))
