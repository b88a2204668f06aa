"""Evaluation metrics (N1-N6, N8) as aggregates.

AUC is the rank-sum statistic with tied scores sharing their average rank
(equal to ``roc_auc_score``); a set with one class only scores 0.0.

    AUC = sum_s pos(s) * (neg_below(s) + neg(s) / 2) / (P * N)

The rows are first collapsed to one row per distinct ``(group, score)``.
``neg_below`` is an exact prefix sum computed without a window over a whole
group: scores are cut into ``buckets`` ranges by approximate per-group
quantiles; each bucket gets the sum of all earlier buckets from a table of at
most ``buckets`` rows per group, and adds its own running sum.  A hot group
(or the global AUC, which is one group) is therefore spread over ``buckets``
window partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.scalars import softmax


def _label(y) -> Column:
    c = F.col(y) if isinstance(y, str) else y
    return (c.cast("double") == 1.0).cast("long")


def auc_table(df: DataFrame, label: str, score: str, group: list[str] | None = None,
              buckets: int = 64, ties: str = "average", order: str | None = None) -> DataFrame:
    """Per-group ``(n, pos, neg, auc)``; ``group=None`` gives one global row.

    W3 (ranks for the rank sum) is realised as the bucketed prefix count of
    negatives below each distinct score.  ``ties="average"`` counts tied
    negatives half (``roc_auc_score``); ``ties="order"`` ranks tied scores by
    the ``order`` column, like a stable sort of the input (L18).
    """
    if ties not in ("average", "order"):
        raise ValueError("ties must be 'average' or 'order'")
    if ties == "order" and order is None:
        raise ValueError("ties='order' needs an explicit order column")
    keys = list(group or [])
    extra = [F.col(order).alias("_o")] if ties == "order" else []
    base = df.select(*[F.col(k) for k in keys], _label(label).alias("_y"), F.col(score).cast("double").alias("_s"),
                     *extra)
    if not keys:
        base = base.withColumn("_g", F.lit(0))
        keys = ["_g"]
    if ties == "order":  # every row is its own rank: no collapsing, no half counts
        g = base.select(*keys, "_s", "_o", F.col("_y").alias("_pos"), (1 - F.col("_y")).alias("_neg"))
    else:
        g = base.groupBy(*keys, "_s").agg(F.sum("_y").alias("_pos"), F.sum(1 - F.col("_y")).alias("_neg"))
    probs = [i / buckets for i in range(1, buckets)]
    edges = g.groupBy(*keys).agg(F.percentile_approx("_s", probs, 10000).alias("_edges"))
    gb = (g.join(edges, keys)
          .withColumn("_b", F.size(F.filter("_edges", lambda e: e < F.col("_s"))))
          .drop("_edges"))
    bt = gb.groupBy(*keys, "_b").agg(F.sum("_neg").alias("_bneg"))
    off = bt.withColumn("_off", F.coalesce(F.sum("_bneg").over(
        Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within_order = ["_s", "_o"] if ties == "order" else ["_s"]
    within = F.coalesce(F.sum("_neg").over(
        Window.partitionBy(*keys, "_b").orderBy(*within_order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = gb.withColumn("_within", within).join(off.select(*keys, "_b", "_off"), [*keys, "_b"])
    half = F.lit(0.0) if ties == "order" else F.col("_neg") / 2.0
    contrib = F.col("_pos") * (F.col("_off") + F.col("_within") + half)
    per = ranked.groupBy(*keys).agg(F.sum(F.col("_pos") + F.col("_neg")).alias("n"),
                                    F.sum("_pos").alias("pos"), F.sum("_neg").alias("neg"),
                                    F.sum(contrib).alias("_u"))
    auc = F.when((F.col("pos") > 0) & (F.col("neg") > 0),
                 F.col("_u") / (F.col("pos").cast("double") * F.col("neg").cast("double"))).otherwise(F.lit(0.0))
    out = per.select(*keys, "n", "pos", "neg", auc.alias("auc"))
    return out.drop("_g") if group is None or not group else out


def auc(df: DataFrame, label: str, score: str, buckets: int = 64, ties: str = "average",
        order: str | None = None) -> DataFrame:
    """One row ``(n, pos, neg, auc)``."""
    return auc_table(df, label, score, None, buckets, ties, order)


def gauc(df: DataFrame, label: str, score: str, group: str | list[str], buckets: int = 16) -> DataFrame:
    """One row with three normalisations of group AUC.

    * ``gauc_reference`` - ``sum(auc_g * n_g) / groups / rows`` (L19, reference)
    * ``gauc_weighted`` - ``sum(auc_g * n_g) / sum(n_g)``, one-class groups count as 0
    * ``gauc_standard`` - the same over groups holding both classes only
    """
    keys = [group] if isinstance(group, str) else list(group)
    t = auc_table(df, label, score, keys, buckets)
    both = (F.col("pos") > 0) & (F.col("neg") > 0)
    return t.agg(
        (F.sum(F.col("auc") * F.col("n")) / F.count(F.lit(1)) / F.sum("n")).alias("gauc_reference"),
        (F.sum(F.col("auc") * F.col("n")) / F.sum("n")).alias("gauc_weighted"),
        (F.sum(F.when(both, F.col("auc") * F.col("n"))) / F.sum(F.when(both, F.col("n")))).alias("gauc_standard"),
        F.count(F.lit(1)).alias("groups"), F.sum(F.when(both, 1).otherwise(0)).alias("groups_both_classes"))


def accuracy_expr(label, pred, threshold: float = 0.5) -> Column:
    """N3 (aggregate): mean of ``(p > threshold) == y``."""
    return F.avg(((F.col(pred) > threshold).cast("long") == _label(label)).cast("double"))


def logloss_expr(label, pred, eps: float = 1e-15) -> Column:
    """N4 (aggregate): mean binary cross-entropy, ``p`` clipped to ``[eps, 1-eps]``."""
    p = F.least(F.greatest(F.col(pred).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = _label(label)
    return F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p)))


def classification_metrics(df: DataFrame, label: str, pred: str, threshold: float = 0.5) -> DataFrame:
    """N3 + N4 (+ N1) in one row."""
    basic = df.agg(accuracy_expr(label, pred, threshold).alias("accuracy"),
                   logloss_expr(label, pred).alias("logloss"), F.count(F.lit(1)).alias("rows"))
    one = auc(df, label, pred).select("auc")
    # two one-row results side by side: equi-join on a constant key (no cartesian operator)
    return basic.withColumn("_k", F.lit(0)).join(F.broadcast(one.withColumn("_k", F.lit(0))), "_k").drop("_k")


def multi_task_metrics(df: DataFrame, tasks: dict[str, tuple[str, str]], buckets: int = 64) -> DataFrame:
    """One row per task (sorted by name): ``task, rows, auc, accuracy, logloss``.

    ``tasks`` maps a task name to ``(label_col, pred_col)``.  The table is
    unpivoted once so all tasks are evaluated by the same grouped job.
    """
    names = sorted(tasks)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("task"), F.col(tasks[t][0]).cast("double").alias("y"),
                 F.col(tasks[t][1]).cast("double").alias("p")) for t in names])).alias("_t")).select("_t.*")
    a = auc_table(long, "y", "p", ["task"], buckets).select("task", "auc")
    m = long.groupBy("task").agg(F.count(F.lit(1)).alias("rows"), accuracy_expr("y", "p").alias("accuracy"),
                                 logloss_expr("y", "p").alias("logloss"))
    return m.join(a, "task").orderBy("task")


def rela_impr(auc_model: Column, auc_base: Column) -> Column:
    """``(AUC_model - 0.5) / (AUC_base - 0.5) - 1``."""
    return (auc_model - 0.5) / (auc_base - 0.5) - 1


def rela_impr_table(df: DataFrame, label: str, model_score: str, base_score: str, buckets: int = 64) -> DataFrame:
    """N8 in one grouped job: both AUCs from one ``auc_table`` over the stacked
    ``(which, y, score)`` rows, then ``auc_model, auc_base, rela_impr``."""
    long = df.select(F.explode(F.array(
        F.struct(F.lit("model").alias("which"), F.col(label).alias("y"), F.col(model_score).cast("double").alias("s")),
        F.struct(F.lit("base").alias("which"), F.col(label).alias("y"), F.col(base_score).cast("double").alias("s"))))
        .alias("_t")).select("_t.*")
    t = auc_table(long, "y", "s", ["which"], buckets)
    row = t.agg(F.max(F.when(F.col("which") == "model", F.col("auc"))).alias("auc_model"),
                F.max(F.when(F.col("which") == "base", F.col("auc"))).alias("auc_base"))
    return row.withColumn("rela_impr", rela_impr(F.col("auc_model"), F.col("auc_base")))


def matryoshka_cross_entropy(df: DataFrame, logits_cols: dict[int, str], label: str,
                             weights: dict[int, float] | None = None) -> DataFrame:
    """Weighted sum over prefix dims of the mean softmax cross-entropy.

    ``logits_cols`` maps a dim to an ``array<double>`` column of class logits;
    ``label`` is the 0-based class index.
    """
    dims = sorted(logits_cols)
    w = weights or {d: 1.0 for d in dims}
    ce = {d: F.avg(-F.log(F.element_at(softmax(logits_cols[d]), F.col(label).cast("int") + 1))) for d in dims}
    row = df.agg(*[ce[d].alias(f"ce_{d}") for d in dims])
    return row.withColumn("loss", sum((F.col(f"ce_{d}") * F.lit(float(w[d])) for d in dims), F.lit(0.0)))
