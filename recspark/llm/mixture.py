"""Operator 8: mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree of levels (domain, language, source).  A token budget
flows from the root: siblings share their parent's budget by weight
(``tokens ** alpha``, or a given target), none beyond its capacity
(``max_epochs`` times its tokens).  What a node cannot take goes to its
siblings, in proportion to their weights; only what a whole family cannot take
reaches the family's own siblings.  A leaf takes whole epochs of its documents
and, of one more epoch, the prefix of a seeded order that fits the rest.

Only DataFrame functions are used.  Budgets are window sums over the node
table.  The prefix is found in 4096 slices of the order for each leaf, so a
hot leaf is numbered in 4096 pieces; documents themselves are not shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.common import join_small, stored, words

LEVELS = ("domain", "lang", "source")


def _budgets(leaves: DataFrame, levels: Sequence[str], total: float, alpha: float, max_epochs: int,
             targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Leaves with ``__budget``: one level after the other, children below their parents."""
    above = leaves.agg(F.least(F.sum("__tokens") * max_epochs, F.lit(total)).cast("double").alias("__above"))
    for k, level in enumerate(levels):
        path = list(levels[:k])
        weight = F.pow(F.col("__tokens").cast("double"), F.lit(alpha))
        for name, w in targets.get(level, {}).items():
            weight = F.when(F.col(level) == name, F.lit(float(w))).otherwise(weight)
        nodes = leaves.groupBy(*levels[:k + 1]).agg(F.sum("__tokens").alias("__tokens")).filter("__tokens > 0")
        nodes = nodes.withColumns({"__cap": (F.col("__tokens") * max_epochs).cast("double"), "__weight": weight})
        if path:
            nodes = nodes.join(above, path)
        else:
            nodes = nodes.withColumn("__above", F.lit(above.first()[0]).cast("double"))
        # in the order of capacity by weight, the water level is the largest one reached
        w = Window.partitionBy(*path).orderBy(F.col("__cap") / F.col("__weight"), level)
        full = F.coalesce(F.sum("__cap").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        left = F.sum("__weight").over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        nodes = nodes.withColumn("__level", (F.col("__above") - full) / left)
        nodes = nodes.withColumn("__budget", F.least("__cap", F.col("__weight")
                                                     * F.max("__level").over(Window.partitionBy(*path))))
        above = nodes.select(*levels[:k + 1], F.col("__budget").alias("__above"))
    return leaves.join(above.withColumnRenamed("__above", "__budget"), list(levels), "left")


def _order(seed: int, epoch: Column, id_col: str) -> Column:
    """Place of a document in an epoch: the md5 of seed, epoch and id, as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
                 .cast("binary"))


def _keyed(docs: DataFrame, levels: Sequence[str], id_col: str, text_col: str) -> DataFrame:
    """Documents with their leaf, words and tie-break columns; a null on the path counts as an empty name."""
    return docs.withColumns({**{f"__l_{x}": F.coalesce(F.col(x).cast("string"), F.lit("")) for x in levels},
                             "__n": F.size(words(F.col(text_col))).cast("long"), "__id": F.col(id_col).cast("string"),
                             "__tie": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})


def plan_mixture(docs: DataFrame, levels: Sequence[str] = LEVELS, budget_share: float = 0.7, alpha: float = 0.5,
                 max_epochs: int = 4, seed: int = 7, targets: Mapping[str, Mapping[str, float]] | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per leaf: its path, ``tokens``, ``budget``, ``epochs`` taken whole, and ``last``.

    ``last`` is the place of the last document taken from the epoch after
    those, null when none is.  The budget is ``budget_share`` of all tokens.
    """
    keys = stored(_keyed(docs.select(*levels, id_col, text_col), levels, id_col, text_col)
                  .select(*[F.col(f"__l_{x}").alias(x) for x in levels], "__n", "__id", "__tie"), "mixture-keys")
    leaves = stored(keys.groupBy(*levels).agg(F.sum("__n").alias("__tokens")), "mixture-leaves")
    total = leaves.agg(F.sum("__tokens")).first()[0] or 0
    budgets = _budgets(leaves, levels, budget_share * total, alpha, max_epochs, targets or {})
    whole = F.floor(F.coalesce("__budget", F.lit(0.0)) + 1e-6).cast("long")
    plan = budgets.select(*levels, F.col("__tokens").alias("tokens"), whole.alias("budget"))
    plan = plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int"))
    plan = stored(plan.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")), "mixture-plan")

    place = F.struct(_order(seed, F.col("epochs") + 1, "__id").alias("h"), F.col("__id"), F.col("__n"), F.col("__tie"))
    open_ = join_small(keys, plan.filter("rest > 0"), list(levels)).select(*levels, "rest", "__n", place.alias("place"))
    open_ = open_.withColumn("__slice", F.substring("place.h", 1, 3))
    inside = Window.partitionBy(*levels, "__slice").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = open_.groupBy(*levels, "__slice").agg(F.sum("__n").alias("__slice_n"))
    before = Window.partitionBy(*levels).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__before", F.coalesce(F.sum("__slice_n").over(before), F.lit(0)))
    slices = stored(slices.join(plan.select(*levels, "rest"), list(levels)), "mixture-slices")
    # whole slices below the rest need no order: only the slice that the rest ends in is numbered
    crossing = slices.filter("__before <= rest and __before + __slice_n > rest").select(*levels, "__slice", "__before")
    numbered = (open_.join(crossing, [*levels, "__slice"]).withColumn("__end", F.col("__before") + F.sum("__n").over(inside))
                .filter("__end <= rest").groupBy(*levels).agg(F.max("place").alias("last")))
    done = slices.filter("__before + __slice_n <= rest").groupBy(*levels).agg(F.max("__slice").alias("slice"))
    plan = plan.drop("rest").join(numbered, list(levels), "left").join(done, list(levels), "left")
    return stored(plan, "mixture-plan")


def mix(docs: DataFrame, plan: DataFrame, levels: Sequence[str] = LEVELS, seed: int = 7, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """The documents of the mixture, once for each epoch they are in, with ``epoch`` (int, from 1).

    Documents without words are taken with the documents before them.  Rows
    that agree in id and text share a place.  A column ``epoch`` is replaced;
    all others are carried.  An empty table gives no rows.
    """
    leaf = plan.select(*[F.col(x).alias(f"__l_{x}") for x in levels], F.col("epochs").alias("__epochs"),
                       F.col("last").alias("__last"), F.col("slice").alias("__slice"))
    keyed = _keyed(docs.drop("epoch") if "epoch" not in levels else docs, levels, id_col, text_col)
    df = join_small(keyed, leaf, [f"__l_{x}" for x in levels])
    h = _order(seed, F.col("__epochs") + 1, "__id")
    place = F.struct(h.alias("h"), F.col("__id"), F.col("__n"), F.col("__tie"))
    part = F.coalesce(F.substring(h, 1, 3) <= F.col("__slice"), F.lit(False)) | F.coalesce(place <= F.col("__last"), F.lit(False))
    times = F.col("__epochs") + part.cast("int")
    out = df.withColumn("__times", times).filter("__times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return out.drop(*[c for c in out.columns if c.startswith("__") and c not in docs.columns])
