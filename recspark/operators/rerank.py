"""Per-request diversity rerank.

``mmr_rerank`` runs the greedy Maximal Marginal Relevance selection per
request with ``applyInPandas`` over buckets of whole requests.  The requests of
a bucket take their picks side by side; the similarity of every candidate to
the pick of its request (for list fields one product with a sparse incidence
matrix) updates a running ``max_sim`` vector, so a bucket costs ``k`` steps of
numpy work over its rows and tokens, without a Python loop over candidates.

Before the Python step an exact pool trim is applied.  With similarities in
``[0, 1]`` a candidate scoring more than ``margin`` below the ``k``-th best
score can never win a step (``margin = (1-lambda)/lambda`` for the relevance
form, ``lambda/(1-lambda)`` for the diversity form): at every step one of the
``k`` better candidates is still unpicked and beats it.  The trim therefore
never changes the result; it only bounds the rows shipped to Python.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("relevance", "diversity")


def check_params(lam: float, fields: list[str], mode: str) -> None:
    """K6."""
    if not 0.0 <= lam <= 1.0:
        raise ValueError("lambda must be between 0 and 1")
    if not fields:
        raise ValueError("at least one diversity field is needed")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")


def field_similarity(a: Column, b: Column, is_list: bool) -> Column:
    """U3 Jaccard for list fields, equality for scalars; null if either side is null."""
    if is_list:
        inter = F.size(F.array_intersect(a, b))
        union = F.size(F.array_union(a, b))
        sim = F.when(union > 0, inter / union).otherwise(F.lit(0.0))
    else:
        sim = (a == b).cast("double")
    return F.when(a.isNotNull() & b.isNotNull(), sim)


def item_similarity(pairs: list[tuple[Column, Column, bool]]) -> Column:
    """K1: mean over fields where both values are present; no such field -> 0."""
    sims = [field_similarity(a, b, lst) for a, b, lst in pairs]
    total = sum((F.coalesce(s, F.lit(0.0)) for s in sims), F.lit(0.0))
    count = sum((s.isNotNull().cast("int") for s in sims), F.lit(0))
    return F.when(count > 0, total / count).otherwise(F.lit(0.0))


def author_topic_similarity(a_author, a_topic, b_author, b_topic) -> Column:
    """K2: 0.5 for the same author plus 0.5 for the same topic."""
    return (F.when(a_author == b_author, 0.5).otherwise(0.0) + F.when(a_topic == b_topic, 0.5).otherwise(0.0))


def consecutive_duplicates(df: DataFrame, fields: list[str], request_col: str = "request_id",
                           order: str = "pos") -> DataFrame:
    """Rows whose value in some field equals the previous row's."""
    w = Window.partitionBy(request_col).orderBy(order)
    flags = [(F.lag(f).over(w) == F.col(f)).alias(f"dup_{f}") for f in fields]
    out = df.select("*", *flags)
    anyf = None
    for f in fields:
        c = F.coalesce(F.col(f"dup_{f}"), F.lit(False))
        anyf = c if anyf is None else anyf | c
    return out.withColumn("has_dup", anyf)


# --------------------------------------------------------------------------- greedy step (numpy)

class _ScalarField:
    """Values of one field as codes; -1 stands for null."""

    def __init__(self, col: pd.Series):
        self.codes, _ = pd.factorize(col, use_na_sentinel=True)

    def to_pick(self, pick_of_row: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Similarity of every row to its request's pick, and where both have a value."""
        theirs = self.codes[pick_of_row]
        both = (self.codes >= 0) & (theirs >= 0)
        return (both & (self.codes == theirs)).astype(float), both


class _ListField:
    """Lists of one field as a sparse incidence matrix: a column per (request, token) of the bucket.

    A pick marks the columns of its row; one product of the matrix with the
    marks gives the tokens that every row shares with the pick of its request.
    """

    def __init__(self, col: pd.Series, request: np.ndarray):
        values = col.to_numpy()
        self.present = np.array([v is not None for v in values], dtype=bool)
        sizes = np.array([0 if v is None else len(v) for v in values], dtype=np.int64)
        lists = [v for v in values if v is not None and len(v)]
        tokens = np.concatenate([np.asarray(v, dtype=object) for v in lists]) if lists else np.array([], dtype=object)
        codes, names = pd.factorize(tokens, use_na_sentinel=False)  # a null is a token of its own
        rows = np.repeat(np.arange(len(values)), sizes)
        width = max(len(names), 1)
        cells = np.unique(rows * width + codes)  # an item's tokens are a set
        self.row, code = np.divmod(cells, width)
        _, self.column = np.unique(request[self.row] * width + code, return_inverse=True)
        self.columns = int(self.column.max()) + 1 if len(cells) else 0
        self.size = np.bincount(self.row, minlength=len(values))
        self.start = np.searchsorted(self.row, np.arange(len(values) + 1))

    def to_pick(self, pick_of_row: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = self.present & self.present[pick_of_row]
        marks = np.zeros(self.columns, dtype=bool)
        length = self.size[picks]
        at = np.repeat(self.start[picks] - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(length.sum())
        marks[self.column[at]] = True
        shared = np.bincount(self.row[marks[self.column]], minlength=len(self.size))
        union = self.size + self.size[pick_of_row] - shared
        return np.where(both & (union > 0), shared / np.maximum(union, 1), 0.0), both


def _similarity(fields: list, pick_of_row: np.ndarray, picks: np.ndarray, mode: str) -> np.ndarray:
    """K1 (mean over the fields that both rows have) or K2 (0.5 per equal field, author and topic)."""
    if mode == "diversity":
        return sum((0.5 * f.to_pick(pick_of_row, picks)[0] for f in fields[:2]), np.zeros(len(pick_of_row)))
    total, count = np.zeros(len(pick_of_row)), np.zeros(len(pick_of_row))
    for f in fields:
        sim, both = f.to_pick(pick_of_row, picks)
        total += sim
        count += both
    return np.where(count > 0, total / np.maximum(count, 1), 0.0)


def greedy_mmr(pdf: pd.DataFrame, k: int, lam: float, fields: list[str], mode: str,
               list_fields: set[str], request_col: str = "request_id") -> pd.DataFrame:
    """Greedy selection for every request in ``pdf`` (a bucket of whole requests).

    All requests of the bucket take their picks side by side: a step is a
    handful of numpy operations over the rows left, whatever the number of
    requests or candidates.
    """
    order = np.lexsort((pdf["pos"].to_numpy(), pdf[request_col].to_numpy()))
    pdf = pdf.take(order).reset_index(drop=True)
    n = len(pdf)
    req = pdf[request_col].to_numpy()
    first = np.flatnonzero(np.r_[True, req[1:] != req[:-1]]) if n else np.array([], dtype=np.int64)
    request = np.repeat(np.arange(len(first)), np.diff(np.r_[first, n]))
    score = pdf["score"].fillna(0.0).to_numpy(dtype=float)
    cols = [_ListField(pdf[f], request) if mode == "relevance" and f in list_fields else _ScalarField(pdf[f])
            for f in fields]
    alive, max_sim = np.ones(n, dtype=bool), np.zeros(n)
    taken, ranks, row_no = [], [], np.arange(n)
    for step in range(1, k + 1):
        if not alive.any():
            break
        if mode == "relevance":
            mmr = lam * score - (1 - lam) * max_sim if step > 1 else score
        else:
            mmr = lam * (1.0 - max_sim) + (1 - lam) * score
        mmr = np.where(alive, mmr, -np.inf)
        best = np.maximum.reduceat(mmr, first)
        # the earliest position among a request's largest; a request without rows left picks none
        pick = np.minimum.reduceat(np.where(alive & (mmr == best[request]), row_no, n), first)
        picks = pick[pick < n]
        taken.append(picks)
        ranks.append(np.full(len(picks), step, dtype=np.int32))
        alive[picks] = False
        if step < k:
            pick_of_row = np.where(pick < n, pick, first)[request]  # finished requests compare with anything
            max_sim = np.maximum(max_sim, _similarity(cols, pick_of_row, picks, mode))
    rows = np.concatenate(taken) if taken else np.array([], dtype=np.int64)
    out = pdf.take(rows).reset_index(drop=True)
    out["mmr_rank"] = np.concatenate(ranks) if ranks else np.array([], dtype=np.int32)
    return out


def _sim_columns(fields: list[str], list_fields: set[str], mode: str, other: str) -> Column:
    """Similarity of every candidate to the picked row whose fields carry the prefix ``other``."""
    if mode == "relevance":
        return item_similarity([(F.col(f), F.col(other + f), f in list_fields) for f in fields])
    a, t = fields[0], fields[1]
    return author_topic_similarity(F.col(a), F.col(t), F.col(other + a), F.col(other + t))


def mmr_iterative(cands: DataFrame, k: int, lam: float, fields: list[str], mode: str,
                  request_col: str = "request_id", checkpoint_every: int = 4) -> DataFrame:
    """The greedy loop as ``k`` rounds of DataFrame operations (for hot requests).

    Each round takes the best unpicked candidate per request with ``min_by`` (T3)
    over ``(-mmr, pos)`` - a partial aggregate, so a request with millions of
    candidates is spread over many tasks - then updates every candidate's
    running maximum similarity against the pick (one row per request).  Picks
    go by ``(request, pos)``, so an item may stand in a request several times.  Lineage is cut with a reliable checkpoint every
    ``checkpoint_every`` rounds.  Same tie rules and float order as the pandas
    path.
    """
    from recspark.session import cut_lineage
    list_fields = {f for f in fields if isinstance(cands.schema[f].dataType, T.ArrayType)}
    cur = cands.withColumn("_ms", F.lit(0.0)).withColumn("_rank", F.lit(None).cast("int"))
    for t in range(1, k + 1):
        alive = F.col("_rank").isNull()
        if mode == "relevance":
            mmr = F.col("score") if t == 1 else F.lit(lam) * F.col("score") - F.lit(1 - lam) * F.col("_ms")
        else:
            div = F.lit(1.0) if t == 1 else F.lit(1.0) - F.col("_ms")
            mmr = F.lit(lam) * div + F.lit(1 - lam) * F.col("score")
        best = (cur.where(alive).withColumn("_mmr", mmr).groupBy(request_col)
                .agg(F.min_by("pos", F.struct((-F.col("_mmr")).alias("a"), F.col("pos").alias("b"))).alias("_pick")))
        picked = (cur.join(best, request_col).where(F.col("pos") == F.col("_pick"))
                  .select(request_col, *[F.col(f).alias("_p_" + f) for f in fields], F.col("pos").alias("_pick")))
        j = cur.join(picked, request_col, "left")
        sim = _sim_columns(fields, list_fields, mode, "_p_")
        cur = j.select(*cands.columns,
                       F.when(F.col("_pick").isNotNull() & alive, F.greatest(F.col("_ms"), sim))
                       .otherwise(F.col("_ms")).alias("_ms"),
                       F.when(F.col("pos") == F.col("_pick"), F.lit(t)).otherwise(F.col("_rank")).alias("_rank"))
        if t % checkpoint_every == 0 and t < k:
            cur = cut_lineage(cur)
    return cur.where(F.col("_rank").isNotNull()).withColumnRenamed("_rank", "mmr_rank").drop("_ms")


def mmr_rerank(cands: DataFrame, k: int, lam: float, fields: list[str], mode: str = "relevance",
               request_col: str = "request_id", item_col: str = "item_id", trim: bool = True,
               rows_per_task: int = 200_000, max_pool: int = 100_000) -> DataFrame:
    """K3 (``mode='relevance'``: ``lam*score - (1-lam)*max_sim``, K1 similarity) and
    K4 (``mode='diversity'``: ``lam*(1-max_sim) + (1-lam)*score``, K2 similarity).

    ``cands``: ``request_id, item_id, score, pos`` and the field columns (list
    fields as arrays).  Output: the same columns plus ``mmr_rank`` 1..k.

    ``pos`` must be unique within a request.  Requests are packed into hash
    buckets of about ``rows_per_task`` pool rows, so one pandas call serves
    many small requests; a request never spans buckets.  Requests whose
    (trimmed) pool exceeds ``max_pool`` rows go through ``mmr_iterative``
    instead, which picks the same rows, so no pandas call holds an unbounded
    pool.
    """
    check_params(lam, fields, mode)
    list_fields = {f for f in fields if isinstance(cands.schema[f].dataType, T.ArrayType)}
    c = cands.withColumn("score", F.coalesce(F.col("score").cast("double"), F.lit(0.0)))
    margin = None
    if trim:
        if mode == "relevance" and lam > 0:
            margin = (1 - lam) / lam
        elif mode == "diversity" and lam < 1:
            margin = lam / (1 - lam)
    if margin is not None:
        kth = (c.withColumn("_rn", F.row_number().over(
            Window.partitionBy(request_col).orderBy(F.col("score").desc(), "pos")))
            .where(F.col("_rn") <= k).groupBy(request_col).agg(F.min("score").alias("_kth")))
        c = c.join(kth, request_col).where(F.col("score") >= F.col("_kth") - F.lit(margin)).drop("_kth")
    # the trimmed pool is read twice (pool-size check, rerank): materialise it once
    from recspark.session import cut_lineage
    c = cut_lineage(c)
    pools = c.groupBy(request_col).agg(F.count(F.lit(1)).alias("_pool"))
    size = pools.agg(F.sum("_pool").alias("rows"), F.max("_pool").alias("most")).first()
    if (size["most"] or 0) > max_pool:
        hot = pools.where(F.col("_pool") > max_pool).select(request_col)
        out_big = mmr_iterative(c.join(hot, request_col, "left_semi"), k, lam, fields, mode, request_col)
        out_rest = mmr_rerank(c.join(hot, request_col, "left_anti"), k, lam, fields, mode, request_col, item_col,
                              trim=False, rows_per_task=rows_per_task, max_pool=max_pool)
        return out_rest.unionByName(out_big.select(*out_rest.columns))
    buckets = -(-(size["rows"] or 1) // rows_per_task)
    c = c.withColumn("_bucket", F.pmod(F.xxhash64(request_col), F.lit(buckets)))
    schema = T.StructType(list(c.schema.fields) + [T.StructField("mmr_rank", T.IntegerType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return greedy_mmr(pdf, k, lam, fields, mode, list_fields, request_col)

    return c.groupBy("_bucket").applyInPandas(run, schema).drop("_bucket")
