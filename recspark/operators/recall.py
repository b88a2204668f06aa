"""Rule recall and route merging.

Rule recall (``recall_by_field``): items whose ``field`` equals the request's
value, ``n`` of them in a repeatable pseudo-random order of the request's own.
The items of a value are numbered once, in the order of ``md5(item || seed)``;
a request starts at a place hashed from its id and takes ``n`` items from there
on, around the end.  The join is an equi-join on (value, place), so it emits at
most ``n`` rows per request and a popular value spreads over its places.

Route merge (``merge_routes``): routes are concatenated in priority order; an
item seen in an earlier route is dropped from later ones; the kept copy is
scored ``(1 - pos / route_len) * 10`` and the merged list is sorted by score,
ties by route priority then position (the reference's stable sort).  The parts it
works in hold about ``ROWS_PER_TASK`` rows, however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.fixed import ROUTE_SCORE_SCALE
from recspark.operators.ranking import dense_codes
from recspark.operators.sampling import distinct_draws
from recspark.session import store_rows

ROWS_PER_TASK = 100_000


def shuffle_key(item_col: str, seed: int | str) -> F.Column:
    """Repeatable pseudo-random order key."""
    return F.md5(F.concat_ws("|", F.col(item_col).cast("string"), F.lit(str(seed))))


def recall_by_field(requests: DataFrame, items: DataFrame, field: str, n: int, seed: int = 0,
                    request_col: str = "request_id", item_col: str = "item_id",
                    route: str | None = None, draws: str = "rotated") -> DataFrame:
    """``(request_id, item_id, route, pos)`` with ``pos`` 0-based.

    ``requests`` has ``request_id`` and ``field`` (the wanted value); ``items``
    has ``item_id`` and ``field``.  A value with fewer than ``n`` items gives
    them all.  Requests without a value get nothing.  With
    ``draws="independent"`` every request takes its places by a keyed partial
    shuffle of its own (``sampling.distinct_draws``), so requests of one value
    share no stretch of its order.
    """
    if draws not in ("rotated", "independent"):
        raise ValueError("draws must be 'rotated' or 'independent'")
    known = items.select(item_col, field).where(F.col(field).isNotNull()).distinct()
    places = dense_codes(known.withColumn("_k", shuffle_key(item_col, seed)), [field], [F.col("_k"), F.col(item_col)],
                         out="_place").select(field, item_col, "_place")
    sizes = known.groupBy(field).agg(F.count(F.lit(1)).alias("_size"))
    start = F.conv(F.substring(shuffle_key(request_col, seed), 1, 15), 16, 10).cast("long")
    sized = requests.select(request_col, field).join(sizes, field)
    if draws == "independent":
        key = F.concat_ws("|", F.col(request_col).cast("string"), F.lit(str(seed)))
        mine = distinct_draws(key, F.col("_size"), F.least(F.lit(n), F.col("_size")))
        wanted = sized.select("*", F.posexplode(mine).alias("pos", "_place"))
    else:
        wanted = (sized.withColumn("pos", F.explode(F.sequence(F.lit(0), F.least(F.lit(n), F.col("_size")).cast("int") - 1)))
                  .withColumn("_place", (F.pmod(start, "_size") + F.col("pos")) % F.col("_size")))
    out = wanted.join(places, [field, "_place"])
    return out.select(request_col, item_col, F.lit(route or field).alias("route"), "pos")


def route_positions(df: DataFrame, request_col: str = "request_id", order: str = "pos") -> DataFrame:
    """``pos`` (0-based, by ``order``) and ``route_len`` per (request, route)."""
    w = Window.partitionBy(request_col, "route")
    return (df.withColumn("pos", (F.row_number().over(w.orderBy(order)) - 1).cast("int"))
            .withColumn("route_len", F.count(F.lit(1)).over(w).cast("int")))


def merge_routes(routes: list[DataFrame], request_col: str = "request_id", item_col: str = "item_id",
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """R6 (+U2, W4, T1): dedupe across prioritised routes, rescore and rank.

    The routes are stored once and parted by request, about ``rows_per_task``
    rows a part: the three windows run in these parts, whose size does not grow
    with the input, and a reader of several rankings recalls nothing twice.

    Each route frame has ``request_id, item_id, route, pos``.  Output adds
    ``route_len``, ``score`` and the 1-based ``merged_rank``.
    """
    parts = [r.select(request_col, item_col, "route", "pos").withColumn("_prio", F.lit(i))
             for i, r in enumerate(routes)]
    allr = parts[0]
    for p in parts[1:]:
        allr = allr.unionByName(p)
    allr = store_rows(allr)
    allr = allr.repartition(max(1, -(-allr.count() // rows_per_task)), request_col)
    allr = allr.withColumn("route_len", F.count(F.lit(1)).over(
        Window.partitionBy(request_col, "_prio")).cast("int"))
    first = allr.withColumn("_first", F.row_number().over(
        Window.partitionBy(request_col, item_col).orderBy("_prio", "pos"))).where(F.col("_first") == 1)
    scored = first.withColumn("score", (F.lit(1.0) - F.col("pos") / F.col("route_len")) * F.lit(ROUTE_SCORE_SCALE))
    ranked = scored.withColumn("merged_rank", F.row_number().over(
        Window.partitionBy(request_col).orderBy(F.col("score").desc(), "_prio", "pos")))
    return ranked.select(request_col, item_col, "route", "pos", "route_len", "score", "merged_rank")
