"""Swing item-to-item recall.

Score of an item pair is ``co / (n_i + n_j - co)``: ``co`` is the number of
users who interacted with both items, ``n`` the number of distinct users of
an item.  Pairs are one-directional (``item1 < item2``) unless
``symmetric=True``.

Plan shape:

1. ``distinct(user, item)``, stored once as Parquet in the shared checkpoint
   folder; two counts over it (pairs in all, users of the most popular item)
   size the later shuffles.
2. ``n`` per item by ``groupBy(item).count()`` (map-side partial counts, so a
   hot item costs nothing extra) and attached to the distinct rows *before*
   pairs exist.  The pair table - by far the largest intermediate - is then
   never joined again; it is aggregated once and ranked once.
3. Partner lists: every row ``(user, item1)`` gets the user's other items and
   their ``n`` as two arrays of the narrowest type that holds them.  A user's
   items are dealt by hash into blocks of about ``block_items`` and a list never
   holds more than a block; for users of several blocks an equi self-join on
   ``(user, block, block)`` brings every two blocks together, each a join key of
   its own.  Every pair of items is produced exactly once.
4. The lists, not the pairs, are shuffled by ``item1`` into parts of about
   ``PAIRS_PER_TASK`` pairs.  Whole-number items go as an array of their low two
   bytes and one array of planes, in which equal bytes of neighbours lie side by
   side: the higher bytes of the items that their range needs, then those of the
   user counts (3 to 4 bytes a pair for millions of items with up to 255 users
   each).  They are exploded behind that shuffle, so
   ``groupBy(item1, item2).count()`` moves nothing.  Items of more than ``HOT_USERS`` users are cut into slices of
   partners, so no task holds all lists of such an item.
5. ``rank``/``row_number`` over ``item1`` filtered to ``<= k``, in the same parts;
   only sliced items need another exchange, behind a ``WindowGroupLimit``.

The pair order ``item1 < item2`` (P6) is settled in the sorted lists.  With
``symmetric=True`` every row keeps the whole list instead, so both directions of
a pair are counted where they are ranked.  Items per user as one
``collect_set`` list (A2) are deliberately not built: that list is an unbounded
per-user group in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.session import store_rows

BLOCK_ITEMS = 2000
PAIRS_PER_TASK = 2_000_000
HOT_USERS = 50_000


def interactions(df: DataFrame, user: str, item: str, ts: str | None = None) -> DataFrame:
    """Normalise a log to ``(user_id, item_id[, ts])`` and drop null keys."""
    cols = [F.col(user).alias("user_id"), F.col(item).alias("item_id")]
    if ts is not None:
        cols.append(F.col(ts).alias("ts"))
    return df.select(*cols).where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())


def time_window_filter(df: DataFrame, days: int | None, ts: str = "ts", as_of=None) -> DataFrame:
    """P5: keep rows with ``ts >= max(ts) - days`` (inclusive).

    ``as_of`` given: a literal bound that reaches the parquet scan as a pushed
    filter.  Otherwise the maximum is a scalar subquery evaluated by Spark -
    no ``collect()`` of the log.
    """
    if days is None:
        return df
    if as_of is not None:
        bound = F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days))
    else:
        bound = df.select(F.max(ts)).scalar() - F.make_interval(days=F.lit(days))
    return df.where(F.col(ts) >= bound)


def _known(log: DataFrame) -> DataFrame:
    """Distinct ``(user_id, item_id)`` without null keys."""
    return (log.select("user_id", "item_id")
            .where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).distinct())


def _item_users(ui: DataFrame) -> DataFrame:
    return ui.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))


def _item_rows(log: DataFrame) -> DataFrame:
    """Distinct ``(user_id, item_id)`` with the item's users ``n`` and the user's items ``m``."""
    ui = _known(log)
    return _with_items(ui.join(_item_users(ui), "item_id"))


def _with_items(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """``m``, the user's items, on distinct rows; the rows stay parted by user."""
    parted = rows.repartition(tasks, "user_id") if tasks else rows
    return parted.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("user_id")))


@dataclass(frozen=True)
class Sizes:
    """What the shuffles of the lists are sized by, and the types that hold items and user counts."""
    pairs: int
    most_users: int
    item_type: str
    count_type: str
    stored_type: str
    least_item: int | None = None
    item_bytes: int = 0
    count_bytes: int = 0

    @property
    def packed(self) -> bool:
        """Items are whole numbers, sent in bytes: two, ``item_bytes`` more and ``count_bytes`` of the user count."""
        return self.least_item is not None

    @property
    def list_tasks(self) -> int:
        return max(8, -(-self.pairs // (8 * PAIRS_PER_TASK)))

    @property
    def pair_tasks(self) -> int:
        return max(1, -(-self.pairs // PAIRS_PER_TASK))


def pair_sizes(ui: DataFrame, item_users: DataFrame, symmetric: bool = False) -> Sizes:
    """Two aggregates over the distinct rows and the users per item."""
    m = ui.groupBy("user_id").agg(F.count(F.lit(1)).alias("m"))
    pairs = m.agg(F.sum(F.col("m") * (F.col("m") - 1))).first()[0] or 0
    stored = ui.schema["item_id"].dataType.simpleString()
    whole = stored in ("bigint", "int", "smallint", "tinyint")
    ends = item_users.agg(F.max("n").alias("n"), *([F.min("item_id").alias("lo"), F.max("item_id").alias("hi")]
                                                   if whole else [])).first()
    most = ends["n"] or 0
    least, spread = (ends["lo"] or 0, (ends["hi"] or 0) - (ends["lo"] or 0)) if whole else (None, 0)
    if spread >= 2**62:
        least = None
    fits = whole and stored == "bigint" and (ends["lo"] is None or (ends["lo"] >= -2**31 and ends["hi"] < 2**31))
    return Sizes(pairs if symmetric else pairs // 2, most, "int" if fits else stored,
                 "smallint" if most < 2**15 else "bigint", stored, least,
                 max(0, -(-(spread.bit_length() - 16) // 8)), max(1, -(-most.bit_length() // 8)))


def _byte(value: Column, k: int) -> Column:
    """Byte ``k`` of a whole number that is not negative, as a signed one."""
    return (F.shiftright(value, 8 * k).bitwiseAND(255) - 128).cast("tinyint")


def _planes(sizes: Sizes) -> dict[str, Column]:
    """The arrays that hold items and user counts: the items' low two bytes, then a byte each."""
    item, n = F.col("item_id").cast("bigint") - F.lit(sizes.least_item).cast("bigint"), F.col("n").cast("bigint")
    each = [_byte(item, 2 + k) for k in range(sizes.item_bytes)] + [_byte(n, k) for k in range(sizes.count_bytes)]
    return {"_low": (item.bitwiseAND(65535) - 32768).cast("smallint"), **{f"_b{k}": c for k, c in enumerate(each)}}


def _from_bytes(each: list[Column]) -> Column:
    """The number whose bytes, lowest first, ``_byte`` made."""
    return sum((F.shiftleft(c.cast("bigint") + 128, 8 * k) for k, c in enumerate(each)), F.lit(0).cast("bigint"))


def _partners(side: DataFrame, block_items: int, sizes: Sizes | None = None, symmetric: bool = False) -> DataFrame:
    """``(x, nx, ys, nys)``: an item of a user, a list of the user's other items, and their user counts.

    The lists hold the larger items only, each once; ``symmetric``: all items
    of a block, ``x`` itself among them.  Packed ``sizes``: the arrays of
    ``_planes`` stand for ``nys`` and say the items once more.
    """
    item, n = F.col("item_id"), F.col("n")
    if sizes is not None:
        item, n = item.cast(sizes.item_type), n.cast(sizes.count_type)
    packed = sizes is not None and sizes.packed
    more = _planes(sizes) if packed else {"nys": n}
    lists = (side.withColumn("_blocks", F.ceil(F.col("m") / F.lit(block_items)).cast("int"))
             .withColumn("_own", F.pmod(F.xxhash64("item_id"), F.col("_blocks")).cast("int"))
             .groupBy("user_id", "_blocks", "_own")
             .agg(F.sort_array(F.collect_list(F.struct(item.alias("y"), *[c.alias(k) for k, c in more.items()]))).alias("_l")))
    lists = lists.select("user_id", "_blocks", "_own", F.col("_l.y").alias("ys"), *[F.col("_l")[k].alias(k) for k in more])
    counts = [f"_b{sizes.item_bytes + k}" for k in range(sizes.count_bytes)] if packed else ["nys"]

    def count(names: list[str]) -> Column:
        at = [F.get(c, F.col("_p")) for c in names]
        return _from_bytes(at).cast(sizes.count_type) if packed else at[0]

    one = (lists.where(F.col("_blocks") == 1).select("ys", *more, F.posexplode("ys").alias("_p", "x"))
           .withColumn("nx", count(counts)).withColumn("_from", F.col("_p") + 2))
    # users of several blocks: every block meets every block, each two of them a join key of its own
    many = lists.where(F.col("_blocks") > 1)
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    of_x = [f"{c}_x" for c in counts]
    a = many.select("user_id", F.col("ys").alias("xs"), *[F.col(c).alias(o) for c, o in zip(counts, of_x)],
                    F.col("_own").alias("_i"), every.alias("_j"))
    b = many.select("user_id", "ys", *more, F.col("_own").alias("_j"), every.alias("_i"))
    met = (a.join(b, ["user_id", "_i", "_j"]).select("ys", *more, *of_x, F.posexplode("xs").alias("_p", "x"))
           .withColumn("nx", count(of_x))
           .withColumn("_from", F.size(F.filter("ys", lambda y: y <= F.col("x"))) + 1))
    rows = one.select("x", "nx", "ys", *more, "_from").unionByName(met.select("x", "nx", "ys", *more, "_from"))
    if symmetric:
        return rows.drop("_from")
    rest = [F.slice(c, F.col("_from"), F.size(c)).alias(c) for c in ("ys", *more)]
    return rows.select("x", "nx", *rest).where(F.size("ys") > 0)


def _exploded(lists: DataFrame, *cols: Column, symmetric: bool = False, sizes: Sizes | None = None) -> DataFrame:
    """The pairs of the lists."""
    if sizes is not None and sizes.packed:
        planes = sizes.item_bytes + sizes.count_bytes
        place = lambda k: F.get("_bytes", F.col("_p") + F.lit(k) * F.col("_many"))
        pairs = (lists.select("x", "nx", "_bytes", *cols, F.posexplode("ys").alias("_p", "_low"))
                 .withColumn("_many", (F.size("_bytes") / planes).cast("int")))
        high = F.shiftleft(_from_bytes([place(k) for k in range(sizes.item_bytes)]), 16)
        pairs = pairs.select(
            "x", "nx", *cols, (high + F.col("_low") + F.lit(32768 + sizes.least_item).cast("bigint")).alias("y"),
            _from_bytes([place(k) for k in range(sizes.item_bytes, planes)]).alias("ny"))
    else:
        pairs = (lists.select("x", "nx", "nys", *cols, F.posexplode("ys").alias("_p", "y"))
                 .withColumn("ny", F.get("nys", F.col("_p"))))
    return pairs.where(F.col("x") != F.col("y")) if symmetric else pairs


def _pairs(side: DataFrame, block_items: int) -> DataFrame:
    """All ``(item1 < item2)`` pairs sharing a user, with the item user counts."""
    return _exploded(_partners(side, block_items)).select(
        F.col("x").alias("item1"), F.col("y").alias("item2"),
        F.col("nx").alias("item1_user_count"), F.col("ny").alias("item2_user_count"))


def count_pairs(side: DataFrame, sizes: Sizes, block_items: int = BLOCK_ITEMS, symmetric: bool = False,
                hot_users: int = HOT_USERS, tasks: int | None = None) -> DataFrame:
    """Co-occurrence counts; the lists move by ``item1`` (and slice), the pairs not at all.

    ``tasks`` fixes the number of parts (the buckets of a table).
    """
    lists = _partners(side, block_items, sizes, symmetric)
    item1 = F.col("x").cast(sizes.stored_type)
    by, cut = [item1], []
    if sizes.most_users > hot_users and tasks is None:
        lists = (lists.withColumn("_cuts", F.ceil(F.col("nx") / F.lit(hot_users)).cast("int"))
                 .withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1))))
        here = lambda y: F.pmod(F.xxhash64(y), F.col("_cuts")) == F.col("_s")
        # another name: inside a function ``ys`` would mean the list that is already cut
        arrays = [c for c in lists.columns if c not in ("x", "nx", "_cuts", "_s")]
        lists = lists.withColumn("_ys", F.col("ys"))
        lists = lists.withColumns({c: F.when(F.col("_cuts") > 1, F.filter(c, lambda _, i: here(F.get("_ys", i)))).otherwise(F.col(c))
                                   for c in arrays})
        by, cut = [item1, F.col("_s")], [F.col("_s")]
    if sizes.packed:
        held = [F.col("_low").alias("ys"),
                F.concat(*[f"_b{k}" for k in range(sizes.item_bytes + sizes.count_bytes)]).alias("_bytes")]
    else:
        held = [F.col("ys"), F.col("nys")]
    moved = lists.select("x", "nx", *held, *cut).repartition(tasks or sizes.pair_tasks, *by)
    pairs = _exploded(moved, *cut, symmetric=symmetric, sizes=sizes).select(
        item1.alias("item1"), F.col("y").cast(sizes.stored_type).alias("item2"),
        F.col("nx").cast("bigint").alias("item1_user_count"), F.col("ny").cast("bigint").alias("item2_user_count"), *cut)
    keys = ["item1", "item2", "item1_user_count", "item2_user_count"]
    return pairs.groupBy(*keys, *cut).agg(F.count(F.lit(1)).alias("co_occurrence_count")).select(
        *keys, "co_occurrence_count")


def swing_cooccurrence(df: DataFrame, block_items: int = BLOCK_ITEMS, symmetric: bool = False,
                       hot_users: int = HOT_USERS) -> DataFrame:
    """R1 + A1 + J6: ``(item1, item2, co_occurrence_count, item1_user_count, item2_user_count)``.

    ``symmetric``: every pair in both directions (U5).
    """
    ui = store_rows(_known(df))
    n = _item_users(ui)
    sizes = pair_sizes(ui, n, symmetric)
    return count_pairs(_with_items(ui.join(n, "item_id"), sizes.list_tasks), sizes, block_items, symmetric, hot_users)


def swing_scores(co: DataFrame, symmetric: bool = False) -> DataFrame:
    """R2 (+P7, U5): Jaccard-style score in double, zero denominators guarded."""
    denom = F.col("item1_user_count") + F.col("item2_user_count") - F.col("co_occurrence_count")
    out = (co.where(denom > 0)
           .select("item1", "item2", "co_occurrence_count", "item1_user_count", "item2_user_count",
                   (F.col("co_occurrence_count").cast("double") / denom.cast("double")).alias("swing_score")))
    if symmetric:
        mirrored = out.select(F.col("item2").alias("item1"), F.col("item1").alias("item2"),
                              "co_occurrence_count",
                              F.col("item2_user_count").alias("item1_user_count"),
                              F.col("item1_user_count").alias("item2_user_count"), "swing_score")
        out = out.unionByName(mirrored)
    return out


def top_k_per_key(df: DataFrame, key: str | list[str], order: list[Column], k: int,
                  ties: str = "rank", rank_col: str = "rank") -> DataFrame:
    """Top-k rows per key.  ``ties='rank'`` keeps ties (may exceed k),
    ``'row_number'`` returns at most k using the full order as tie-break."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    if ties == "rank":
        fn = F.rank()
    elif ties == "row_number":
        fn = F.row_number()
    else:
        raise ValueError(f"ties must be 'rank' or 'row_number', got {ties!r}")
    return df.withColumn(rank_col, fn.over(w)).where(F.col(rank_col) <= k)


def swing_recommend(scores: DataFrame, k: int = 10, ties: str = "rank") -> DataFrame:
    """Best ``k`` partners per ``item1`` -> ``(item1, item2, swing_score, rank)``."""
    order = [F.col("swing_score").desc()]
    if ties == "row_number":
        order.append(F.col("item2").asc())
    ranked = top_k_per_key(scores, "item1", order, k, ties=ties)
    return ranked.select("item1", "item2", "swing_score", "rank")


def swing(df: DataFrame, days: int | None = None, k: int = 10, ties: str = "rank",
          symmetric: bool = False, as_of=None, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Window filter -> co-occurrence -> score -> top-k.

    ``df`` has ``user_id, item_id`` and, when ``days`` is set, ``ts``.
    """
    data = time_window_filter(df, days, as_of=as_of) if days is not None else df
    co = swing_cooccurrence(data, block_items=block_items, symmetric=symmetric)
    return swing_recommend(swing_scores(co), k=k, ties=ties)


def swing_sql(spark, log: DataFrame, k: int = 10, days: int | None = None, block_items: int = BLOCK_ITEMS,
              hot_users: int = HOT_USERS) -> DataFrame:
    """R1-R4 in Spark SQL - the form of the SQL (CTAS) variant.

    The distinct rows are stored; the other steps are common table expressions
    and Catalyst plans the chain as one query, with the lists, blocks and slices
    of steps 3 and 4.  Top-k uses ``ROW_NUMBER`` with ``item2`` as tie-break.
    ``log`` has ``user_id, item_id`` (and ``ts`` when ``days`` is set).
    """
    where = ("ts >= (SELECT max(ts) FROM {log}) - make_interval(0, 0, 0, " + str(int(days)) + ") AND"
             if days is not None else "")
    ui = store_rows(spark.sql(f"""SELECT DISTINCT user_id, item_id FROM {{log}}
                                  WHERE {where} user_id IS NOT NULL AND item_id IS NOT NULL""", log=log))
    sizes = pair_sizes(ui, _item_users(ui))
    hot = sizes.most_users > hot_users
    cuts = f"CAST(CEIL(nx / {int(hot_users)}) AS INT)"
    here = f"PMOD(XXHASH64({{}}), {cuts}) = s"
    item1, by = f"CAST(x AS {sizes.stored_type}) AS item1", ", s" if hot else ""
    part = (f"""SELECT {item1}, nx, s, IF({cuts} > 1, FILTER(all_ys, y -> {here.format('y')}), all_ys) AS ys,
                       IF({cuts} > 1, FILTER(all_nys, (_, p) -> {here.format('GET(all_ys, p)')}), all_nys) AS nys
                FROM partners LATERAL VIEW EXPLODE(SEQUENCE(0, {cuts} - 1)) AS s""" if hot else
            f"SELECT {item1}, nx, 0 AS s, all_ys AS ys, all_nys AS nys FROM partners")
    return spark.sql(f"""
        WITH cnt AS (SELECT item_id, COUNT(*) AS n FROM {{ui}} GROUP BY item_id),
        byuser AS (SELECT /*+ REPARTITION({sizes.list_tasks}, user_id) */ user_id, item_id, n
                   FROM {{ui}} JOIN cnt USING (item_id)),
        dealt AS (SELECT user_id, item_id, n,
                         CAST(CEIL(COUNT(*) OVER (PARTITION BY user_id) / {int(block_items)}) AS INT) AS blocks FROM byuser),
        lists AS (SELECT user_id, blocks, own, l.y AS ys, l.ny AS nys FROM (
                    SELECT user_id, blocks, CAST(PMOD(XXHASH64(item_id), blocks) AS INT) AS own,
                           SORT_ARRAY(COLLECT_LIST(STRUCT(CAST(item_id AS {sizes.item_type}) AS y,
                                                          CAST(n AS {sizes.count_type}) AS ny))) AS l
                    FROM dealt GROUP BY 1, 2, 3)),
        a AS (SELECT user_id, own AS i, ys AS xs, nys AS nxs, EXPLODE(SEQUENCE(0, blocks - 1)) AS j
              FROM lists WHERE blocks > 1),
        b AS (SELECT user_id, own AS j, ys, nys, EXPLODE(SEQUENCE(0, blocks - 1)) AS i FROM lists WHERE blocks > 1),
        met AS (SELECT x, GET(nxs, p) AS nx, SIZE(FILTER(ys, y -> y <= x)) + 1 AS at, ys, nys
                FROM a JOIN b USING (user_id, i, j) LATERAL VIEW POSEXPLODE(xs) AS p, x),
        partners AS (SELECT x, nx, SLICE(ys, at, SIZE(ys)) AS all_ys, SLICE(nys, at, SIZE(nys)) AS all_nys FROM (
                       SELECT x, GET(nys, p) AS nx, p + 2 AS at, ys, nys FROM lists LATERAL VIEW POSEXPLODE(ys) AS p, x
                       WHERE blocks = 1 UNION ALL SELECT * FROM met) WHERE at <= SIZE(ys)),
        part AS ({part}),
        moved AS (SELECT /*+ REPARTITION({sizes.pair_tasks}, item1{by}) */ * FROM part),
        co AS (SELECT item1, CAST(y AS {sizes.stored_type}) AS item2,
                      CAST(nx AS BIGINT) + GET(nys, p) AS users, s, COUNT(*) AS co
               FROM moved LATERAL VIEW POSEXPLODE(ys) AS p, y GROUP BY 1, 2, 3, 4),
        score AS (SELECT item1, item2, CAST(co AS DOUBLE) / (users - co) AS swing_score FROM co WHERE users - co > 0)
        SELECT item1, item2, swing_score, rank FROM (
          SELECT item1, item2, swing_score,
                 ROW_NUMBER() OVER (PARTITION BY item1 ORDER BY swing_score DESC, item2) AS rank
          FROM score) WHERE rank <= {int(k)}""", ui=ui)
