"""Swing queries over ``orders JOIN lineitem`` (user = customer, item = part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.operators import sketches as SK
from recspark.operators import swing as sw
from recspark.plans.catalog import register
from recspark.session import cut_lineage, read_table


def purchase_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction log ``(user_id, item_id, ts)`` = customer bought part at order date."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    return sw.interactions(li.join(o, F.col("l_orderkey") == F.col("o_orderkey")),
                           "o_custkey", "l_partkey", "o_orderdate")


_UI = """
ui AS (SELECT DISTINCT o.o_custkey AS user_id, l.l_partkey AS item_id, o.o_orderdate AS ts
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def _swing_sql(where: str, k: int, rank_fn: str, order_extra: str = "") -> str:
    return f"""
WITH {_UI},
f AS (SELECT DISTINCT user_id, item_id FROM ui {where}),
cnt AS (SELECT item_id, count(*) AS n FROM f GROUP BY item_id),
co AS (SELECT a.item_id AS item1, b.item_id AS item2, count(*) AS co
       FROM f a JOIN f b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2),
sc AS (SELECT item1, item2, co::DOUBLE / (c1.n + c2.n - co) AS s
       FROM co JOIN cnt c1 ON c1.item_id = co.item1 JOIN cnt c2 ON c2.item_id = co.item2),
r AS (SELECT item1, item2, s, {rank_fn}() OVER (PARTITION BY item1 ORDER BY s DESC{order_extra}) AS rk FROM sc)
SELECT item1, item2, round(s, 6) AS swing_score, CAST(rk AS BIGINT) AS rank FROM r WHERE rk <= {k}
"""


def _out(df: DataFrame) -> DataFrame:
    return df.select("item1", "item2", F.round("swing_score", 6).alias("swing_score"),
                     F.col("rank").cast("long").alias("rank"))


@register("R4_swing", _swing_sql("", 10, "rank"))
def q_swing(spark, sf_dir):
    return _out(sw.swing(purchase_log(spark, sf_dir), k=10, ties="rank"))


@register("R4_swing_30d", _swing_sql(
    "WHERE ts >= (SELECT max(ts) FROM ui) - INTERVAL 30 DAY", 10, "rank"))
def q_swing_30d(spark, sf_dir):
    return _out(sw.swing(purchase_log(spark, sf_dir), days=30, k=10, ties="rank"))


@register("W2_swing_row_number", _swing_sql("", 5, "row_number", ", item2 ASC"))
def q_swing_rn(spark, sf_dir):
    return _out(sw.swing(purchase_log(spark, sf_dir), k=5, ties="row_number"))


@register("R1_swing_cooccurrence", f"""
WITH {_UI},
f AS (SELECT DISTINCT user_id, item_id FROM ui),
cnt AS (SELECT item_id, count(*) AS n FROM f GROUP BY item_id)
SELECT a.item_id AS item1, b.item_id AS item2, count(*) AS co_occurrence_count,
       any_value(c1.n) AS item1_user_count, any_value(c2.n) AS item2_user_count
FROM f a JOIN f b ON a.user_id = b.user_id AND a.item_id < b.item_id
JOIN cnt c1 ON c1.item_id = a.item_id JOIN cnt c2 ON c2.item_id = b.item_id
GROUP BY 1, 2
""")
def q_cooc(spark, sf_dir):
    co = sw.swing_cooccurrence(purchase_log(spark, sf_dir))
    return co.select("item1", "item2", "co_occurrence_count", "item1_user_count", "item2_user_count")


@register("U5_swing_symmetric", f"""
WITH {_UI},
f AS (SELECT DISTINCT user_id, item_id FROM ui),
cnt AS (SELECT item_id, count(*) AS n FROM f GROUP BY item_id),
co AS (SELECT a.item_id AS item1, b.item_id AS item2, count(*) AS co
       FROM f a JOIN f b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2),
sc AS (SELECT item1, item2, co::DOUBLE / (c1.n + c2.n - co) AS s
       FROM co JOIN cnt c1 ON c1.item_id = co.item1 JOIN cnt c2 ON c2.item_id = co.item2),
m AS (SELECT item1, item2, s FROM sc UNION ALL SELECT item2, item1, s FROM sc),
r AS (SELECT item1, item2, s, rank() OVER (PARTITION BY item1 ORDER BY s DESC) AS rk FROM m)
SELECT item1, item2, round(s, 6) AS swing_score, CAST(rk AS BIGINT) AS rank FROM r WHERE rk <= 10
""")
def q_swing_sym(spark, sf_dir):
    return _out(sw.swing(purchase_log(spark, sf_dir), k=10, symmetric=True))


@register("P5_time_window_filter", f"""
WITH {_UI}
SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       CAST(min(ts) AS VARCHAR) AS min_ts, CAST(max(ts) AS VARCHAR) AS max_ts
FROM ui WHERE ts >= (SELECT max(ts) FROM ui) - INTERVAL 7 DAY
""")
def q_window(spark, sf_dir):
    log = purchase_log(spark, sf_dir).distinct()
    f = sw.time_window_filter(log, 7)
    return f.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("n_users"),
                 F.countDistinct("item_id").alias("n_items"),
                 F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("min_ts"),
                 F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("max_ts"))


@register("R4_swing_sql", _swing_sql("", 5, "row_number", ", item2 ASC"))
def q_swing_sql(spark, sf_dir):
    """The SQL form (temp-view chain, ROW_NUMBER) on the same log."""
    return _out(sw.swing_sql(spark, purchase_log(spark, sf_dir), k=5))


_BRAND_LOG = """
WITH log AS (SELECT p.p_brand AS brand, o.o_custkey AS user_id, CAST(o.o_orderdate AS DATE) AS day
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey)
"""


def _brand_log(spark, sf) -> DataFrame:
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand"])
    return purchase_log(spark, sf).join(p, F.col("item_id") == F.col("p_partkey")).select(
        F.col("p_brand").alias("brand"), "user_id", F.to_date("ts").alias("day"))


@register("A1_sketch_users", _BRAND_LOG + """
SELECT brand, count(DISTINCT user_id) AS n_users, TRUE AS close FROM log GROUP BY brand""")
def q_sketch_users(spark, sf):
    """Users per brand from stored daily sketches, within 3 % of the exact count."""
    log = _brand_log(spark, sf)
    stored = cut_lineage(SK.daily_sketches(log, "brand", "user_id", F.col("day")))
    exact = log.groupBy("brand").agg(F.count_distinct("user_id").alias("n_users"))
    both = SK.approx_users(stored, "brand", "about").join(exact, "brand")
    return both.select("brand", "n_users", (F.abs(F.col("about") - F.col("n_users")) <= 0.03 * F.col("n_users")).alias("close"))


@register("P5_rolling_sketch_users", _BRAND_LOG + """,
days AS (SELECT DISTINCT brand, day FROM log)
SELECT d.brand, CAST(d.day AS VARCHAR) AS day, count(DISTINCT l.user_id) AS n_users, TRUE AS close
FROM days d JOIN log l ON l.brand = d.brand AND l.day <= d.day AND l.day > d.day - INTERVAL 30 DAY GROUP BY d.brand, d.day""")
def q_rolling_sketch_users(spark, sf):
    """Users per brand of the 30 days up to each day, from stored daily sketches, within 3 % of the exact count."""
    log = cut_lineage(_brand_log(spark, sf).distinct())
    stored = cut_lineage(SK.daily_sketches(log, "brand", "user_id", F.col("day")))
    exact = SK.exact_rolling_users(log, "brand", "user_id", 30)
    both = SK.rolling_users(stored, "brand", 30, "about").join(exact, ["brand", "day"])
    return both.select("brand", F.col("day").cast("string").alias("day"), "n_users",
                       (F.abs(F.col("about") - F.col("n_users")) <= 0.03 * F.col("n_users")).alias("close"))
