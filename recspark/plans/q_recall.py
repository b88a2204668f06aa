"""Recall, merge, rerank and history queries.

Items are parts (author = ``p_brand``, topic = ``p_type``, stock = name
tokens); a request is a customer, whose wanted author/topic is the brand/type
it bought most (ties: smallest value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.scalars import str_to_list
from recspark.operators import recall as RC
from recspark.operators import rerank as RR
from recspark.operators.history import build_history
from recspark.plans.catalog import register
from recspark.plans.q_swing import purchase_log
from recspark.session import read_table


def items(spark, sf) -> DataFrame:
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_type", "p_name", "p_retailprice"])
    return p.select(F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("author"),
                    F.col("p_type").alias("topic"), str_to_list("p_name", " ").alias("stock"),
                    "p_retailprice")


def requests(spark, sf) -> DataFrame:
    """Per customer the most bought brand and type (``min_by`` over ``(-count, value)``)."""
    log = purchase_log(spark, sf).select("user_id", "item_id")
    it = items(spark, sf).select("item_id", "author", "topic")
    j = log.join(it, "item_id")

    def fav(col):
        c = j.groupBy("user_id", col).agg(F.count(F.lit(1)).alias("n"))
        return c.groupBy("user_id").agg(F.min_by(col, F.struct((-F.col("n")).alias("a"), F.col(col).alias("b")))
                                        .alias(col))
    return fav("author").join(fav("topic"), "user_id").withColumnRenamed("user_id", "request_id")


def routes(spark, sf, n=10):
    req, it = requests(spark, sf), items(spark, sf)
    a = RC.recall_by_field(req, it, "author", n, seed=7)
    t = RC.recall_by_field(req, it, "topic", n, seed=7)
    return a, t


_SQL_BASE = """
WITH log AS (SELECT o.o_custkey AS user_id, l.l_partkey AS item_id FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
it AS (SELECT p_partkey AS item_id, p_brand AS author, p_type AS topic, string_split(p_name, ' ') AS stock FROM part),
fa AS (SELECT user_id, author, count(*) AS n FROM log JOIN it USING (item_id) GROUP BY 1, 2),
ft AS (SELECT user_id, topic, count(*) AS n FROM log JOIN it USING (item_id) GROUP BY 1, 2),
req AS (SELECT a.user_id AS request_id, a.author, t.topic FROM
        (SELECT user_id, author, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, author) AS r FROM fa) a
        JOIN (SELECT user_id, topic, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, topic) AS r FROM ft) t
        ON a.user_id = t.user_id AND a.r = 1 AND t.r = 1),
ra AS (SELECT item_id, author, row_number() OVER (PARTITION BY author ORDER BY md5(concat_ws('|', CAST(item_id AS VARCHAR), '7')), item_id) - 1 AS place,
              count(*) OVER (PARTITION BY author) AS size FROM it),
rt AS (SELECT item_id, topic, row_number() OVER (PARTITION BY topic ORDER BY md5(concat_ws('|', CAST(item_id AS VARCHAR), '7')), item_id) - 1 AS place,
              count(*) OVER (PARTITION BY topic) AS size FROM it),
start AS (SELECT *, ('0x' || substr(md5(concat_ws('|', CAST(request_id AS VARCHAR), '7')), 1, 15))::BIGINT AS h FROM req),
routes AS (SELECT request_id, item_id, 'author' AS route, CAST((place - h % size + size) % size AS INTEGER) AS pos, 0 AS prio
           FROM start JOIN ra USING (author) WHERE (place - h % size + size) % size < 10
           UNION ALL
           SELECT request_id, item_id, 'topic', CAST((place - h % size + size) % size AS INTEGER), 1
           FROM start JOIN rt USING (topic) WHERE (place - h % size + size) % size < 10),
rl AS (SELECT *, CAST(count(*) OVER (PARTITION BY request_id, prio) AS INTEGER) AS route_len FROM routes),
fst AS (SELECT * FROM rl QUALIFY row_number() OVER (PARTITION BY request_id, item_id ORDER BY prio, pos) = 1),
merged AS (SELECT request_id, item_id, route, pos, route_len, (1.0 - pos / route_len) * 10 AS score,
                  row_number() OVER (PARTITION BY request_id ORDER BY (1.0 - pos / route_len) * 10 DESC, prio, pos) AS merged_rank
           FROM fst)
"""


@register("R5_rule_recall", _SQL_BASE + "SELECT request_id, item_id, route, pos FROM routes")
def q_rule_recall(spark, sf):
    a, t = routes(spark, sf)
    return a.unionByName(t)


@register("R5_independent_recall", _SQL_BASE.replace("WITH log", "WITH RECURSIVE log", 1) + """,
wanted AS (SELECT request_id, author, size FROM req JOIN (SELECT DISTINCT author, size FROM ra) USING (author)),
drawn AS (SELECT request_id, author, size, 0 AS j, CAST([] AS BIGINT[]) AS places FROM wanted
          UNION ALL
          SELECT request_id, author, size, j + 1, list_append(places, list_reduce(
              list_concat([('0x' || substr(md5(CAST(request_id AS VARCHAR) || '|7|' || CAST(j + 1 AS VARCHAR)), 1, 15))::BIGINT % (size - j)],
                          list_sort(places)), lambda x, seen: CASE WHEN x >= seen THEN x + 1 ELSE x END))
          FROM drawn WHERE j < least(10, size)),
taken AS (SELECT request_id, author, unnest(places) AS place, unnest(range(0, len(places))) AS pos FROM drawn WHERE j = least(10, size))
SELECT request_id, item_id, 'author' AS route, CAST(pos AS INTEGER) AS pos FROM taken JOIN ra USING (author, place)""")
def q_independent_recall(spark, sf):
    """An order of its own for every request of one value."""
    return RC.recall_by_field(requests(spark, sf), items(spark, sf), "author", 10, seed=7, draws="independent")


@register("R6_merge_routes", _SQL_BASE + """
SELECT request_id, item_id, route, pos, route_len, round(score, 6) AS score, CAST(merged_rank AS INTEGER) AS merged_rank FROM merged""")
def q_merge(spark, sf):
    a, t = routes(spark, sf)
    m = RC.merge_routes([a, t])
    return m.select("request_id", "item_id", "route", "pos", "route_len", F.round("score", 6).alias("score"),
                    F.col("merged_rank").cast("int"))


def merged_candidates(spark, sf):
    a, t = routes(spark, sf)
    m = RC.merge_routes([a, t]).select("request_id", "item_id", "score",
                                       (F.col("merged_rank") - 1).alias("pos"))
    return m.join(items(spark, sf).select("item_id", "author", "topic", "stock"), "item_id")


@register("K1_K2_similarity_to_top", _SQL_BASE + """,
c AS (SELECT m.request_id, m.item_id, m.merged_rank, it.author, it.topic, it.stock FROM merged m JOIN it USING (item_id)),
top AS (SELECT request_id, author AS t_author, topic AS t_topic, stock AS t_stock FROM c WHERE merged_rank = 1)
SELECT request_id, item_id,
  round(((CASE WHEN author = t_author THEN 1.0 ELSE 0.0 END) + (CASE WHEN topic = t_topic THEN 1.0 ELSE 0.0 END) +
   (CASE WHEN len(list_distinct(list_concat(stock, t_stock))) > 0
         THEN len(list_intersect(stock, t_stock)) / len(list_distinct(list_concat(stock, t_stock))) ELSE 0.0 END)) / 3, 6) AS sim_k1,
  CAST((CASE WHEN author = t_author THEN 0.5 ELSE 0.0 END) + (CASE WHEN topic = t_topic THEN 0.5 ELSE 0.0 END) AS DOUBLE) AS sim_k2
FROM c JOIN top USING (request_id)""")
def q_sim(spark, sf):
    c = merged_candidates(spark, sf)
    top = c.where(F.col("pos") == 0).select("request_id", F.col("author").alias("t_author"),
                                            F.col("topic").alias("t_topic"), F.col("stock").alias("t_stock"))
    j = c.join(top, "request_id")
    k1 = RR.item_similarity([(F.col("author"), F.col("t_author"), False), (F.col("topic"), F.col("t_topic"), False),
                             (F.col("stock"), F.col("t_stock"), True)])
    k2 = RR.author_topic_similarity(F.col("author"), F.col("topic"), F.col("t_author"), F.col("t_topic"))
    return j.select("request_id", "item_id", F.round(k1, 6).alias("sim_k1"), k2.alias("sim_k2"))


@register("K5_consecutive_duplicates", _SQL_BASE + """,
c AS (SELECT m.request_id, m.item_id, m.merged_rank, it.author, it.topic FROM merged m JOIN it USING (item_id))
SELECT request_id, item_id,
  coalesce(lag(author) OVER w = author, false) OR coalesce(lag(topic) OVER w = topic, false) AS has_dup
FROM c WINDOW w AS (PARTITION BY request_id ORDER BY merged_rank)""")
def q_dups(spark, sf):
    c = merged_candidates(spark, sf)
    d = RR.consecutive_duplicates(c, ["author", "topic"], order="pos")
    return d.select("request_id", "item_id", "has_dup")


def q_mmr(spark, sf):
    c = merged_candidates(spark, sf)
    r = RR.mmr_rerank(c, k=5, lam=0.5, fields=["author", "topic", "stock"], mode="relevance")
    return r.select("request_id", "item_id", "mmr_rank")


def q_mmr_div(spark, sf):
    c = merged_candidates(spark, sf)
    r = RR.mmr_rerank(c, k=5, lam=0.7, fields=["author", "topic"], mode="diversity")
    return r.select("request_id", "item_id", "mmr_rank")


_HIST_SQL = """
WITH log AS (SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, o.o_orderdate AS ts, l.l_orderkey, l.l_linenumber
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
h AS (SELECT l_orderkey, l_linenumber, coalesce(list(item_id) OVER (PARTITION BY user_id ORDER BY ts, l_orderkey, l_linenumber, item_id
              ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), []) AS history FROM log)
SELECT l_orderkey, l_linenumber, history, len(history) AS history_len,
       list_slice(list_concat(history, [0, 0, 0, 0, 0]), 1, 5) AS history_padded FROM h
"""


@register("W6_R11_history", _HIST_SQL)
def q_history(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    log = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), F.col("o_orderdate").alias("ts"),
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("tie_item"))
    h = build_history(log, "user_id", "item_id", "ts", ["l_orderkey", "l_linenumber", "tie_item"], 5,
                      pad_value=0)
    return h.select("l_orderkey", "l_linenumber", "history", F.col("history_len").cast("long"),
                    F.col("history_padded").cast("array<bigint>"))


@register("W6_event_history", """
SELECT event_id, coalesce(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), []) AS history FROM events""")
def q_event_history(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    h = build_history(ev, "user_id", "event_type", "ts", ["event_id"], 8, bucket="hour")
    return h.select("event_id", "history")


def _mmr_unrolled_sql(sim: str, mmr: str, k: int) -> str:
    """Greedy MMR unrolled for ``k`` picks (first pick: best score; ties: smaller pos).

    Step ``t`` keeps the remaining candidates with their running maximum
    similarity ``ms`` to the picks so far and takes the best ``mmr`` value.
    """
    cols = ["request_id", "item_id", "score", "pos", "author", "topic", "stock"]
    plain = ", ".join(cols)
    xcols = ", ".join("x." + c for c in cols)
    parts = [_SQL_BASE + f""",
c AS (SELECT m.request_id, m.item_id, m.score, m.merged_rank - 1 AS pos, it.author, it.topic, it.stock
      FROM merged m JOIN it USING (item_id)),
p1 AS (SELECT {plain} FROM c QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY score DESC, pos) = 1),
s2 AS (SELECT {xcols}, {sim.format(a='x', b='p1')} AS ms
       FROM c x JOIN p1 ON x.request_id = p1.request_id AND x.item_id <> p1.item_id)"""]
    for t in range(2, k + 1):
        parts.append(f""",
p{t} AS (SELECT {plain}, ms FROM s{t} QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY {mmr.format(ms='ms')} DESC, pos) = 1)""")
        if t < k:
            parts.append(f""",
s{t + 1} AS (SELECT {xcols}, greatest(x.ms, {sim.format(a='x', b=f'p{t}')}) AS ms
       FROM s{t} x JOIN p{t} ON x.request_id = p{t}.request_id AND x.item_id <> p{t}.item_id)""")
    parts.append("\n" + "\nUNION ALL ".join(f"SELECT request_id, item_id, {t} AS mmr_rank FROM p{t}"
                                            for t in range(1, k + 1)))
    return "".join(parts)


_K1_SIM = ("((CASE WHEN {a}.author = {b}.author THEN 1.0 ELSE 0.0 END) + "
           "(CASE WHEN {a}.topic = {b}.topic THEN 1.0 ELSE 0.0 END) + "
           "(CASE WHEN len(list_distinct(list_concat({a}.stock, {b}.stock))) > 0 THEN "
           "len(list_intersect({a}.stock, {b}.stock)) / len(list_distinct(list_concat({a}.stock, {b}.stock))) "
           "ELSE 0.0 END)) / 3")
_K2_SIM = ("((CASE WHEN {a}.author = {b}.author THEN 0.5 ELSE 0.0 END) + "
           "(CASE WHEN {a}.topic = {b}.topic THEN 0.5 ELSE 0.0 END))")


@register("K3_mmr_rerank_k3", _mmr_unrolled_sql(_K1_SIM, "0.5 * score - (1 - 0.5) * {ms}", 3))
def q_mmr_k3(spark, sf):
    c = merged_candidates(spark, sf)
    r = RR.mmr_rerank(c, k=3, lam=0.5, fields=["author", "topic", "stock"], mode="relevance")
    return r.select("request_id", "item_id", "mmr_rank")


@register("K4_mmr_diversity_k3", _mmr_unrolled_sql(_K2_SIM, "0.7 * (1.0 - {ms}) + (1 - 0.7) * score", 3))
def q_mmr_div_k3(spark, sf):
    c = merged_candidates(spark, sf)
    r = RR.mmr_rerank(c, k=3, lam=0.7, fields=["author", "topic"], mode="diversity")
    return r.select("request_id", "item_id", "mmr_rank")


register("K3_mmr_rerank", _mmr_unrolled_sql(_K1_SIM, "0.5 * score - (1 - 0.5) * {ms}", 5))(q_mmr)
register("K4_mmr_diversity", _mmr_unrolled_sql(_K2_SIM, "0.7 * (1.0 - {ms}) + (1 - 0.7) * score", 5))(q_mmr_div)
