"""Two-tower input features.

User side: the user's ``max_len`` most recent items (oldest first), their
hashed indices and the mean of their vectors.  Item side: hashed title-token
indices and the mean of the token vectors.  Vectors come from an id -> vector
table (J8).  The recent-items list is a top-``max_len`` per user
(``row_number`` filter -> ``WindowGroupLimit``, trimmed map-side), so a hot
user never ships its whole history to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.hashing import list_hash
from recspark.operators.joins import embedding_lookup


def recent_items(log: DataFrame, user: str, item: str, order: list[Column], max_len: int,
                 out: str = "recent_clicks") -> DataFrame:
    """``(user, out)``: the last ``max_len`` items per user, oldest first."""
    w = Window.partitionBy(user).orderBy(*[o.desc() for o in order])
    last = log.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_len)
    return last.groupBy(user).agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_r")).alias("k"), F.col(item).alias("v")))),
                    lambda s: s["v"]).alias(out))


def user_tower(users: DataFrame, log: DataFrame, user: str, item: str, order: list[Column], max_len: int,
               table: DataFrame, n_buckets: int, method: str = "md5") -> DataFrame:
    """R10 user side: ``recent_clicks``, ``click_idx`` and pooled ``click_vec``."""
    rec = recent_items(log, user, item, order, max_len)
    u = users.join(rec, user, "left").withColumn(
        "recent_clicks", F.coalesce("recent_clicks", F.array().cast(rec.schema["recent_clicks"].dataType)))
    u = u.withColumn("click_idx", list_hash(F.col("recent_clicks"), n_buckets, method))
    return embedding_lookup(u, user, "click_idx", table, "click_vec", pool="mean")


def item_tower(items: DataFrame, key: str, tokens: str, table: DataFrame, n_buckets: int,
               method: str = "md5") -> DataFrame:
    """R10 item side: ``title_idx`` and pooled ``title_vec`` of the title tokens."""
    it = items.withColumn("title_idx", list_hash(F.col(tokens), n_buckets, method))
    return embedding_lookup(it, key, "title_idx", table, "title_vec", pool="mean")
