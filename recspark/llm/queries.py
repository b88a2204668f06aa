"""Queries opN_<name> over the corpus tables, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import bpe, quality_model, toxicity
from recspark.llm.ann import nearest
from recspark.llm.common import crc, table, words
from recspark.llm.context_mixing import score_documents
from recspark.llm.hard_negatives import mine
from recspark.llm.jaccard_join import jaccard_join
from recspark.llm.license_scan import LICENSES, scan
from recspark.llm.mixture import mix, plan_mixture
from recspark.llm.periodic_runs import periodic_runs
from recspark.llm.quality_rules import quality_rules
from recspark.llm.sharding import shard_documents
from recspark.llm.url_filter import filter_urls, seed_urls

QUERIES = {}
SQL = {}


def _query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return keep


@_query("op10_shards")
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@_query("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return quality_rules(docs, drop_text=True).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_rate")


#: The url rules of the query: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"))


@_query("op1_url_filter")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return filter_urls(pages, seed_urls(spark), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "block_score")


def vocabulary() -> str:
    """Where the public vocabulary file lies; never copied."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@_query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary())


@_query("op9_ann")
def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


@_query("op6_quality_model")
def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality_model.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    held_out = F.coalesce(crc(F.col("doc_id")) % 5 == 0, F.lit(False))
    return quality_model.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text"))


def domain_of(source: Column) -> Column:
    """The tree's top level: sources are dealt to four domains by the number in their name."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]+)$", 1)
    return F.when(number == "", "none").otherwise(
        F.concat(F.lit("domain"), (F.substring(number, -9, 9).cast("int") % 4).cast("string")))


MIXTURE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'none'
              ELSE 'domain' || (CAST(right(regexp_extract(source, '([0-9]+)$', 1), 9) AS INT) % 4) END AS domain,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n
  FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(n) AS BIGINT) AS tokens FROM d GROUP BY ALL),
top AS (SELECT least(CAST(sum(tokens) * 4 AS DOUBLE), 0.7 * sum(tokens)) AS above FROM leaf),
n1 AS (SELECT domain, sum(tokens) * 4.0::DOUBLE AS cap, sqrt(CAST(sum(tokens) AS DOUBLE)) AS w, any_value(above) AS above
       FROM leaf, top GROUP BY domain HAVING sum(tokens) > 0),
l1 AS (SELECT *, (above - coalesce(sum(cap) OVER (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM n1),
b1 AS (SELECT domain, least(cap, w * max(lev) OVER ()) AS above FROM l1),
n2 AS (SELECT domain, lang, sum(tokens) * 4.0::DOUBLE AS cap, sqrt(CAST(sum(tokens) AS DOUBLE)) AS w
       FROM leaf GROUP BY domain, lang HAVING sum(tokens) > 0),
l2 AS (SELECT *, (above - coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
       FROM n2 JOIN b1 USING (domain)),
b2 AS (SELECT domain, lang, least(cap, w * max(lev) OVER (PARTITION BY domain)) AS above FROM l2),
n3 AS (SELECT domain, lang, source, tokens, tokens * 4.0::DOUBLE AS cap, sqrt(CAST(tokens AS DOUBLE)) AS w FROM leaf WHERE tokens > 0),
l3 AS (SELECT *, (above - coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
       FROM n3 JOIN b2 USING (domain, lang)),
b3 AS (SELECT domain, lang, source, tokens,
              CAST(floor(least(cap, w * max(lev) OVER (PARTITION BY domain, lang)) + 1e-6) AS BIGINT) AS budget FROM l3),
p AS (SELECT *, budget // tokens AS epochs, budget % tokens AS rest FROM b3),
x AS (SELECT d.*, epochs, rest, sum(n) OVER (PARTITION BY domain, lang, source
             ORDER BY md5('7:' || (epochs + 1) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), CAST(doc_id AS VARCHAR), n
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ends
      FROM d JOIN p USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n AS n_tokens, CAST(unnest(range(1, 1 + epochs + CASE WHEN rest > 0 AND ends <= rest THEN 1 ELSE 0 END)) AS INT) AS epoch
FROM x
"""


@_query("op8_mixture", MIXTURE_SQL)
def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    docs = docs.withColumn("domain", domain_of(F.col("source")))
    taken = mix(docs, plan_mixture(docs))
    return taken.select("doc_id", "domain", F.coalesce("lang", F.lit("")).alias("lang"),
                        F.coalesce("source", F.lit("")).alias("source"),
                        F.size(words(F.col("text"))).cast("long").alias("n_tokens"), "epoch")


@_query("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"), LICENSES)


@_query("op2_context_mixing")
def op2_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


HARD_NEGATIVES_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE own = label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own
     AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""


@_query("op11_hard_negatives", HARD_NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", moved)
    return mine(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


@_query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    held_out = F.coalesce(crc(F.col("doc_id")) % 5 == 0, F.lit(False))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """Texts of one id in ten made periodic: from word ``a`` on, the next ``p`` words come again to the text's end.

    With h the crc32 of the id and g = h // 10: h is a multiple of 10, a = g mod n
    and p = 1 + (n - a) // (3 + g mod 8), for n words.  Other texts stay.
    """
    h = crc(F.col("doc_id"))
    chosen = F.coalesce((h % 10 == 0) & F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    some = (docs.filter(chosen).withColumn("__w", words(F.col("text"))).withColumn("__g", F.floor(h / 10))
            .withColumn("__n", F.size("__w")))
    some = some.withColumn("__a", F.pmod("__g", "__n").cast("int"))
    some = some.withColumn("__p", 1 + F.floor((F.col("__n") - F.col("__a")) / (3 + F.col("__g") % 8)).cast("int"))
    whole = F.expr("slice(concat(slice(__w, 1, __a), flatten(array_repeat(slice(__w, __a + 1, __p), "
                   "cast(1 + (__n - __a) div __p as int)))), 1, __n)")
    return some.withColumn("text", F.concat_ws(" ", whole)).select(docs.columns).unionByName(docs.filter(~chosen))


@_query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents", "doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    all_lines = F.concat(F.concat_ws("\n", lines), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(all_lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
