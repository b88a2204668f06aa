"""Metric queries (N1-N6, N8) over ``events``, ``labels``/``documents`` and ``embeddings``.

Label: ``event_type = 'purchase'``; score: ``value`` (model) and the ``k``
field of ``props`` (baseline).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.functions.scalars import sigmoid
from recspark.operators import metrics as M
from recspark.operators.vectors import mean_pool
from recspark.plans.catalog import register
from recspark.session import read_table


def _events(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", "user_id", (F.col("event_type") == "purchase").cast("int").alias("y"),
                     F.col("value").alias("score"),
                     F.get_json_object("props", "$.k").cast("double").alias("base_score"),
                     sigmoid(F.col("value") / 10 - 2).alias("p"))


_AUC_CTE = """
ev AS (SELECT user_id, CAST(event_type = 'purchase' AS INTEGER) AS y, value AS s,
              CAST(json_extract_string(props, '$.k') AS DOUBLE) AS bs,
              1 / (1 + exp(-(value / 10 - 2))) AS p FROM events)"""


def _auc_sql(score: str, part: str = "", r: str = "r", a: str = "a") -> str:
    """Rank-sum AUC with tied scores sharing their average rank."""
    pb = f"PARTITION BY {part}" if part else ""
    tie = f"PARTITION BY {part}, {score}" if part else f"PARTITION BY {score}"
    grp = f"{part}, " if part else ""
    gb = f"GROUP BY {part}" if part else ""
    return f"""
{r} AS (SELECT {grp}y, (2 * rank() OVER ({pb} ORDER BY {score}) + count(*) OVER ({tie}) - 1) / 2.0 AS rk FROM ev),
{a} AS (SELECT {grp}count(*) AS n, sum(y) AS pos, count(*) - sum(y) AS neg,
          CASE WHEN sum(y) > 0 AND count(*) - sum(y) > 0
               THEN (sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
                    / (sum(y) * (count(*) - sum(y))) ELSE 0.0 END AS auc
        FROM {r} {gb})"""


@register("N1_auc", "WITH" + _AUC_CTE + "," + _auc_sql("s") +
          "\nSELECT CAST(n AS BIGINT) AS n, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, round(auc, 6) AS auc FROM a")
def q_auc(spark, sf):
    a = M.auc(_events(spark, sf), "y", "score")
    return a.select(F.col("n").cast("long"), F.col("pos").cast("long"), F.col("neg").cast("long"),
                    F.round("auc", 6).alias("auc"))


@register("N2_group_auc", "WITH" + _AUC_CTE + "," + _auc_sql("s", "user_id") +
          "\nSELECT user_id, CAST(n AS BIGINT) AS n, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, "
          "round(auc, 6) AS auc FROM a")
def q_group_auc(spark, sf):
    t = M.auc_table(_events(spark, sf), "y", "score", ["user_id"])
    return t.select("user_id", F.col("n").cast("long"), F.col("pos").cast("long"), F.col("neg").cast("long"),
                    F.round("auc", 6).alias("auc"))


@register("N2_gauc", "WITH" + _AUC_CTE + "," + _auc_sql("s", "user_id") + """
SELECT round(sum(auc * n) / count(*) / sum(n), 6) AS gauc_reference,
       round(sum(auc * n) / sum(n), 6) AS gauc_weighted,
       round(sum(CASE WHEN pos > 0 AND neg > 0 THEN auc * n END) / sum(CASE WHEN pos > 0 AND neg > 0 THEN n END), 6) AS gauc_standard,
       count(*) AS groups, CAST(sum(CASE WHEN pos > 0 AND neg > 0 THEN 1 ELSE 0 END) AS BIGINT) AS groups_both_classes
FROM a""")
def q_gauc(spark, sf):
    g = M.gauc(_events(spark, sf), "y", "score", "user_id")
    return g.select(*[F.round(c, 6).alias(c) for c in ("gauc_reference", "gauc_weighted", "gauc_standard")],
                    F.col("groups").cast("long"), F.col("groups_both_classes").cast("long"))


@register("N3_N4_classification", "WITH" + _AUC_CTE + "," + _auc_sql("p") + """
SELECT round(avg(CAST((CAST(p > 0.5 AS INTEGER) = y) AS DOUBLE)), 6) AS accuracy,
       round(avg(-(y * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))), 6) AS logloss,
       count(*) AS rows, round((SELECT auc FROM a), 6) AS auc
FROM ev""")
def q_cls(spark, sf):
    m = M.classification_metrics(_events(spark, sf), "y", "p")
    return m.select(F.round("accuracy", 6).alias("accuracy"), F.round("logloss", 6).alias("logloss"),
                    F.col("rows").cast("long"), F.round("auc", 6).alias("auc"))


@register("N8_rela_impr", "WITH" + _AUC_CTE + "," + _auc_sql("s") + "," + _auc_sql("bs", r="rb", a="ab") + """
SELECT round(a.auc, 6) AS auc_model, round(ab.auc, 6) AS auc_base,
       round((a.auc - 0.5) / (ab.auc - 0.5) - 1, 6) AS rela_impr FROM a, ab""")
def q_rela(spark, sf):
    j = M.rela_impr_table(_events(spark, sf), "y", "score", "base_score")
    return j.select(F.round("auc_model", 6).alias("auc_model"), F.round("auc_base", 6).alias("auc_base"),
                    F.round(M.rela_impr(F.col("auc_model"), F.col("auc_base")), 6).alias("rela_impr"))


@register("N5_multi_task", """
WITH d AS (SELECT l.quality, l.toxic,
                  1 / (1 + exp(-(ln(d.n_chars + 1) - 7))) AS p_quality,
                  1 / (1 + exp(-(length(d.text) % 97 / 97.0 * 4 - 2))) AS p_toxic
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
t AS (SELECT 'quality' AS task, quality AS y, p_quality AS p FROM d
      UNION ALL SELECT 'toxic', toxic, p_toxic FROM d),
r AS (SELECT task, y, p, (rank() OVER (PARTITION BY task ORDER BY p) * 2 + count(*) OVER (PARTITION BY task, p) - 1) / 2.0 AS rk FROM t)
SELECT task, count(*) AS rows,
  round(CASE WHEN sum(y) > 0 AND count(*) - sum(y) > 0 THEN (sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) ELSE 0 END, 6) AS auc,
  round(avg(CAST((CAST(p > 0.5 AS INTEGER) = y) AS DOUBLE)), 6) AS accuracy,
  round(avg(-(y * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))), 6) AS logloss
FROM r GROUP BY task""")
def q_multitask(spark, sf):
    lab = read_table(spark, sf, "labels")
    docs = read_table(spark, sf, "documents", ["doc_id", "n_chars", "text"])
    d = lab.join(docs, "doc_id").select(
        "quality", "toxic", sigmoid(F.log(F.col("n_chars") + 1) - 7).alias("p_quality"),
        sigmoid(F.pmod(F.length("text"), F.lit(97)) / 97.0 * 4 - 2).alias("p_toxic"))
    m = M.multi_task_metrics(d, {"quality": ("quality", "p_quality"), "toxic": ("toxic", "p_toxic")})
    return m.select("task", F.col("rows").cast("long"), *[F.round(c, 6).alias(c) for c in ("auc", "accuracy", "logloss")])


@register("N6_matryoshka_ce", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT vec_id, label, unnest(range(1, 65)) AS i, unnest(v) AS x FROM e),
m AS (SELECT label AS k, i, avg(x) AS m FROM x GROUP BY label, i),
z AS (SELECT d, vec_id, label, k, sum(x * m) AS z
      FROM x JOIN m USING (i) JOIN (SELECT unnest([8, 16, 32, 64]) AS d) ON i <= d GROUP BY ALL),
c AS (SELECT d, avg(ce) AS ce FROM (
        SELECT d, vec_id, ln(sum(exp(z))) - max(CASE WHEN k = label THEN z END) AS ce FROM z GROUP BY d, vec_id) GROUP BY d)
SELECT round(max(CASE WHEN d = 8 THEN ce END), 6) AS ce_8, round(max(CASE WHEN d = 16 THEN ce END), 6) AS ce_16,
       round(max(CASE WHEN d = 32 THEN ce END), 6) AS ce_32, round(max(CASE WHEN d = 64 THEN ce END), 6) AS ce_64,
       round(sum(ce * CASE d WHEN 8 THEN 1.0 WHEN 16 THEN 0.5 WHEN 32 THEN 0.25 ELSE 0.125 END), 6) AS loss
FROM c""")
def q_mrl(spark, sf):
    """Class scores of each prefix: its dot product with the same prefix of every label's mean vector."""
    e = read_table(spark, sf, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("v"))
    means = mean_pool(e, "label", "v", "m").agg(
        F.array_sort(F.collect_list(F.struct("label", "m"))).alias("means"))  # one vector for each of ten labels
    e = e.withColumn("means", means.scalar())
    dims = [8, 16, 32, 64]

    def scores(d):
        return F.transform("means", lambda s: F.aggregate(
            F.zip_with(F.slice("v", 1, d), F.slice(s["m"], 1, d), lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x))
    e = e.select("label", *[scores(d).alias(f"z{d}") for d in dims])
    out = M.matryoshka_cross_entropy(e, {d: f"z{d}" for d in dims}, "label",
                                     {8: 1.0, 16: 0.5, 32: 0.25, 64: 0.125})
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@register("N1_auc_stable_ties", """
WITH e AS (SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS y, round(value) AS s FROM events),
r AS (SELECT y, row_number() OVER (ORDER BY s, event_id) AS rk FROM e)
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg,
       round((sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 6) AS auc
FROM r""")
def q_auc_stable(spark, sf):
    """N1 with L18's stable-order ties: scores rounded to whole units (many ties), ties ranked by event id."""
    ev = read_table(spark, sf, "events").select("event_id", (F.col("event_type") == "purchase").cast("int").alias("y"),
                                                 F.round("value").alias("s"))
    a = M.auc(ev, "y", "s", ties="order", order="event_id")
    return a.select(F.col("n").cast("long"), F.col("pos").cast("long"), F.col("neg").cast("long"),
                    F.round("auc", 6).alias("auc"))
