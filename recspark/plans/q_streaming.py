"""Streaming queries (S6, ST1-ST4, N7) replaying ``events`` as a file stream.

The events table is staged as three time ranges (1-14 Jan, 15-24 Jan, 25 Jan
on), each replayed as one micro-batch.  Results of stateless and ``complete`` jobs equal
the batch results, so they carry a DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.functions.scalars import sigmoid
from recspark.operators import transformers as TR
from recspark.plans.catalog import register
from recspark.plans.pipeline import FeaturePipeline
from recspark.session import read_table
from recspark.streaming import streams as ST

BOUNDS = ["2024-01-15 00:00:00", "2024-01-25 00:00:00"]


def _events(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.withColumn("y", (F.col("event_type") == "purchase").cast("int")).withColumn(
        "p", sigmoid(F.col("value") / 10 - 2))


def _stream(spark, sf, order=None):
    ev = _events(spark, sf)
    root, _, per_batch = ST.stage_event_files(ev, "ts", BOUNDS, order)
    return ST.read_file_stream(spark, root, ev.schema, files_per_trigger=per_batch)


@register("ST1_stream_pipeline", """
SELECT event_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS BIGINT) AS event_type_encoded,
       CAST(hour(ts) AS BIGINT) AS hour, CAST(isodow(ts) AS BIGINT) AS dayofweek,
       round(CASE WHEN value >= 0 THEN ln(1 + value) ELSE 0 END, 6) AS value_log
FROM events""")
def q_st1(spark, sf):
    batch = _events(spark, sf)
    model = FeaturePipeline([
        TR.TimeFeatureExtractor([TR.TimeSpec("ts", "hour", "timestamp", "hour"),
                                 TR.TimeSpec("ts", "dayofweek", "timestamp", "dayofweek")]),
        TR.LogTransformer([("value", "value_log")]),
        TR.CategoricalEncoder(["event_type"])]).fit(batch)
    out = ST.stream_transform(model, _stream(spark, sf)).select(
        "event_id", "event_type_encoded", "hour", "dayofweek", F.round("value_log", 6).alias("value_log"))
    return ST.run_to_table(out, "append")


@register("ST2_windowed_counts", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, count(*) AS n, round(avg(value), 6) AS avg_value
FROM events GROUP BY 1, 2, 3""")
def q_st2(spark, sf):
    agg = ST.windowed_counts(_stream(spark, sf), "ts", ["event_type"], "1 day", value="value")
    res = ST.run_to_table(agg, "complete")
    return res.select(*ST.window_bounds(), "event_type", "n", F.round("avg_value", 6).alias("avg_value"))


@register("ST2_sliding_counts", """
WITH w AS (SELECT event_type, date_trunc('day', ts) - INTERVAL 1 DAY * k AS ws FROM events, (SELECT unnest([0, 1]) AS k))
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(ws + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, count(*) AS n FROM w GROUP BY 1, 2, 3""")
def q_st2_sliding(spark, sf):
    agg = ST.windowed_counts(_stream(spark, sf), "ts", ["event_type"], "2 days", "1 day")
    res = ST.run_to_table(agg, "complete")
    return res.select(*ST.window_bounds(), "event_type", "n")


@register("ST3_windowed_metrics", """
WITH e AS (SELECT ts, CAST(event_type = 'purchase' AS INTEGER) AS y, 1 / (1 + exp(-(value / 10 - 2))) AS p FROM events)
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS n,
       round(avg(CAST((CAST(p > 0.5 AS INTEGER) = y) AS DOUBLE)), 6) AS accuracy,
       round(avg(-(y * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))), 6) AS logloss
FROM e GROUP BY 1, 2""")
def q_st3(spark, sf):
    agg = ST.windowed_metrics(_stream(spark, sf), "ts", "y", "p", "1 day")
    res = ST.run_to_table(agg, "complete")
    return res.select(*ST.window_bounds(), "n", F.round("accuracy", 6).alias("accuracy"),
                      F.round("logloss", 6).alias("logloss"))


@register("ST4_late_rows_update", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, count(*) AS n
FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2, 3""")
def q_st4(spark, sf):
    # the earliest range arrives last: its rows are behind the watermark and dropped
    agg = ST.windowed_counts(_stream(spark, sf, order=[1, 2, 0]), "ts", ["event_type"], "1 day")
    res = ST.run_to_table(agg, "update", keys=["window", "event_type"])
    return res.select(*ST.window_bounds(), "event_type", "n")


@register("N7_S6_running_metrics", """
WITH e AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 WHEN ts < TIMESTAMP '2024-01-25' THEN 1 ELSE 2 END AS batch,
                  CAST(event_type = 'purchase' AS DOUBLE) AS y,
                  least(greatest(1 / (1 + exp(-(value / 10 - 2))), 1e-15), 1 - 1e-15) AS p FROM events),
b AS (SELECT batch, count(*) AS rows, sum(CAST((CAST(p > 0.5 AS DOUBLE) = y) AS DOUBLE)) AS correct,
             sum(-(y * ln(p) + (1 - y) * ln(1 - p))) AS ll FROM e GROUP BY batch),
r AS (SELECT batch, y, (2 * rank() OVER (PARTITION BY batch ORDER BY p) + count(*) OVER (PARTITION BY batch, p) - 1) / 2.0 AS rk FROM e),
a AS (SELECT batch, CASE WHEN sum(y) > 0 AND count(*) - sum(y) > 0
                         THEN (sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))
                         ELSE 0.0 END AS auc FROM r GROUP BY batch)
SELECT CAST(batch AS BIGINT) AS batch, rows, round(a.auc, 6) AS auc, round(correct / rows, 6) AS accuracy, round(ll / rows, 6) AS logloss,
       round(sum(correct) OVER w / sum(rows) OVER w, 6) AS running_accuracy,
       round(sum(ll) OVER w / sum(rows) OVER w, 6) AS running_logloss
FROM b JOIN a USING (batch) WINDOW w AS (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_n7(spark, sf):
    r = ST.running_metrics(_stream(spark, sf), "y", "p")
    return r.select("batch", "rows", *[F.round(c, 6).alias(c) for c in
                                       ("auc", "accuracy", "logloss", "running_accuracy", "running_logloss")])


@register("N7_running_auc", """
WITH e AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 WHEN ts < TIMESTAMP '2024-01-25' THEN 1 ELSE 2 END AS batch,
                  CAST(event_type = 'purchase' AS INTEGER) AS y, 1 / (1 + exp(-(value / 10 - 2))) AS p FROM events),
s AS (SELECT b.batch, e.y, least(floor(e.p * 4096), 4095) AS bin FROM (SELECT DISTINCT batch FROM e) b JOIN e ON e.batch <= b.batch),
r AS (SELECT batch, y, (2 * rank() OVER (PARTITION BY batch ORDER BY bin) + count(*) OVER (PARTITION BY batch, bin) - 1) / 2.0 AS rk FROM s)
SELECT CAST(batch AS BIGINT) AS batch, count(*) AS rows,
       round((sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 6) AS running_auc
FROM r GROUP BY batch""")
def q_running_auc(spark, sf):
    r = ST.running_auc(_stream(spark, sf), "y", "p")
    return r.select("batch", "rows", F.round("running_auc", 6).alias("running_auc"))
