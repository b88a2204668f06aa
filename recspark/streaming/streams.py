"""Structured Streaming jobs (S6, ST1-ST4, N7).

* ``stage_event_files`` writes a table as parquet files per time range under
  the shared checkpoint folder so a file stream can replay the ranges in
  order, one range per micro-batch - the stand-in for a landing folder.
* ``stream_transform`` (ST1) applies a fitted pipeline model to a stream: the
  model's ``transform`` is lazy column work, the same code as batch.
* ``windowed_counts`` (ST2) / ``windowed_metrics`` (ST3): ``withWatermark`` +
  tumbling or sliding ``window`` aggregates.
* ``run_to_table`` runs a stream with ``availableNow`` into a parquet folder
  via ``foreachBatch`` (``complete``: last batch wins; ``update``: the last
  version of each key wins; ``append``: rows as emitted), then returns the
  batch read of that folder.  Checkpoints live under ``spark.checkpoint.dir``,
  so a restarted driver resumes where it stopped.
* ``running_metrics`` (N7): accuracy / log loss per micro-batch and running.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recspark.operators.metrics import accuracy_expr, auc, logloss_expr
from recspark.session import ensure_checkpoint_dir


FILE_ROWS = 1_000_000


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/recspark-{name}-{uuid.uuid4().hex[:10]}"


def stage_event_files(df: DataFrame, ts: str, bounds: list, order: list[int] | None = None,
                      files_per_range: int | None = None) -> tuple[str, list[str], int]:
    """Write ``df`` split at the timestamp ``bounds``, one folder per range.

    Every range is written as the same number ``P`` of files by a round-robin
    ``repartition(P)`` (work spread over ``P`` tasks, no single-task funnel);
    ``P`` is the default parallelism, or as many as leave the largest range
    about ``FILE_ROWS`` rows a file.  A range with rows for fewer files is
    filled up with files without rows, so it takes no parallelism from the
    others.  Reading ``P`` files per trigger then makes each micro-batch
    exactly one range.  Returns the source folder, the range folders in replay
    order (``order`` permutes the ranges, e.g. to make the first range arrive
    late) and ``P``.
    """
    spark = df.sparkSession
    root = _scratch(spark, "landing")
    edges = [None, *bounds, None]
    parts = []
    for i in range(len(edges) - 1):
        cond = F.lit(True)
        if edges[i] is not None:
            cond = cond & (F.col(ts) >= F.lit(edges[i]).cast("timestamp"))
        if edges[i + 1] is not None:
            cond = cond & (F.col(ts) < F.lit(edges[i + 1]).cast("timestamp"))
        parts.append(df.where(cond))
    counts = [p.count() for p in parts]
    untimed = df.where(F.col(ts).isNull())
    if n_untimed := untimed.count():  # rows without a time: a range of their own, replayed last
        parts.append(untimed)
        counts.append(n_untimed)
        order = [*order, len(parts) - 1] if order else None
    n = files_per_range or max(spark.sparkContext.defaultParallelism, math.ceil(max(counts) / FILE_ROWS))
    n = max(1, min(n, max(counts)))
    seq = order or list(range(len(parts)))
    folders = []
    for k, i in enumerate(seq):
        folder = f"{root}/batch={k:04d}"
        parts[i].repartition(n).write.mode("overwrite").parquet(folder)
        for _ in range(n - len(spark.read.schema(df.schema).parquet(folder).inputFiles())):
            df.limit(0).coalesce(1).write.mode("append").parquet(folder)
        folders.append(folder)
    return root, folders, n


def read_file_stream(spark: SparkSession, root: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Incremental read, ``files_per_trigger`` files per micro-batch (chunked reading)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", "true").parquet(root))


def stream_transform(model, stream: DataFrame) -> DataFrame:
    """ST1: the fitted batch model applied to a stream, unchanged."""
    return model.transform(stream)


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], window: str, slide: str | None = None,
                    watermark: str = "1 day", value: str | None = None) -> DataFrame:
    """ST2: counts (and mean of ``value``) per window and key."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.avg(value).alias("avg_value"))
    return stream.withWatermark(ts, watermark).groupBy(w.alias("window"), *keys).agg(*aggs)


def windowed_metrics(stream: DataFrame, ts: str, label: str, pred: str, window: str,
                     watermark: str = "1 day") -> DataFrame:
    """ST3: accuracy and log loss per tumbling window."""
    return (stream.withWatermark(ts, watermark).groupBy(F.window(ts, window).alias("window"))
            .agg(F.count(F.lit(1)).alias("n"), accuracy_expr(label, pred).alias("accuracy"),
                 logloss_expr(label, pred).alias("logloss")))


def run_to_table(agg: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Run ``agg`` to completion (``availableNow``) and return its final result.

    ``keys``: the grouping columns (needed for ``update`` to keep each key's
    last version).
    """
    spark = agg.sparkSession
    out, ckpt = _scratch(spark, "sink"), _scratch(spark, "ckpt")

    written = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        # idempotent: a retried micro-batch overwrites its own folder (foreachBatch is at-least-once)
        written.append(batch_id)
        if mode == "complete":
            batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(out)
        else:
            batch.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")

    q = (agg.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if not written:  # the source was empty: no micro-batch ran
        return spark.createDataFrame([], agg.schema)
    res = spark.read.parquet(out)
    if mode == "update" and keys:
        w = Window.partitionBy(*keys).orderBy(F.col("_batch").cast("long").desc())
        res = res.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")
    return res.drop("_batch")


def running_metrics(stream: DataFrame, label: str, pred: str) -> DataFrame:
    """Per micro-batch ``(batch, rows, auc, accuracy, logloss)`` plus
    running accuracy / log loss; the stream is consumed with ``availableNow``."""
    spark = stream.sparkSession
    out, ckpt = _scratch(spark, "metrics"), _scratch(spark, "ckpt")
    p = F.least(F.greatest(F.col(pred).cast("double"), F.lit(1e-15)), F.lit(1 - 1e-15))
    y = (F.col(label).cast("double") == 1.0).cast("double")

    def sink(batch: DataFrame, batch_id: int) -> None:
        # one folder per micro-batch, overwritten on retry (idempotent); the
        # batch is static here, so its AUC is the batch job (ST3's AUC part)
        stats = batch.agg(F.count(F.lit(1)).alias("rows"),
                          F.sum(((F.col(pred) > 0.5).cast("double") == y).cast("double")).alias("correct"),
                          F.sum(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("ll_sum"))
        a = auc(batch, label, pred).select("auc")
        stats.withColumn("_k", F.lit(0)).join(F.broadcast(a.withColumn("_k", F.lit(0))), "_k").drop("_k") \
            .write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    per = spark.read.parquet(out).withColumn("batch", F.col("batch").cast("long"))
    run = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)  # one row per batch: tiny
    return per.select("batch", "rows", "auc", (F.col("correct") / F.col("rows")).alias("accuracy"),
                      (F.col("ll_sum") / F.col("rows")).alias("logloss"),
                      (F.sum("correct").over(run) / F.sum("rows").over(run)).alias("running_accuracy"),
                      (F.sum("ll_sum").over(run) / F.sum("rows").over(run)).alias("running_logloss"))


def running_auc(stream: DataFrame, label: str, score: str, bins: int = 4096, out: str | None = None,
                checkpoint: str | None = None) -> DataFrame:
    """``(batch, rows, running_auc)``, the AUC of everything seen up to each micro-batch.

    The state is a histogram of the scores (in [0, 1], cut into ``bins``), with
    the positives and negatives of each bin: mergeable, of fixed size, and kept
    by the engine's own state store, so a restart with the same ``checkpoint``
    and ``out`` goes on where it stopped.  Scores of one bin are ties (their
    average rank), so the result is the exact AUC of the binned scores, within
    one bin's width of the unbinned one.  Rows without label or score are left
    out; one class alone gives 0.
    """
    spark = stream.sparkSession
    out, checkpoint = out or _scratch(spark, "auc"), checkpoint or _scratch(spark, "ckpt")
    clean = stream.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    at = F.least(F.floor(F.greatest(F.col(score).cast("double"), F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")
    state = clean.groupBy(at.alias("bin")).agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"),
                                               F.sum((F.col(label) != 1).cast("long")).alias("neg"))

    def sink(histogram: DataFrame, batch_id: int) -> None:
        below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # at most ``bins`` rows
        ranked = histogram.withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
        total = ranked.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"),
                           F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("won"))
        area = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("won") / (F.col("p").cast("double") * F.col("n"))).otherwise(0.0)
        total.select((F.col("p") + F.col("n")).alias("rows"), area.alias("running_auc")) \
            .write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (state.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out).select(F.col("batch").cast("long").alias("batch"), "rows", "running_auc")


def window_bounds(col: Column | None = None) -> list[Column]:
    col = F.col("window") if col is None else col
    return [F.date_format(col["start"], "yyyy-MM-dd HH:mm:ss").alias("window_start"),
            F.date_format(col["end"], "yyyy-MM-dd HH:mm:ss").alias("window_end")]
