"""Operator 9: approximate nearest neighbours by cross-polytope hashing.

A table of the index rotates the unit vectors by three rounds of random signs
and a fast Hadamard transform, and puts each vector into the bucket of the
nearest signed axis (``2 * d`` buckets for ``d`` dimensions, to the power of
``hashes`` when several are joined).  A query looks into the ``probes`` buckets
whose axes are nearest to it, in every table, and the candidates found there
are ranked by their exact cosine in double precision.

Equal vectors are one entry with their ``k + 1`` smallest ids, so copies fill
no bucket.  Buckets and their queries are cut into blocks of ``block`` rows;
each pair of blocks is one task's matrix product that keeps ``k + 1`` rows for
each query.  On vectors without structure, recall is bought by the number of
tables and probes alone; ``recall`` measures it against brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.common import stored

TABLES, PROBES, HASHES = 10, 6, 1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows (a power of two long), norm kept."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def axes(x: np.ndarray, seed: int) -> np.ndarray:
    """Nearness of each row to the ``2 * d`` signed axes after a pseudo-rotation."""
    n, d = x.shape
    wide = 1 << max(1, (d - 1).bit_length())
    y = np.zeros((n, wide))
    y[:, :d] = x
    rng = np.random.default_rng([seed, d])
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], wide))
    return np.concatenate([y, -y], 1)


def probe(x: np.ndarray, table: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """The ``probes`` best buckets of each unit vector in one table, best first."""
    best, code = None, None
    for h in range(hashes):
        a = axes(x, seed * 1_000_003 + table * 1009 + h)
        m = min(probes, a.shape[1])
        near = np.argsort(-a, axis=1, kind="stable")[:, :m]
        score = np.take_along_axis(a, near, 1)
        if best is None:
            best, code = score, near.astype(np.int64)
        else:  # the best pairs of the buckets so far with the new axes
            both = (best[:, :, None] + score[:, None, :]).reshape(len(x), -1)
            codes = (code[:, :, None] * a.shape[1] + near[:, None, :]).reshape(len(x), -1)
            keep = np.argsort(-both, axis=1, kind="stable")[:, :probes]
            best, code = np.take_along_axis(both, keep, 1), np.take_along_axis(codes, keep, 1)
    return code


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _buckets(df: DataFrame, tables: int, hashes: int, probes: int, seed: int) -> DataFrame:
    """Each row once for every table and probed bucket: columns ``dim``, ``tab``, ``bucket`` and the row's own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                dims = np.asarray(b["dim"])
                for d in np.unique(dims):
                    part = b.take(pa.array(np.flatnonzero(dims == d)))
                    x = _unit(_matrix(part["v"], part.num_rows))
                    for t in range(tables):
                        code = probe(x, t, hashes, probes, seed)
                        rows = np.repeat(np.arange(part.num_rows), code.shape[1])
                        out = part.take(pa.array(rows))
                        yield pa.record_batch([pa.array(np.full(len(rows), t, np.int32)), pa.array(code.ravel()),
                                               *out.columns], ["tab", "bucket", *out.schema.names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"tab int, bucket long, {kinds}")


def _search(points: DataFrame, asks: DataFrame, tables: int, hashes: int, probes: int, seed: int, k: int,
            block: int) -> DataFrame:
    """``qkey, vec_id, score``: the best ``k`` of each query in every pair of blocks."""
    index = _buckets(points, tables, hashes, 1, seed)
    probed = _buckets(asks, tables, hashes, probes, seed)
    at = ["dim", "tab", "bucket"]
    blocks = (index.groupBy(at).count().withColumnRenamed("count", "np")
              .join(probed.groupBy(at).count().withColumnRenamed("count", "nq"), at)
              .select(*at, F.ceil(F.col("np") / block).cast("int").alias("pb"),
                      F.ceil(F.col("nq") / block).cast("int").alias("qb")))
    blocks = stored(blocks, "ann-blocks")
    cut = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = (index.join(blocks, at).withColumn("i", cut("v", "pb"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("qb") - 1))))
    right = (probed.join(blocks, at).withColumn("j", cut("qkey", "qb"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("pb") - 1))))

    def rank(points: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"qkey": [], "vec_id": [], "score": []}
        if points.num_rows and asked.num_rows:
            p, q = _matrix(points["v"], points.num_rows), _matrix(asked["v"], asked.num_rows)
            ids, keys = points["ids"].to_pylist(), asked["qkey"].to_pylist()
            pn, qn = np.sqrt((p * p).sum(1)), np.sqrt((q * q).sum(1))
            near = (q / qn[:, None]) @ (p / pn[:, None]).T
            cut = np.partition(near, -min(k, len(p)), axis=1)[:, -min(k, len(p))] - 1e-9
            for r in range(len(q)):
                who = np.flatnonzero(near[r] >= cut[r])
                exact = (p[who] * q[r]).sum(1) / (pn[who] * qn[r])  # a pair's value doesn't depend on its block
                found = sorted((-s, i) for w, s in zip(who, exact, strict=True) for i in ids[w])[:k]
                out["qkey"] += [keys[r]] * len(found)
                out["vec_id"] += [i for _, i in found]
                out["score"] += [-s for s, _ in found]
        return pa.table({"qkey": pa.array(out["qkey"], pa.string()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    key = [*at, "i", "j"]
    pairs = (left.select(*key, "ids", "v").groupBy(key).cogroup(right.select(*key, "qkey", "v").groupBy(key)))
    return pairs.applyInArrow(rank, "qkey string, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("qkey", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("at", F.row_number().over(w)).filter(F.col("at") <= k).drop("at"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            tables: int = TABLES, probes: int = PROBES, hashes: int = HASHES, block: int = 4096,
            seed: int = 17) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its ``k`` nearest found in ``vectors``.

    A query's own id is no candidate; ties go to the smaller id.  Vectors that
    are null, zero, or hold null or non-finite components, and rows without id,
    take no part; vectors of different lengths are never neighbours.  Rows that
    repeat an id and its vector count once.  Queries for which the probed
    buckets held fewer than ``k`` candidates look into all buckets.  Other
    columns are not carried.
    """
    def clean(df: DataFrame) -> DataFrame:
        v = F.col(vector_col)
        good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (df.filter(F.col(id_col).isNotNull() & good & F.exists(v, lambda x: x != 0))
                .select(F.col(id_col).cast("long").alias("id"), v.alias("v")))

    w = Window.partitionBy("v").orderBy("id")
    points = (clean(vectors).distinct().withColumn("at", F.row_number().over(w)).filter(F.col("at") <= k + 1)
              .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    points = stored(points.select(F.size("v").alias("dim"), "ids", "v"), "ann-points")
    key = F.concat_ws(":", F.xxhash64("v"), F.xxhash64(F.reverse("v")))
    rows = stored(clean(queries).distinct().withColumn("qkey", key), "ann-queries")
    asks = rows.groupBy("v").agg(F.first("qkey").alias("qkey")).select(F.size("v").alias("dim"), "qkey", "v")
    found = stored(_best(_search(points, asks, tables, hashes, probes, seed, k + 1, block), k + 1), "ann-found")

    counts = found.groupBy("qkey").count()
    short = asks.join(counts, "qkey", "left").filter(F.coalesce("count", F.lit(0)) < k + 1).drop("count")
    if not short.isEmpty():
        every = 1 << 62
        more = _best(_search(points, stored(short, "ann-short"), 1, 1, every, seed, k + 1, block), k + 1)
        found = _best(found.unionByName(more), k + 1)
    own = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    out = rows.select(F.col("id").alias("query_id"), "qkey").join(found, "qkey").filter("vec_id <> query_id")
    return (out.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
