"""Residual-quantised semantic IDs (M1-M5).

A codebook is a small table ``(layer, code, vec)`` of ``layers x K`` rows -
bounded by its parameters, not by the data - and is the only thing that
reaches the driver.  Rows are encoded batch by batch (Arrow): the distances of
a batch to all codes are one matrix product, ``|x|^2 - 2 x C + |C|^2``.  Codes
within the rounding error of the nearest are compared again by the plain sum
of squared differences, in order, so the answer is that of the definition
(ties -> smaller code).  No join, no shuffle of the encoded table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.functions.scalars import prefix_ngrams, sq_l2_distance

CELLS = 1 << 21  # distances held at once by a task


def _book(rows: list[tuple[int, list[float]]]) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, vectors)`` of a layer; of equal vectors the smallest code stays."""
    rows = sorted((int(c), tuple(map(float, v))) for c, v in rows)
    first: dict[tuple, int] = {}
    for code, v in rows:
        first.setdefault(v, code)
    order = sorted(first.items(), key=lambda item: item[1])
    return np.array([c for _, c in order], dtype=np.int32), np.array([v for v, _ in order], dtype=float)


def codebook_layers(codebook: DataFrame, layers: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The codebook's layers as arrays (``layers x K`` rows are collected)."""
    rows = (codebook.where(F.col("vec").isNotNull() & (F.col("layer") < layers))
            .select(F.col("layer").cast("int"), F.col("code").cast("int"), F.col("vec").cast("array<double>")).collect())
    return [_book([(c, v) for la, c, v in rows if la == layer]) for layer in range(layers)]


def _sum_of_squares(x: np.ndarray) -> np.ndarray:
    """Row sums in order of the elements, as a fold over the array adds them."""
    return np.cumsum(x * x, axis=1)[:, -1] if x.shape[1] else np.zeros(len(x))


def nearest_rows(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Index of the nearest row of ``codes`` for every row of ``x``; ties -> smaller index."""
    size = (codes * codes).sum(1)
    out = np.empty(len(x), dtype=np.int64)
    step = max(1, CELLS // max(len(codes), 1))
    for a in range(0, len(x), step):
        part = x[a:a + step]
        own = (part * part).sum(1)
        far = own[:, None] - 2.0 * (part @ codes.T) + size
        slack = 64 * (x.shape[1] + 1) * np.finfo(float).eps * (np.sqrt(own) + np.sqrt(size.max())) ** 2
        near = far <= far.min(1)[:, None] + slack[:, None]
        best = near.argmax(1)
        row, code = np.nonzero(near & (near.sum(1) > 1)[:, None])
        if len(row):
            exact = np.concatenate([_sum_of_squares(part[row[b:b + step]] - codes[code[b:b + step]])
                                    for b in range(0, len(row), step)])
            order = np.lexsort((code, exact, row))
            first = np.flatnonzero(np.r_[True, np.diff(row[order]) > 0])
            best[row[order][first]] = code[order][first]
        out[a:a + step] = best
    return out


_ENCODED = "codes array<int>, quantized array<double>, residual_norms array<double>, residual array<double>"


def _encoded(vec: str | Column, books: list[tuple[np.ndarray, np.ndarray]]) -> Column:
    """Struct of ``codes``, ``quantized``, ``residual_norms`` and ``residual``; null where there is no code."""
    dim = next((b.shape[1] for _, b in books if len(b)), None)
    whole = dim is not None and all(len(b) for _, b in books)

    def encode(vectors: pa.Array) -> pa.Array:
        size = pc.fill_null(vectors.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)  # null elements are NaN
        start = np.cumsum(size) - size
        fine = (size == dim) & whole & vectors.is_valid().to_numpy(zero_copy_only=False)
        at = np.flatnonzero(fine)
        x = values[start[at][:, None] + np.arange(dim or 0)]
        finite = np.isfinite(x).all(1)
        fine[at] = finite
        x = x[finite]
        left, codes, norms = x, [], []
        for names, book in books if len(x) else []:
            near = nearest_rows(left, book)
            left = left - book[near]
            codes.append(names[near])
            norms.append(_sum_of_squares(left))
        none = np.zeros((0, 0))
        found = (np.stack(codes, axis=1) if codes else none.astype(np.int32), x - left,
                 np.stack(norms, axis=1) if norms else none, left)

        def lists(rows: np.ndarray) -> pa.Array:
            ends = np.concatenate([[0], np.cumsum(fine * rows.shape[1])]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()), mask=pa.array(~fine))

        return pa.StructArray.from_arrays([lists(rows) for rows in found], ["codes", "quantized", "residual_norms", "residual"])

    # not to be worked out again for a filter or for each field: every place is a Python worker of its own in each task
    encode = F.arrow_udf(encode, _ENCODED).asNondeterministic()
    return encode(F.col(vec).cast("array<double>") if isinstance(vec, str) else vec)


def rq_encode(df: DataFrame, vec: str, codebook: DataFrame, layers: int) -> DataFrame:
    """M1 (J10 nearest codebook row per layer): adds ``codes array<int>``, ``quantized array<double>`` and
    ``residual_norms array<double>`` (squared norm of the residual after each layer).

    A vector that is null, of another length than the codes, or holds a null or
    a non-finite value gets nulls, as does every vector if a layer has no codes.
    """
    out = df.withColumn("_enc", _encoded(vec, codebook_layers(codebook, layers)))
    return out.withColumns({c: F.col("_enc")[c] for c in ("codes", "residual_norms", "quantized")}).drop("_enc")


def rq_loss(encoded: DataFrame, vec: str, beta: float = 0.5) -> DataFrame:
    """M3: ``recon_mse`` = mean squared error of the reconstruction,
    ``commit`` = ``beta * sum_l mean(residual_l^2)`` (per element), ``loss`` = both."""
    dim = F.size(vec)
    recon = F.avg(sq_l2_distance(vec, "quantized") / dim)
    commit = F.avg(F.aggregate("residual_norms", F.lit(0.0), lambda a, x: a + x) / dim) * beta
    return encoded.agg(recon.alias("recon_mse"), commit.alias("commit")).withColumn(
        "loss", F.col("recon_mse") + F.col("commit"))


def semantic_id(codes: Column | str, k: int, hash_size: int | None = None) -> Column:
    """M4: prefix n-gram ids of the code list."""
    return prefix_ngrams(codes, k, hash_size)


def prefix_embedding(df: DataFrame, key: str, ids_col: str, table: DataFrame, out: str = "prefix_emb") -> DataFrame:
    """M5: sum of the table rows of every prefix id (J8 + A13 sum)."""
    from recspark.operators.joins import embedding_lookup
    return embedding_lookup(df, key, ids_col, table, out, pool="sum")


def rq_fit(df: DataFrame, vec: str, layers: int, k: int, seed: int = 1, max_iter: int = 20) -> DataFrame:
    """M2: codebooks by k-means on the residuals, layer after layer (MLlib KMeans).

    Returns ``(layer, code, vec)``.  Each layer's residuals are computed by
    encoding with the layers fitted so far.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = df.sparkSession
    rows: list[tuple] = []
    books = []
    source = df.select(F.col(vec).cast("array<double>").alias("_v"))
    for layer in range(layers):
        res = source.select(F.col("_v").alias("_r")) if not books else source.select(_encoded("_v", books)["residual"].alias("_r"))
        km = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features").fit(
            res.where(F.col("_r").isNotNull()).select(array_to_vector("_r").alias("features")))
        centers = [(i, [float(x) for x in c]) for i, c in enumerate(km.clusterCenters())]
        rows += [(layer, i, c) for i, c in centers]
        books.append(_book(centers))
    return spark.createDataFrame(rows, "layer int, code int, vec array<double>")


__all__ = ["rq_encode", "rq_loss", "semantic_id", "prefix_embedding", "rq_fit"]
