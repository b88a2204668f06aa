"""Operator 6: quality classifier on document statistics.

A document becomes a short vector of statistics of its whole text (lengths,
character classes, repetition).  Random Fourier features approximate a
Gaussian kernel over the standardised statistics; every task sums the normal
equations of its rows, the sums are added up by row of the matrix, and ridge
regression gives a raw score.  Labelled rows of one fold are kept back to
calibrate raw scores by isotonic regression (pool adjacent violators over
fixed bins), interpolated between the pools so that order is kept.

Training shuffles one row of statistics per labelled document and ``TASKS``
matrices; scoring is one narrow pass.  Labels, language, source and ids are
never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.llm.common import blocks, crc, solid, stored

FEATURES = 256
TASKS = 32
BINS = 4096
_LOW, _HIGH = -0.5, 1.5
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
            "space": b" \t\n\x0b\x0c\r", "symbol": b"#*$%&|<>", "stop": b".;:?", "comma": b",", "shout": b"!",
            "other": bytes(range(128, 256))}


def _byte_class() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.int64)
    for k, chars in enumerate(_CLASSES.values()):
        table[list(chars)] = k
    return table


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of statistics for each text (no nulls), from the whole text."""
    n, kinds, table = len(texts), len(_CLASSES) + 1, _byte_class()
    data = [t.as_buffer() for t in texts]
    count = np.stack([sum((np.bincount(table[np.frombuffer(d, np.uint8)[at:at + (1 << 20)]], minlength=kinds)
                           for at in range(0, d.size, 1 << 20)), np.zeros(kinds, np.int64)) for d in data]) if n else np.zeros((0, kinds))
    c = dict(zip(_CLASSES, count.T, strict=False))
    size = count.sum(1)

    def repeats(lists: pa.ListArray) -> tuple[np.ndarray, ...]:
        """Entries, distinct entries, entries equal to the one before, and the most frequent entry's count of each list."""
        flat = lists.flatten()
        owner = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)[full].astype(np.int64)
        owner = owner[full]
        same = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
        pair, times = np.unique(owner * (int(code.max(initial=0)) + 1) + code, return_counts=True)
        who = pair // (int(code.max(initial=0)) + 1)
        most = np.zeros(n)
        np.maximum.at(most, who, times)
        return (np.bincount(owner, minlength=n), np.bincount(who, minlength=n),
                np.bincount(owner[1:][same], minlength=n), most)

    words, kinds_of_words, doubled, top = repeats(pc.ascii_split_whitespace(texts))
    lines, kinds_of_lines, _, _ = repeats(pc.split_pattern(texts, "\n"))
    w, ln = np.maximum(words, 1), np.maximum(lines, 1)
    letters = np.maximum(c["upper"] + c["lower"] + c["other"], 1)
    body = np.maximum(size - c["space"], 1)
    return np.column_stack([
        np.log1p(words), np.log1p(size), (size - c["space"]) / w, c["upper"] / letters, c["other"] / letters,
        c["digit"] / body, np.sqrt(c["symbol"] / body), np.sqrt(c["shout"] / body), c["stop"] / w, c["comma"] / w,
        np.log1p(kinds_of_words) / np.log1p(w), np.sqrt(doubled / w), top / w, np.sqrt((lines - kinds_of_lines) / ln),
        np.log1p(words / ln)]).astype(np.float64)


def with_statistics(docs: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Replace the text by its statistics (array of double); a null text counts as empty."""
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != text_col],
                           T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, text_col):
                x = statistics(solid(b[text_col]))
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                keep = [n for n in b.schema.names if n != text_col]
                yield pa.record_batch([*[b[n] for n in keep], lists], [*keep, out_col])

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class QualityModel:
    """Everything a score needs; its size depends on ``FEATURES`` and ``BINS`` alone."""
    mean: np.ndarray
    scale: np.ndarray
    seed: int
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of statistics, and a constant."""
        d = len(self.mean)
        rng = np.random.default_rng(self.seed)
        waves, phase = rng.normal(size=(d, FEATURES)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.cos(z @ waves + phase) * np.sqrt(2 / FEATURES), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def pool(low: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of ``total / weight`` over increasing ``low``: pool centres and pooled means."""
    stack: list[list[float]] = []
    for x, w, t in zip(low, weight, total, strict=True):
        stack.append([x * w, w, t])
        while len(stack) > 1 and stack[-2][2] * stack[-1][1] >= stack[-1][2] * stack[-2][1]:
            last = stack.pop()
            stack[-1] = [a + b for a, b in zip(stack[-1], last, strict=True)]
    return np.array([s[0] / s[1] for s in stack]), np.array([s[2] / s[1] for s in stack])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        folds: int = 5, ridge: float = 1e-4, seed: int = 11) -> QualityModel:
    """Fit on the labelled documents whose crc32(id) mod ``folds`` is not 0.

    Folds below the last are for the ridge scores, the last calibrates.  Rows
    without id or label are left out; without any labelled row every score is
    one half.  Repeated ids count each time.
    """
    y = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
    x = with_statistics(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                        .filter((crc(F.col("id")) % folds) != 0), "text", "x")
    rows = stored(x.join(y, "id").select((crc(F.col("id")) % folds).cast("int").alias("fold"), "y", "x"), "quality-rows")
    stats = (rows.select(F.posexplode("x").alias("pos", "v")).groupBy("pos")
             .agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")).orderBy("pos").collect())
    if not stats:
        d = statistics(pa.array([""])).shape[1]
        return QualityModel(np.zeros(d), np.ones(d), seed, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    mean, scale = (np.array([r[k] for r in stats]) for k in ("mean", "sd"))
    base = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0), seed, np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for b in batches:
            if b.num_rows:
                z = base.features(_matrix(b["x"]))
                total += z.T @ np.column_stack([z, np.asarray(b["y"])])
        yield pa.record_batch([pa.array(range(FEATURES + 1), pa.int32()), pa.array(list(total))], ["row", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = _matrix(group["sums"].combine_chunks()).sum(0)
        return pa.table({"row": group["row"][:1], "sums": pa.array([total])})

    kind = "row int, sums array<double>"
    train = rows.filter(F.col("fold") < folds - 1).repartition(TASKS).mapInArrow(equations, kind)
    both = np.array([r["sums"] for r in train.groupBy("row").applyInArrow(add, kind).orderBy("row").collect()])
    gram, right = both[:, :-1], both[:, -1]
    penalty = np.eye(FEATURES + 1) * max(gram[-1, -1], 1.0) * ridge
    penalty[-1, -1] = 1e-9
    base = QualityModel(base.mean, base.scale, seed, np.linalg.solve(gram + penalty, right), base.knots, base.values)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = np.clip((base.raw(_matrix(b["x"])) - _LOW) / (_HIGH - _LOW), 0, 1) * (BINS - 1)
                yield pa.record_batch([pa.array(at.round().astype(np.int32)), b["y"]], ["bin", "y"])

    bins = (rows.filter(F.col("fold") == folds - 1).mapInArrow(binned, "bin int, y double")
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t")).orderBy("bin").collect())
    if not bins:
        return QualityModel(base.mean, base.scale, seed, base.weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    at = _LOW + np.array([r["bin"] for r in bins]) * (_HIGH - _LOW) / (BINS - 1)
    knots, values = pool(at, np.array([r["n"] for r in bins], float), np.array([r["t"] for r in bins]))
    return QualityModel(base.mean, base.scale, seed, base.weights, knots, values)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add the calibrated score of every whole text, in one narrow pass.

    A null text is scored as an empty one.  A column named ``score_col`` is
    replaced, all others are carried.
    """
    df = docs.drop(score_col)
    schema = T.StructType([*df.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, text_col):
                x = statistics(solid(b[text_col]))
                yield pa.record_batch([*b.columns, pa.array(model.score(x))], [*b.schema.names, score_col])

    return df.mapInArrow(run, schema)
