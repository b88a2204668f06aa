"""Operator 12: toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text,
and a text is compressed window by window with either.  A window that the toxic
side compresses by more bytes speaks for toxicity; how many bytes count
(``gain``), and which share of gaining windows makes which score, are calibrated
on a fold of labelled rows that trains nothing else (pool adjacent violators).

Words (A-Z lower-cased) are written as codes of eight hash bytes, so that a match
in a dictionary is a whole word or phrase and never a common syllable, and a
window is ``WINDOW`` words.  The toxic side holds the ordinary dictionary too:
ordinary text then costs both sides the same, and the difference is what the
toxic phrases save.  The toxic dictionary is trained on the telling words of
toxic rows, in their order: those of at least ``min_rows`` toxic rows whose rate
there is ``ratio`` times the rate in ordinary rows.

Training reads a bounded, seeded sample of labelled rows (``max_rows`` of either
class, in expectation); scoring is one narrow pass over whole texts.  Labels,
language, source and ids are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.llm.common import blocks, crc, stored
from recspark.llm.quality_model import pool
from recspark.llm.shingles import hash_strings, words

WINDOW = 16
CODE = 8
GAINS = 12
SMOOTH = 8
ORDINARY_BYTES, TOXIC_BYTES = 65_536, 16_384
LEVEL = 6
SAMPLES = 16_384
TELLING = 4096


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all words of the texts, and each word's text."""
    flat, owner = words(texts)
    codes = flat.dictionary_encode()
    return hash_strings(codes.dictionary.cast(pa.large_string()))[codes.indices.to_numpy(zero_copy_only=False)], owner


def windows(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of the windows of texts whose words have the given (sorted) owners."""
    count = np.bincount(owner, minlength=n)
    many = -(-count // WINDOW)
    text = np.repeat(np.arange(n), many)
    begin = np.repeat(np.cumsum(count) - count, many) + WINDOW * (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many))
    return begin, np.minimum(begin + WINDOW, np.repeat(np.cumsum(count), many)), text


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries and the calibration; of bounded size."""
    ordinary: bytes
    toxic: bytes
    gain: int
    knots: np.ndarray
    values: np.ndarray

    @cached_property
    def _sides(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        out = []
        for content in (self.ordinary, self.ordinary + self.toxic):
            book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            book.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=book, write_checksum=False,
                                                write_content_size=False, write_dict_id=False))
        return out[0], out[1]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_sides"}

    def gains(self, texts: pa.Array) -> np.ndarray:
        """For each text the number of its windows, then of those that save at least 1, 2, ... ``GAINS`` bytes."""
        n = len(texts)
        codes, owner = coded(texts)
        begin, end, text = windows(owner, n)
        data = memoryview(codes.astype("<u8").tobytes())
        plain, both = (c.compress for c in self._sides)
        saved = np.array([len(plain(data[a:b])) - len(both(data[a:b]))
                          for a, b in zip((begin * CODE).tolist(), (end * CODE).tolist(), strict=True)], np.int64)
        out = np.zeros((n, GAINS + 1), np.int64)
        out[:, 0] = np.bincount(text, minlength=n)
        for g in range(1, GAINS + 1):
            out[:, g] = np.bincount(text[saved >= g], minlength=n)
        return out

    def score(self, gains: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(share(gains, self.gain), self.knots, self.values), 0.0, 1.0)


def share(gains: np.ndarray, gain: int) -> np.ndarray:
    """Smoothed share of windows that save ``gain`` bytes: a short text has to show more of them."""
    return gains[:, gain] / (gains[:, 0] + SMOOTH)


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; the samples' own end where they are too few to train on."""
    whole = b"".join(samples)
    if len(whole) <= size:
        return whole
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return whole[-size:]


def _samples(texts: DataFrame, only: np.ndarray | None, expected: float) -> list[bytes]:
    """About ``SAMPLES`` windows of the texts, or of those of their words that are in ``only``.

    ``expected`` is how many there will be; each is taken or left by a hash, so
    that every task sends its share alone.
    """
    rate = min(1.0, SAMPLES / max(expected, 1.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, "text"):
                codes, owner = coded(b["text"])
                if only is not None:
                    keep = np.isin(codes, only)
                    codes, owner = codes[keep], owner[keep]
                begin, end, text = windows(owner, b.num_rows)
                data = codes.astype("<u8").tobytes()
                yield pa.record_batch([b["id"].take(pa.array(text)),
                                       pa.array([data[x * CODE:y * CODE] for x, y in zip(begin, end, strict=True)], pa.binary())],
                                      ["id", "window"])

    rows = texts.select("id", "text").mapInArrow(run, "id string, window binary")
    taken = rows.filter(F.pmod(F.xxhash64("window", "id"), F.lit(1 << 20)) < rate * (1 << 20))
    return [r["window"] for r in taken.orderBy(F.xxhash64("window", "id"), "window").select("window").collect()]


def calibrate(gains: np.ndarray, label: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """The gain with the least squared error after isotonic regression of labels on shares, and its pools."""
    best = None
    for gain in range(1, gains.shape[1]):
        at, inverse, many = np.unique(share(gains, gain).round(4), return_inverse=True, return_counts=True)
        knots, values = pool(at, many.astype(float), np.bincount(inverse, weights=label))
        loss = ((np.interp(share(gains, gain), knots, values) - label) ** 2).sum()
        if best is None or loss < best[0] - 1e-9:
            best = (loss, gain, knots, values)
    return best[1], best[2], best[3]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        folds: int = 5, max_rows: int = 20_000, min_rows: int = 4, ratio: float = 30.0) -> ToxicityModel:
    """Fit on labelled documents whose crc32(id) mod ``folds`` is not 0; the last fold calibrates.

    At most about ``max_rows`` rows of either class are read, chosen by a hash
    of the id.  Rows without id or label are left out, repeated ids count each
    time.  Where the rows of a class are missing, every score is the share of
    toxic rows (0 without any).
    """
    y = labels.filter(F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), (F.col(label_col) > 0).cast("int").alias("y"))
    y = y.withColumn("fold", (crc(F.col("id")) % folds).cast("int")).filter("fold <> 0")
    count = {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    if not (count.get(0) and count.get(1)):
        base = count.get(1, 0) / max(1, sum(count.values()))
        return ToxicityModel(b"", b"", 1, np.zeros(1), np.full(1, base))
    rate = F.when(F.col("y") == 1, min(1.0, max_rows / count[1])).otherwise(min(1.0, max_rows / count[0]))
    y = y.filter(F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 20)) < rate * (1 << 20))
    x = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = stored(x.join(F.broadcast(y), "id"), "toxicity-rows")  # about 2 * max_rows ids at most, whatever the tables
    train = rows.filter(F.col("fold") < folds - 1)

    def distinct_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, "text"):
                codes, owner = coded(b["text"])
                label = np.asarray(b["y"])
                pair = np.unique(np.stack([owner.astype(np.uint64), codes]), axis=1)
                for t in (0, 1):  # rows of the block that hold the word, by class
                    code, many = np.unique(pair[1][label[pair[0].astype(np.int64)] == t], return_counts=True)
                    yield pa.record_batch([pa.array(code.view(np.int64)), pa.array(many * t), pa.array(many * (1 - t))],
                                          ["code", "toxic", "ordinary"])

    total = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    found = train.mapInArrow(distinct_codes, "code long, toxic long, ordinary long").groupBy("code").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    often = F.col("toxic") * max(1, total.get(0, 0)) >= ratio * (F.col("ordinary") + 0.5) * max(1, total.get(1, 0))
    telling = (found.filter((F.col("toxic") >= min_rows) & often).orderBy(F.desc("toxic"), "code").limit(TELLING)
               .select("code", "toxic").collect())
    said = sum(r["toxic"] for r in telling)
    telling = np.sort(np.array([r["code"] for r in telling], np.int64).view(np.uint64))

    toxic = train_dictionary(_samples(train.filter("y = 1"), telling, said / WINDOW + total.get(1, 0)), TOXIC_BYTES)
    clean = train.filter("y = 0")
    size = clean.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ordinary = train_dictionary(_samples(clean, None, size / (6 * WINDOW)), ORDINARY_BYTES)  # words of some six bytes
    model = ToxicityModel(ordinary, toxic, 1, np.zeros(1), np.zeros(1))
    last = with_gains(rows.filter(F.col("fold") == folds - 1).select("y", "text"), model, "text", "gains")
    last = last.select("y", "gains").toArrow()  # at most about 2 * max_rows / (folds - 1) short rows
    if not last.num_rows:
        return ToxicityModel(ordinary, toxic, 1, np.array([0.0, 0.1]), np.array([0.0, 1.0]))
    gains = last["gains"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, GAINS + 1)
    return ToxicityModel(ordinary, toxic, *calibrate(gains, np.asarray(last["y"]).astype(float)))


def _with(docs: DataFrame, text_col: str, out_col: str, kind: T.DataType, value) -> DataFrame:
    df = docs.drop(out_col)
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, text_col):
                yield pa.record_batch([*b.columns, value(b[text_col])], [*b.schema.names, out_col])

    return df.mapInArrow(run, schema)


def with_gains(docs: DataFrame, model: ToxicityModel, text_col: str, out_col: str) -> DataFrame:
    """Add the window counts of ``ToxicityModel.gains`` (array of long)."""
    def value(texts: pa.Array) -> pa.Array:
        g = model.gains(texts)
        return pa.ListArray.from_arrays(np.arange(0, g.size + 1, GAINS + 1, dtype=np.int32), pa.array(g.ravel()))
    return _with(docs, text_col, out_col, T.ArrayType(T.LongType()), value)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add the calibrated score of every whole text, in one narrow pass.

    A null text is scored as an empty one (no windows, so the lowest score).  A
    column named ``score_col`` is replaced, all others are carried; repeated
    rows are scored each, equal texts alike.
    """
    return _with(docs, text_col, score_col, T.DoubleType(), lambda texts: pa.array(model.score(model.gains(texts)), pa.float64()))
