"""Operator 1: URL filter.

Explicit host and path rules decide first (longest rule wins).  Urls without a
rule get the verdict of a logistic regression on hashed character n-grams of
host and path, trained by MLlib from a labelled url table.  Scoring is one
narrow pass: n-gram hashes are rolling polynomial hashes over the bytes of a
whole batch, looked up in the weight vector (``2 ** bits`` doubles, the only
thing sent to the tasks).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 13
GRAMS = (3, 4, 5)

#: The labelled hosts the filter is trained from, unwanted and ordinary.
BLOCK_STEMS = ("casino-royal", "online-casino", "best-bets", "free-bets-now", "sports-bets", "cheap-pills",
               "pills-online", "adult-videos", "adult-x-cams", "xxx-adult", "spam-farm", "link-farm", "spam-links",
               "ads-track", "track-ads", "ads-click", "win-prizes", "casino-win-big", "jackpot-win", "poker-bets",
               "pills-cheap-shop", "spam-mail", "adult-chat", "track-click-ads", "win-casino", "free-casino-bets",
               "xxx-cams", "cheap-bets", "bets-win", "jackpot-casino", "adult-spam", "link-spam-farm")
ALLOW_STEMS = ("library", "university", "daily-news", "gardening", "weather", "python-docs", "museum", "kitchen",
               "history", "cycling-forum", "science-journal", "townhall", "travel-maps", "theatre", "research-lab",
               "thenews", "northern", "other", "another", "motherhood", "station", "leather", "weathering",
               "gathering", "thing", "school-district", "orchestra", "hospital", "forest", "teacher", "bakery",
               "harbour", "the-editor", "city-transport", "reading")
_PREFIXES = ("", "www.", "m.", "blog.")
_ENDS = ("com", "net", "org")
_PATHS = ("/en/728", "/de/833", "/fr/12.html", "/es/571/", "/article/2020", "/", "")


def seed_urls(spark: SparkSession, block: Sequence[str] = BLOCK_STEMS, allow: Sequence[str] = ALLOW_STEMS) -> DataFrame:
    """The built-in labelled table ``url``, ``label`` (1: block).

    Every stem comes with each prefix, ending and path, so that those carry no
    weight of their own.
    """
    rows = [(f"http://{pre}{stem}.{end}{path}", label) for label, stems in ((1, block), (0, allow))
            for stem in stems for pre in _PREFIXES for end in _ENDS for path in _PATHS]
    return spark.createDataFrame(rows, "url string, label int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest (host, path, verdict) rule that fits, as a struct ``rule, verdict``; else null.

    A rule fits its host and every subdomain, when the path starts with the
    rule's.  Among rules of one length the first in text order wins.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))).otherwise(out)
    return out


def _mark(host: str, path: str) -> bytes:
    return f"^{host}$\n^{path}$".encode()


def gram_slots(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram slots of all texts one after the other, and each slot's text."""
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(data))  # bytes from here to the text's end
    slots, owners = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        h = np.full(len(data) - n + 1, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) ^ data[k:len(data) - n + 1 + k]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        inside = left[:len(h)] >= n
        slots.append(h[inside].astype(np.int64))
        owners.append(owner[:len(h)][inside])
    if not slots:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(slots), np.concatenate(owners)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [_mark(h or "", p or "") for h, p in zip(batch["__host"].to_pylist(), batch["__path"].to_pylist(), strict=True)]


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label", reg: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on n-gram shares (label 1: block).

    Null labels are left out; the gradients are summed by MLlib's tree aggregation.
    """
    host, path = host_and_path(F.col(url_col))
    rows = labelled.filter(F.col(label_col).isNotNull()).select(
        host.alias("__host"), path.alias("__path"), F.col(label_col).cast("double").alias("label"))

    @F.udf(VectorUDT())
    def features(host: str, path: str) -> SparseVector:
        slots, counts = np.unique(gram_slots([_mark(host, path)])[0], return_counts=True)
        return SparseVector(1 << BITS, slots, counts / max(np.sqrt((counts ** 2).sum()), 1e-12))

    data = rows.select(features("__host", "__path").alias("features"), "label")
    model = LogisticRegression(regParam=reg, standardization=False, maxIter=60).fit(data)
    return np.asarray(model.coefficients.toArray()), float(model.intercept)


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = (),
                url_col: str = "url", threshold: float = 0.7) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``block_score``.

    The verdict is the rule's where one fits, else block when the model's
    probability reaches ``threshold``.  Null urls and urls without ``://`` have
    empty host and path and are scored like any other.  Columns of the output
    names are replaced; other columns are carried.
    """
    weights, bias = train(labelled)
    host, path = host_and_path(F.col(url_col))
    names = ("host", "path", "rule", "verdict", "block_score")
    df = pages.withColumns({"__host": host, "__path": path})
    df = df.drop(*[c for c in names if c != url_col])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots, owner = gram_slots(_texts(b))
            n = b.num_rows
            cells, counts = np.unique(owner * (1 << BITS) + slots, return_counts=True)
            who, slot = cells >> BITS, cells & ((1 << BITS) - 1)
            dot = np.bincount(who, counts * weights[slot], n)
            norm = np.sqrt(np.bincount(who, counts.astype(float) ** 2, n))
            p = 1 / (1 + np.exp(-(dot / np.maximum(norm, 1e-12) + bias)))
            yield pa.record_batch([*b.columns, pa.array(p)], [*b.schema.names, "block_score"])

    schema = T.StructType([*df.schema.fields, T.StructField("block_score", T.DoubleType())])
    out = df.mapInArrow(scored, schema)
    rule = rule_for(F.col("__host"), F.col("__path"), rules)
    by_model = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return (out.withColumn("__rule", rule)
            .withColumns({"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__rule.rule"),
                          "verdict": F.coalesce(F.col("__rule.verdict"), by_model)})
            .drop("__host", "__path", "__rule"))
