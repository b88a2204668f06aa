"""String hashing into ``n`` buckets.

Four methods:

* ``xxh32`` - 32-bit xxHash of the text with a seed (reference default, seed
  1024).  Spark has no xxh32, so it runs as an Arrow ``pandas_udf``: texts of
  one length form a byte matrix and all of them are hashed together, column by
  column, by the public algorithm in numpy.
* ``xxhash64`` - Spark's native 64-bit xxHash (seed 42), fully JVM-side.
* ``md5`` / ``sha256`` - first 15 hex digits of the digest as an integer,
  native and reproducible in SQL engines.

Null input hashes the ``null_token`` text (default ``"nan"``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.fixed import DEFAULT_HASH_SEED, NULL_TOKEN

# Fixed values of the public xxh32 specification (primes).
_P1, _P2, _P3, _P4, _P5 = (np.uint32(p) for p in (2654435761, 2246822519, 3266489917, 668265263, 374761393))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint32(r)) | (x >> np.uint32(32 - r))


def _xxh32_rows(rows: np.ndarray, seed: int) -> np.ndarray:
    """xxh32 of every row of a byte matrix."""
    count, width = rows.shape
    start = np.full(count, seed & 0xFFFFFFFF, np.uint32)
    words = width // 4
    lanes = np.ascontiguousarray(rows[:, :words * 4]).view("<u4").astype(np.uint32) if words else None
    used = words // 4 * 4  # whole stripes of four lanes
    if used:
        acc = [start + _P1 + _P2, start + _P2, start.copy(), start - _P1]
        for k in range(used):
            acc[k % 4] = _rotl(acc[k % 4] + lanes[:, k] * _P2, 13) * _P1
        h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
    else:
        h = start + _P5
    h = h + np.uint32(width & 0xFFFFFFFF)
    for k in range(used, words):
        h = _rotl(h + lanes[:, k] * _P3, 17) * _P4
    for k in range(words * 4, width):
        h = _rotl(h + rows[:, k].astype(np.uint32) * _P5, 11) * _P1
    for shift, prime in ((15, _P2), (13, _P3)):
        h = (h ^ (h >> np.uint32(shift))) * prime
    return h ^ (h >> np.uint32(16))


def xxh32_many(texts: list[str], seed: int = DEFAULT_HASH_SEED) -> np.ndarray:
    """xxh32 of all texts (UTF-8), those of one length together."""
    data = [t.encode("utf-8") for t in texts]
    size = np.fromiter(map(len, data), np.int64, len(data))
    out = np.zeros(len(data), np.int64)
    order = np.argsort(size, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(group):
            rows = np.frombuffer(b"".join([data[i] for i in group]), np.uint8).reshape(len(group), size[group[0]])
            out[group] = _xxh32_rows(rows, seed)
    return out


def _xxh32_udf(n: int, seed: int):
    @F.pandas_udf(T.LongType())
    def bucket(s: pd.Series) -> pd.Series:
        return pd.Series(xxh32_many(s.tolist(), seed) % n)
    return bucket


def _xxh32_list_udf(n: int, seed: int):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def bucket_list(s: pd.Series) -> pd.Series:
        full = s.notna().to_numpy()
        size = np.array([len(x) for x in s[full]], np.int64)
        flat = xxh32_many([t for x in s[full] for t in x], seed) % n
        out = pd.Series([None] * len(s), dtype=object)
        for i, part in zip(np.flatnonzero(full), np.split(flat, np.cumsum(size)[:-1]) if len(size) else [], strict=True):
            out.iat[i] = part
        return out
    return bucket_list


def hex_prefix_bucket(hex_digest: Column, n: int) -> Column:
    """First 15 hex digits (60 bits, always positive in a long) modulo ``n``."""
    return F.pmod(F.conv(F.substring(hex_digest, 1, 15), 16, 10).cast("long"), F.lit(n))


def _native_bucket(s: Column, n: int, method: str) -> Column:
    if method == "xxhash64":
        return F.pmod(F.xxhash64(s), F.lit(n))
    if method == "md5":
        return hex_prefix_bucket(F.md5(s), n)
    if method == "sha256":
        return hex_prefix_bucket(F.sha2(s, 256), n)
    raise ValueError(f"unknown hash method {method!r}")


def as_text(c: Column, null_token: str | None = NULL_TOKEN) -> Column:
    """Canonical text of a value: ``cast(string)``, null -> ``null_token``."""
    s = c.cast("string")
    return s if null_token is None else F.coalesce(s, F.lit(null_token))


def str_hash(c: Column | str, n: int, method: str = "xxh32", seed: int = DEFAULT_HASH_SEED,
             null_token: str | None = NULL_TOKEN) -> Column:
    """bucket of the value's text in ``[0, n)``."""
    s = as_text(F.col(c) if isinstance(c, str) else c, null_token)
    if method == "xxh32":
        return _xxh32_udf(int(n), int(seed))(s)
    return _native_bucket(s, n, method)


def list_hash(c: Column | str, n: int, method: str = "xxh32", seed: int = DEFAULT_HASH_SEED) -> Column:
    """bucket every element of an ``array<string>``; a null element is hashed as the null token."""
    col = F.transform((F.col(c) if isinstance(c, str) else c).cast("array<string>"), lambda x: as_text(x))
    if method == "xxh32":
        return _xxh32_list_udf(int(n), int(seed))(col)
    return F.transform(col, lambda x: _native_bucket(x.cast("string"), n, method))
