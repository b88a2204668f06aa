"""Hashed words and word shingles of Arrow text columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from recspark.llm.common import solid

_M = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(2024).integers(1, 2 ** 63, 256, dtype=np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(29))


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (A-Z lower-cased, no nulls), and each word's text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(solid(texts)))
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.not_equal(flat, "")
    return flat.filter(full), owner[full.to_numpy(zero_copy_only=False)]


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit hashes of large_string values: a polynomial over the bytes, finished with the length."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    buffers = values.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[values.offset:values.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    size = np.diff(offsets)
    at = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], size)
    powers = np.cumprod(np.full(int(size.max()) + 1, _STEP), dtype=np.uint64)
    terms = _BYTES[data] * powers[at]
    total = np.zeros(n, np.uint64)
    some = size > 0
    if some.any():
        total[some] = np.add.reduceat(terms, (offsets[:-1] - offsets[0])[some])
    return mix(total + size.astype(np.uint64) * _M)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed ``width``-word shingles and their texts, sorted by text and hash.

    A text with fewer words has its whole sequence as one shingle; a text
    without words has none.
    """
    flat, owner = words(texts)
    codes = flat.dictionary_encode()
    w = hash_strings(codes.dictionary.cast(pa.large_string()))[codes.indices.to_numpy(zero_copy_only=False)]
    n = len(texts)
    count = np.bincount(owner, minlength=n)
    start = np.cumsum(count) - count
    left = np.repeat(count, count) - (np.arange(len(w)) - np.repeat(start, count))  # words from here to the text's end
    h = np.zeros(len(w), np.uint64)
    take = np.minimum(left, width)
    whole = (left >= width) | (np.repeat(count, count) == left)  # a full shingle, or a short text's first word
    for k in range(width):
        inside = k < take
        nxt = np.zeros(len(w), np.uint64)
        nxt[:len(w) - k] = w[k:]
        h = np.where(inside, mix(h * _M + nxt + np.uint64(k + 1)), h)
    h, own = h[whole], owner[whole]
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return h[fresh], own[fresh]
