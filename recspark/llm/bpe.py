"""Operator 7: BPE encoding and decoding with a word-end vocabulary.

Encoding follows the vocabulary file: special tokens are cut out of the raw
text; the rest is normalised (NFC, lower case) and cut into pieces by the
file's pattern; each distinct piece of a block is merged once.  Merging keeps a
contiguous array of part ids and a contiguous array of the ranks of adjacent
parts for every short word, scans the ranks for their minimum, deletes that
boundary and refreshes the two ranks beside it; the words of a block advance
together, one numpy row each.  A long word has the same boundaries merged in
the same order by a heap, as scanning it again and again would take the square
of its length.

The vocabulary (about 2 MB) is read on the driver and sent along with the
tasks; texts are processed whole, in segments that end at white space.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.llm.common import blocks

#: Words of up to so many bytes are merged side by side, in these widths.
WIDTHS = (4, 8, 16, 32)
_NONE = np.int32(2 ** 31 - 1)
_SEGMENT = 1 << 20


def byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    names = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}
    return [names[b] for b in range(256)]


@functools.cache
def newer_letters() -> tuple[str, str, dict[int, str]]:
    """What differs for letters and digits that Python's Unicode tables lack.

    As ranges of a character class: all that ``regex`` knows, and those among
    them that the library's tables don't have yet; then the lower case that the
    library gives to some.
    """
    from tokenizers import Regex, normalizers, pre_tokenizers
    unknown = "".join(map(chr, (c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn")))
    letters = regex.findall(r"[\p{L}\p{N}]", unknown)
    split = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True)
    known = {c for c, _ in split.pre_tokenize_str("".join(letters))}
    lower = normalizers.Lowercase().normalize_str
    return (_ranges(letters), _ranges([c for c in letters if c not in known]),
            {ord(c): lower(c) for c in letters if lower(c) != c})


def _ranges(chars: list[str]) -> str:
    codes = np.array([ord(c) for c in chars], np.int64)
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs if len(r))


class WordBpe:
    """Encoder and decoder for the content of a ``tokenizers`` BPE file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        self.known = regex.compile(self.pattern).findall
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        names = byte_names()
        self.inner = np.array([vocab[c] for c in names], np.int32)
        self.last = np.array([vocab[c + suffix] for c in names], np.int32)
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        self.size = np.int64(size)
        keys = np.array([a * size + b for a, b, _ in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([c for _, _, c in merges], np.int32)
        self.pair = {(a, b): (r, c) for r, (a, b, c) in enumerate(merges)}

    def pieces(self, text: str) -> list[str]:
        """The pieces of a normalised text."""
        if not text.isascii():
            newer, none, lower = newer_letters()
            if newer and regex.search(f"[{newer}]", text):
                old = self.pattern
                for plain, less in ((r"[^\s\p{L}\p{N}]", rf"[^\s[[\p{{L}}\p{{N}}]--[{none}]]]"),
                                    (r"[\p{L}]", rf"[\p{{L}}--[{none}]]"), (r"[\p{N}]", rf"[\p{{N}}--[{none}]]")):
                    old = old.replace(plain, less if none else plain)
                return regex.findall(old, text.translate(lower), regex.V1)
        return self.known(text)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; ``_NONE`` where they don't merge or either is -1."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)

    def merge_short(self, parts: np.ndarray) -> np.ndarray:
        """Merge words given as rows of part ids, filled up with -1 on the right."""
        n, width = parts.shape
        ranks = np.full((n, width), _NONE, np.int32)
        ranks[:, :-1] = self.rank(parts[:, :-1], parts[:, 1:])
        live, columns = np.arange(n), np.arange(width)
        while len(live):
            at = ranks[live].argmin(1)
            best = ranks[live, at]
            going = best != _NONE
            live, at, best = live[going], at[going], best[going]
            if not len(live):
                break
            take = columns + (columns > at[:, None])  # deletes the boundary after the left part
            full = take < width
            take = np.minimum(take, width - 1)
            p, r = parts[live], ranks[live]
            p, r = np.take_along_axis(p, take, 1), np.take_along_axis(r, take, 1)
            p[~full], r[~full] = -1, _NONE
            rows = np.arange(len(live))
            p[rows, at] = self.made[best]
            right = np.where(at + 1 < width, p[rows, np.minimum(at + 1, width - 1)], -1)
            r[rows, at] = self.rank(p[rows, at], right)
            left = np.maximum(at - 1, 0)
            r[rows, left] = np.where(at > 0, self.rank(p[rows, left], p[rows, at]), r[rows, left])
            parts[live], ranks[live] = p, r
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        """Merge one word of any length, lowest rank first and leftmost first."""
        parts = [*self.inner[list(word[:-1])].tolist(), int(self.last[word[-1]])]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.pair[p], i, p) for i in range(n - 1) if (p := (parts[i], parts[i + 1])) in self.pair]
        heap = [(r, i, c, p) for r, c, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, made, pair = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j], after[i] = made, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (p := (parts[k], parts[after[k]])) in self.pair:
                    r, c = self.pair[p]
                    heapq.heappush(heap, (r, k, c, p))
        return [p for p in parts if p >= 0]

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word's ids begin (and the last ends)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for width in WIDTHS:
            who = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            if not len(who):
                continue
            data = np.frombuffer(b"".join([words[i] for i in who]), np.uint8)
            size = lengths[who]
            ends = np.cumsum(size)
            parts = np.full((len(who), width), -1, np.int32)
            ids = self.inner[data]
            ids[ends - 1] = self.last[data[ends - 1]]
            parts[np.arange(width) < size[:, None]] = ids
            parts = self.merge_short(parts)
            counts[who] = (parts >= 0).sum(1)
            done.append((who, parts[parts >= 0]))
        for i in np.flatnonzero(lengths > WIDTHS[-1]):
            ids = np.array(self.merge_long(words[i]), np.int32)
            counts[i] = len(ids)
            done.append((np.array([i]), ids))
        starts = np.concatenate([[0], np.cumsum(counts)])
        flat = np.empty(starts[-1], np.int32)
        for who, ids in done:
            flat[_spans(starts[who], counts[who])] = ids
        return flat, starts

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Segments of a text, each ordinary text (None) or a special token's id."""
        for k, part in enumerate(self.cut.split(text) if "<|" in text else [text]):
            if k % 2:
                yield part, self.special[part]
            at = 0
            while k % 2 == 0 and at < len(part):
                to = len(part)
                if to - at > _SEGMENT and (space := regex.compile(r"\s").search(part, at + _SEGMENT)):
                    to = space.start()
                yield part[at:to], None
                at = to

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets of the texts."""
        seen: dict[str, int] = {}
        refs, owners, sizes = [], [], []
        for text in texts:
            n = 0
            for part, special in self.segments(text):
                if special is not None:
                    found = [-1 - special]
                else:
                    part = unicodedata.normalize("NFC", part)
                    part = (part.replace("Σ", "σ") if "Σ" in part else part).lower()
                    found = [seen.setdefault(w, len(seen)) for w in self.pieces(part)]
                refs.append(np.array(found, np.int64))
                n += len(found)
            sizes.append(n)
        ref = np.concatenate(refs) if refs else np.zeros(0, np.int64)
        flat, starts = self.merge_all([w.encode() for w in seen])
        flat = np.concatenate([flat, np.arange(self.size, dtype=np.int32)])  # a special token's id stands at its own place
        base = starts[-1]
        begin = np.where(ref >= 0, starts[np.maximum(ref, 0)], base - 1 - ref)
        count = np.where(ref >= 0, np.append(np.diff(starts), 0)[np.maximum(ref, 0)], 1)
        ids = flat[_spans(begin, count)]
        ends = np.concatenate([[0], np.cumsum(count)])
        owners = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return ids, ends[owners]


def _spans(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All positions of the spans [begin, begin + count), one after the other."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total) + np.repeat(begin - (ends - count), count)


def _schema(df: DataFrame, drop: str, field: T.StructField) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name != drop], field])


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the token ids (array of int) of every whole text; null texts are empty.

    ``vocabulary`` is the path of the file on the driver.  A column named
    ``ids_col`` is replaced, all others are carried.
    """
    with open(vocabulary, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # one file, about 2 MB
    df = docs.drop(ids_col)
    schema = _schema(df, ids_col, T.StructField(ids_col, T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(shared.value)
        for batch in batches:
            for b in blocks(batch, text_col):
                ids, offsets = bpe.encode([t or "" for t in b[text_col].to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                yield pa.record_batch([*b.columns, lists], [*b.schema.names, ids_col])

    return df.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Add the tokens of ``ids_col`` joined by one space (the file names no decoder).

    Special tokens are kept.  Null ids give an empty text; an unknown id fails.
    """
    with open(vocabulary, encoding="utf-8") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())
    df = encoded.drop(decoded_col)
    schema = _schema(df, decoded_col, T.StructField(decoded_col, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(WordBpe(shared.value).tokens)
        for batch in batches:
            at = 0
            sizes = np.cumsum(pc.fill_null(pc.list_value_length(batch[ids_col]), 0).to_numpy(zero_copy_only=False))
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + (1 << 20), side="right")))
                b = batch.slice(at, to - at)
                at = to
                n = pc.fill_null(pc.list_value_length(b[ids_col]), 0).to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()),
                                                 tokens.take(pc.list_flatten(b[ids_col])))
                yield pa.record_batch([*b.columns, pc.binary_join(lists, " ")], [*b.schema.names, decoded_col])

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """Encode and decode, then replace text, ids and decoded text by their count and SHA-256 sums."""
    coded = decode(encode(docs, vocabulary, text_col).drop(text_col), vocabulary)
    plain = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.withColumns({
        "n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(plain.cast("binary"), 256),
        "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256)}).drop("ids", "decoded")
