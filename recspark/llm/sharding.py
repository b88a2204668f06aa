"""Operator 10: byte-balanced shards by histogram sort.

Rows are ordered by a 128-bit key: 64 bits hashed from the text, then 64 bits
hashed from the id.  Splitters between shards are searched on that key: each
round counts, over all partitions, the exact bytes and rows below every probe
inside the open brackets, then narrows each bracket to the probe cell holding
its target.  A splitter is settled when an edge of its cell is within
``tolerance`` of the target.  Text bits come first, so copies of one text stay
together wherever the tolerance allows; a group of copies larger than that is
cut by the id bits.  After that the rows are exchanged once.

Only DataFrame functions are used.  The driver sees at most ``max_probes``
counts a round, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recspark.llm.common import stored

_MIN = -(1 << 63)
_FIRST = 12
_K1, _K2 = "__hs_text", "__hs_id"


@dataclass(frozen=True)
class Splitters:
    """Range boundaries on the 128-bit key, with the exact rows below each.

    ``ranges`` consecutive key ranges make one shard; ``offset[r]`` is the
    number of rows of the same shard in earlier ranges.
    """
    shards: int
    ranges: int
    boundaries: tuple[int, ...]
    offset: tuple[int, ...]


def with_keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add the two key columns; a null text counts as empty, a null id as its own value."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.withColumns({_K1: F.xxhash64(text), _K2: F.xxhash64(F.col(id_col).cast("string"))})


def _prefix(col: Column, bits: int) -> Column:
    """The first ``bits`` bits in the order of signed longs, as a number."""
    if bits == 64:
        return col
    return F.shiftrightunsigned(col.bitwiseXOR(F.lit(_MIN)), 64 - bits)


def _cell(bits: int) -> tuple[Column, Column]:
    if bits <= 64:
        return _prefix(F.col(_K1), bits), F.lit(0).cast("long")
    return F.col(_K1), _prefix(F.col(_K2), bits - 64)


def _unsigned(hi: int, lo: int, bits: int) -> int:
    """Cell columns back to one number of ``bits`` bits."""
    if bits < 64:
        return hi
    if bits == 64:
        return hi - _MIN
    return ((hi - _MIN) << (bits - 64)) + (lo - _MIN if bits == 128 else lo)


def _columns(cell: int, bits: int) -> tuple[int, int]:
    if bits < 64:
        return cell, 0
    if bits == 64:
        return cell + _MIN, 0
    rest = bits - 64
    lo = cell & ((1 << rest) - 1)
    return (cell >> rest) + _MIN, lo + _MIN if rest == 64 else lo


def fit_splitters(keys: DataFrame, size_col: str, shards: int = 8, tolerance: float = 0.01,
                  rows_per_range: int = 250_000, max_ranges: int = 4096, max_probes: int = 65_536) -> Splitters:
    """Search the splitters on ``keys`` (columns of :func:`with_keys` and a size).

    ``tolerance`` is the share of a shard's bytes by which a shard boundary may
    miss its target.  Each shard is cut into equal-byte ranges of about
    ``rows_per_range`` rows (at most ``max_ranges`` in all), so that numbering
    the rows later sorts ranges, not shards.
    """
    counts = (F.sum(size_col).alias("b"), F.count(F.lit(1)).alias("n"))

    def histogram(bits: int, active: set[int] | None, before: int) -> dict[int, list[tuple[int, int, int]]]:
        df = keys
        if active is not None:
            hi, lo = _cell(before)
            spark = keys.sparkSession
            wanted = spark.createDataFrame([_columns(c, before) for c in sorted(active)], "wh long, wl long")
            df = df.join(F.broadcast(wanted), (hi == F.col("wh")) & (lo == F.col("wl")), "left_semi")
        hi, lo = _cell(bits)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for r in df.groupBy(hi.alias("h"), lo.alias("l")).agg(*counts).collect():
            c = _unsigned(r["h"], r["l"], bits)
            found.setdefault(c >> (bits - before), []).append((c, r["b"], r["n"]))
        return {k: sorted(v) for k, v in found.items()}

    top = histogram(_FIRST, None, 0).get(0, [])
    total, rows = sum(b for _, b, _ in top), sum(n for _, _, n in top)
    if not rows:
        return Splitters(shards, 1, (), (0,) * shards)
    per = max(1, min(max_ranges // shards, -(-rows // (shards * rows_per_range))))
    m = shards * per
    settled: dict[int, tuple[int, int]] = {}  # splitter -> (boundary, rows below)
    open_ = {j: (top, 0, 0) for j in range(1, m)}
    bits = _FIRST
    while open_:
        refine: dict[int, tuple[int, int, int]] = {}  # splitter -> cell, bytes below, rows below
        for j, (cells, below, n_below) in open_.items():
            target = total * j / m
            allowed = tolerance * total / shards if j % per == 0 else 0.25 * total / m
            for c, b, n in cells:
                if below + b >= target:
                    break
                below, n_below = below + b, n_below + n
            left, right = target - below, below + b - target
            if min(left, right) <= allowed or n == 1 or bits == 128:
                settled[j] = (c << (128 - bits), n_below) if left <= right else ((c + 1) << (128 - bits), n_below + n)
            else:
                refine[j] = (c, below, n_below)
        if refine:
            active = {c for c, _, _ in refine.values()}
            step = max(1, (max_probes // len(active)).bit_length() - 1)
            more = min(bits + min(step, 16), 64 if bits < 64 else 128)
            found = histogram(more, active, bits)
            open_ = {j: (found[c], b, n) for j, (c, b, n) in refine.items()}
            bits = more
        else:
            open_ = {}
    edges = [settled[j] for j in range(1, m)]
    starts = [0, *(n for _, n in edges)]
    offset = tuple(starts[r] - starts[r - r % per] for r in range(m))
    return Splitters(shards, per, tuple(b for b, _ in edges), offset)


def _lookup(spark: SparkSession, s: Splitters) -> DataFrame:
    """For each first-level cell: the ranges begun before it and the boundaries inside it."""
    inside: dict[int, list[tuple[int, int]]] = {}
    width = 1 << (128 - _FIRST)
    for b in s.boundaries:
        if b % width and b < 1 << 128:
            inside.setdefault(b // width, []).append(((b >> 64) + _MIN, (b & ((1 << 64) - 1)) + _MIN))
    rows = [(c, sum(b <= c * width for b in s.boundaries), inside.get(c, [])) for c in range(1 << _FIRST)]
    return spark.createDataFrame(rows, "__hs_cell long, __hs_base int, __hs_in array<struct<h:long,t:long>>")


def apply_splitters(keyed: DataFrame, s: Splitters, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (gapless from 0 in key order) to rows with keys.

    The lookup has 4096 rows and at most one boundary a range; the broadcast is
    bounded by that.  The rows are exchanged once, by range.  Columns of the
    two output names are replaced.
    """
    spark = keyed.sparkSession
    h, t = F.col(_K1), F.col(_K2)
    rng = F.col("__hs_base") + F.size(F.filter("__hs_in", lambda b: (h > b["h"]) | ((h == b["h"]) & (t >= b["t"]))))
    offsets = spark.createDataFrame(list(enumerate(s.offset)), "__hs_range int, __hs_offset long")
    ranged = (keyed.withColumn("__hs_cell", _prefix(h, _FIRST))
              .join(F.broadcast(_lookup(spark, s)), "__hs_cell").withColumn("__hs_range", rng))
    number = F.row_number().over(Window.partitionBy("__hs_range").orderBy(_K1, _K2))
    out = (ranged.withColumn("__hs_number", number).join(F.broadcast(offsets), "__hs_range")
           .withColumns({shard_col: (F.col("__hs_range") / s.ranges).cast("int"),
                         slot_col: F.col("__hs_offset") + F.col("__hs_number") - 1}))
    return out.drop(*[c for c in out.columns if c.startswith("__hs_")])


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                    tolerance: float = 0.01, rows_per_range: int = 250_000, max_ranges: int = 4096,
                    max_probes: int = 65_536) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard``, ``slot``.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1.  Rows that
    agree in id and text share a key and stay together; their slots are
    interchangeable.  A table with fewer rows than shards leaves some shards
    empty; an empty table gives no rows.  Other columns are not carried: only
    keys and sizes are exchanged.  To move whole documents, add
    :func:`with_keys` to them and call :func:`apply_splitters`.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keys = stored(with_keys(docs.select(id_col, text_col), id_col, text_col)
                  .select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"),
                          F.crc32(text).alias("text_crc32"), _K1, _K2), "shard-keys")
    s = fit_splitters(keys, "size", shards, tolerance, rows_per_range, max_ranges, max_probes)
    return apply_splitters(keys, s)
