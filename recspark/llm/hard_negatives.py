"""Operator 11: hard-negative mining through an inverted multi-index.

Vectors are scaled to integers and cut into two halves, each with a codebook of
its own; a pair of codes is a cell.  An anchor's inner product with any row of
cell ``(i, j)`` is at most ``u_i + v_j``: the half-scores of the two centroids
plus the anchor's half-norms times the halves' radii.  A multi-sequence heap
visits an anchor's cells in the order of these sums.

Two searches follow each other: the anchor's best rows of its own label, and for
each of their scores the best rows of other labels inside that score's window.
Each takes two rounds.  The first visits the heap's first cells, enough for
``seed_rows`` rows, and gives provisional windows.  The second visits every
other cell whose bound reaches the worst row of a provisional window (or, while
the window is not full, its lowest score), and takes only rows that improve it;
after it no cell outside can hold a better row, so the windows are certified.
On vectors without structure the bounds reach far and most cells are visited;
the answer is exact either way.

Equal vectors of one label are one entry with their smallest ids.  Cells lie in
blocks of about ``block_rows`` entries, a larger cell in several; an anchor is
sent to the blocks that hold a cell it visits, and a block and at most
``anchor_rows`` of its anchors are one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.common import stored

SAMPLE = 16_384
CODES = 256


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks, radii and cell sizes: at most ``CODES`` codes a half, so of bounded size."""
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] | None = None
    sizes: np.ndarray | None = None
    first: np.ndarray | None = None
    cuts: np.ndarray | None = None

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.books[0].shape[1]
        return x[:, :h], x[:, h:]

    def codes(self, x: np.ndarray) -> list[np.ndarray]:
        """For both halves the nearest code of each row, and the distance to it."""
        out = []
        for half, book in zip(self.halves(x), self.books, strict=True):
            code = np.argmin((book * book).sum(1) - 2 * half @ book.T, axis=1)
            out += [code, np.sqrt(((half - book[code]) ** 2).sum(1))]
        return out

    def bounds(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half-score bounds of each anchor and code; rounding errors are inside."""
        out = []
        for half, book, radius in zip(self.halves(a), self.books, self.radii, strict=True):
            norm = np.sqrt((half * half).sum(1, keepdims=True))
            reach = norm * (radius + np.sqrt((book * book).sum(1)))
            out.append(half @ book.T + norm * radius + 1e-9 * reach + 1e-6)
        return out[0], out[1]

    def first_cells(self, u: np.ndarray, v: np.ndarray, rows: int) -> float:
        """The bound of the last cell that one anchor's heap visits until ``rows`` rows are seen."""
        i, j = np.argsort(-u, kind="stable"), np.argsort(-v, kind="stable")
        heap, pushed, seen = [(-(u[i[0]] + v[j[0]]), 0, 0)], {(0, 0)}, 0
        while heap:
            bound, x, y = heapq.heappop(heap)
            seen += int(self.sizes[i[x], j[y]])
            if seen >= rows:
                return -bound
            for nxt in ((x + 1, y), (x, y + 1)):
                if nxt[0] < len(i) and nxt[1] < len(j) and nxt not in pushed:
                    pushed.add(nxt)
                    heapq.heappush(heap, (-(u[i[nxt[0]]] + v[j[nxt[1]]]), *nxt))
        return -np.inf


def lloyd(x: np.ndarray, codes: int, rounds: int, seed: int) -> np.ndarray:
    """Codebook of one half by k-means over a bounded sample."""
    rng = np.random.default_rng(seed)
    book = np.unique(x, axis=0)
    book = book[rng.permutation(len(book))[:codes]]
    for _ in range(rounds):
        code = np.argmin((book * book).sum(1) - 2 * x @ book.T, axis=1)
        many = np.bincount(code, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, code, x)
        book = np.where(many[:, None] > 0, total / np.maximum(many, 1)[:, None], book)
    return book


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of vectors of up to ``width`` components; shorter ones are filled with zeros."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = flat.value_lengths().to_numpy(zero_copy_only=False)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(size) and (size == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def _ragged(column: pa.ChunkedArray | pa.Array, fill: float) -> np.ndarray:
    """Lists of different lengths as a matrix filled up with ``fill``."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = flat.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(size), int(size.max(initial=1))), fill)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(rows) if rows else np.zeros(0)))


def _top(key: np.ndarray, score: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k`` entries of each key, by score and then smallest id."""
    order = np.lexsort((least, -score, key))
    ends = np.flatnonzero(np.append(np.diff(key[order]) != 0, True)) + 1
    begin = np.concatenate([[0], ends[:-1]]) if len(order) else ends
    rank = np.arange(len(order)) - np.repeat(begin, ends - begin)
    return order[rank < k]


class _Search:
    """Rounds over one index: every request is a row (akey, same, label, lo, hi, thr, frm, to, v)."""

    def __init__(self, points: DataFrame, index: MultiIndex, blocks: int, parts: int, width: int):
        self.points, self.index, self.blocks, self.parts, self.width = points, index, blocks, parts, width

    def round(self, asks: DataFrame, k: int) -> DataFrame:
        """``akey, w, vec_id, score``: the best ``k`` rows of each block in each window, from cells with bounds in [frm, to]."""
        index, width, parts = self.index, self.width, self.parts

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell = np.argwhere(index.sizes > 0)
            first, cuts = index.first[cell[:, 0], cell[:, 1]], index.cuts[cell[:, 0], cell[:, 1]]
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    b = batch.slice(at, 64)
                    u, v = index.bounds(_matrix(b["v"], width))
                    frm, to = np.asarray(b["frm"]), np.asarray(b["to"])
                    row, block = [], []
                    for r in range(b.num_rows):
                        bound = u[r][cell[:, 0]] + v[r][cell[:, 1]]
                        hit = np.flatnonzero((bound >= frm[r]) & (bound <= to[r]))
                        mine = np.unique(first[hit])
                        wide = hit[cuts[hit] > 1]
                        if len(wide):
                            mine = np.unique(np.concatenate([mine, *[first[c] + np.arange(cuts[c]) for c in wide]]))
                        row.append(np.full(len(mine), r))
                        block.append(mine)
                    if row and sum(map(len, row)):
                        out = b.take(pa.array(np.concatenate(row)))
                        yield pa.record_batch([pa.array(np.concatenate(block).astype(np.int32)), *out.columns],
                                              ["block", *out.schema.names])

        def visit(points: pa.Table, asked: pa.Table) -> pa.Table:
            out = {"akey": [], "w": [], "score": [], "ids": []}
            if points.num_rows and asked.num_rows:
                points = points.sort_by([("i", "ascending"), ("j", "ascending")]).combine_chunks()
                x, label = _matrix(points["v"], width), np.asarray(points["label"])
                i, j = np.asarray(points["i"]), np.asarray(points["j"])
                ids = points["ids"].combine_chunks()
                least = ids.flatten().to_numpy(zero_copy_only=False)[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
                for at in range(0, asked.num_rows, 256):
                    q = asked.slice(at, 256).combine_chunks()
                    a, mine = _matrix(q["v"], width), np.asarray(q["label"])
                    u, v = index.bounds(a)
                    same = q["same"].to_numpy()
                    thr, hi = _ragged(q["thr"], np.inf), _ragged(q["hi"], -np.inf)
                    frm, to = np.asarray(q["frm"]), np.asarray(q["to"])
                    low, high = thr.min(1), hi.max(1)
                    found: list[np.ndarray] = []
                    for start in range(0, len(x), 4096):
                        end = min(len(x), start + 4096)
                        bound = u[:, i[start:end]] + v[:, j[start:end]]
                        take = (bound >= frm[:, None]) & (bound <= to[:, None])
                        rows = np.flatnonzero(take.any(1))
                        if not len(rows):
                            continue
                        score = a[rows] @ x[start:end].T
                        take = take[rows] & (score >= low[rows, None]) & (score <= high[rows, None])
                        take &= (mine[rows, None] == label[None, start:end]) == same[rows, None]
                        r, c = np.nonzero(take)
                        found.append(np.array([rows[r], c + start, score[r, c]]))
                    if not found:
                        continue
                    r, c, score = np.concatenate(found, axis=1)
                    r, c = r.astype(np.int64), c.astype(np.int64)
                    names = q["akey"].combine_chunks()
                    for w in range(thr.shape[1]):
                        inside = np.flatnonzero((score >= thr[r, w]) & (score <= hi[r, w]))
                        best = inside[_top(r[inside], score[inside], least[c[inside]], k)]
                        out["akey"].append(names.take(pa.array(r[best])))
                        out["w"].append(pa.array(np.full(len(best), w, np.int32)))
                        out["score"].append(pa.array(score[best]))
                        out["ids"].append(ids.take(pa.array(c[best])))
            kinds = {"akey": pa.string(), "w": pa.int32(), "score": pa.float64(), "ids": pa.list_(pa.int64())}
            return pa.table({n: pa.chunked_array([p.cast(kinds[n]) for p in out[n]], kinds[n]) for n in kinds})

        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asks.schema.fields)
        sent = asks.mapInArrow(send, f"block int, {fields}")
        left = self.points.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        right = sent.withColumn("part", F.pmod(F.xxhash64("akey"), F.lit(parts)).cast("int"))
        key = ["block", "part"]
        pairs = left.groupBy(key).cogroup(right.groupBy(key))
        found = pairs.applyInArrow(visit, "akey string, w int, score double, ids array<bigint>")
        return found.select("akey", "w", F.explode("ids").alias("vec_id"), "score")

    def run(self, asks: DataFrame, k: int, what: str) -> DataFrame:
        """``akey, w, vec_id, score, rank``: certified best ``k`` rows of each window of ``asks`` (akey, v, label, same, lo, hi, tau)."""
        best = Window.partitionBy("akey", "w").orderBy(F.desc("score"), "vec_id")

        def ranked(found: DataFrame) -> DataFrame:
            return (found.groupBy("akey", "w", "vec_id").agg(F.max("score").alias("score"))
                    .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k))

        top = F.lit(float("inf"))
        one = asks.select("*", F.col("lo").alias("thr"), F.col("tau").alias("frm"), top.alias("to")).drop("tau", "lo")
        found = stored(ranked(self.round(one, k)), what + "-first")
        full = found.filter(F.col("rank") == k).groupBy("akey").agg(
            F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("full"))
        thr = F.when(F.col("full").isNull(), F.col("lo")).otherwise(
            F.transform("lo", lambda x, w: F.coalesce(F.col("full")[w], x)))
        rest = (asks.join(full, "akey", "left").withColumn("thr", thr).withColumn("frm", F.array_min("thr"))
                .select(*[c for c in asks.columns if c not in ("lo", "tau")], "thr", "frm",
                        (F.col("tau") + F.abs("tau") * 1e-9 + 1e-6).alias("to")).filter(F.col("frm") <= F.col("to")))
        more = self.round(rest, k)
        return stored(ranked(found.drop("rank").unionByName(more)), what)


def mine(vectors: DataFrame, anchors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         of: int = 100, scale: int = 256, seed_rows: int = 512, block_rows: int | None = None,
         anchor_rows: int = 8192, seed: int = 23) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of ``anchors``.

    Components become ``floor(scale * x)``; a score is the integer inner product
    with the anchor (exact below 2**53).  An anchor's positives are its first
    ``positives`` other rows of the same label; for each of them the first
    ``negatives`` rows of other labels whose score ``n`` satisfies
    ``low * p <= of * n <= high * p`` are returned.  Higher scores come first,
    ties by smaller id.  A window without rows gives no row, so a positive with
    a negative score (its window is empty) gives none.

    Rows with a null id, label or vector, an empty vector, or any null or
    non-finite component take no part; a shorter vector counts as filled up with
    zeros.  Rows that repeat an id, label and vector count once; a row is never
    the positive of an anchor with its own id.  An empty table gives no rows.
    Other columns are not carried.
    """
    def clean(df: DataFrame) -> DataFrame:
        v = F.col(vector_col)
        good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
        return (df.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & good & (F.size(v) > 0))
                .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("v"))
                .distinct())

    most = max(positives + 1, negatives)
    copies = Window.partitionBy("v", "label").orderBy("id")
    entries = (clean(vectors).withColumn("at", F.row_number().over(copies)).filter(F.col("at") <= most)
               .groupBy("v", "label").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    entries = stored(entries, "negatives-entries")
    n, width = entries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    key = F.concat_ws(":", "label", F.xxhash64("v"), F.xxhash64(F.reverse("v")))
    rows = stored(clean(anchors).withColumn("akey", key), "negatives-anchors")
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)

    sample = entries.select("v").orderBy(F.xxhash64("v", F.lit(seed))).limit(SAMPLE).toArrow()
    x, half = _matrix(sample["v"], width), (width + 1) // 2
    codes = min(CODES, max(2, round((n / 16) ** 0.5)))
    index = MultiIndex((lloyd(x[:, :half], codes, 8, seed), lloyd(x[:, half:], codes, 8, seed + 1)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                i, r, j, s = index.codes(_matrix(b["v"], width))
                yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(r), pa.array(s),
                                       b["label"], b["ids"], b["v"]], ["i", "j", "r", "s", "label", "ids", "v"])

    coded = stored(entries.select("label", "ids", "v").mapInArrow(
        assign, "i int, j int, r double, s double, label bigint, ids array<bigint>, v array<double>"), "negatives-coded")
    cells = coded.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r"), F.max("s").alias("s")).collect()
    sizes = np.zeros([len(b) for b in index.books], np.int64)
    radii = np.zeros(len(index.books[0])), np.zeros(len(index.books[1]))
    for c in cells:  # at most CODES x CODES of them
        sizes[c["i"], c["j"]] = c["n"]
        radii[0][c["i"]], radii[1][c["j"]] = max(radii[0][c["i"]], c["r"]), max(radii[1][c["j"]], c["s"])
    rows_of = block_rows or min(65_536, max(1024, n // 64))
    cuts = np.maximum(1, -(-sizes // rows_of))
    wide = cuts > 1
    begin = np.cumsum(np.where(wide, 0, sizes).ravel()) - np.where(wide, 0, sizes).ravel()
    first = (begin // rows_of).reshape(sizes.shape)
    shared = int(first.max()) + 1
    first[wide] = shared + np.cumsum(cuts[wide]) - cuts[wide]
    blocks = shared + int(cuts[wide].sum())
    index = MultiIndex(index.books, radii, sizes, first, cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i, j, deal = np.asarray(b["i"]), np.asarray(b["j"]), np.asarray(b["deal"])
            block = first[i, j] + deal % cuts[i, j]
            yield pa.record_batch([pa.array(block.astype(np.int32)), *[b[c] for c in ("i", "j", "label", "ids", "v")]],
                                  ["block", "i", "j", "label", "ids", "v"])

    points = stored(coded.withColumn("deal", F.pmod(F.xxhash64("v", "label"), F.lit(1 << 30)).cast("int")).mapInArrow(
        place, "block int, i int, j int, label bigint, ids array<bigint>, v array<double>"), "negatives-points")

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, v = index.bounds(_matrix(b["v"], width))
            tau = [index.first_cells(u[r], v[r], seed_rows) for r in range(b.num_rows)]
            yield pa.record_batch([*b.columns, pa.array(tau, pa.float64())], [*b.schema.names, "tau"])

    asks = rows.groupBy("akey").agg(F.first("v").alias("v"), F.first("label").alias("label"), F.count(F.lit(1)).alias("times"))
    asks = stored(asks.mapInArrow(prepare, "akey string, v array<double>, label bigint, times bigint, tau double"), "negatives-asks")
    parts = -(-asks.count() // anchor_rows) or 1
    search = _Search(points, index, blocks, parts, width)

    ends = [F.array(F.lit(-float("inf"))).alias("lo"), F.array(F.lit(float("inf"))).alias("hi")]
    base = ["akey", "v", "label", "tau"]
    same = search.run(asks.select(*base, F.lit(True).alias("same"), *ends), positives + 1, "negatives-positives")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [[int(p) for p in s] for s in b["scores"].to_pylist()]
            lo = _lists([np.array([-(-low * p // of) for p in s], float) for s in scores])
            hi = _lists([np.array([high * p // of for p in s], float) for s in scores])
            yield pa.record_batch([b["akey"], b["scores"], lo, hi], ["akey", "scores", "lo", "hi"])

    caps = (same.groupBy("akey").agg(F.sort_array(F.collect_set("score")).alias("scores"))
            .mapInArrow(windows, "akey string, scores array<double>, lo array<double>, hi array<double>"))
    caps = stored(caps, "negatives-caps")
    other = search.run(asks.select(*base, F.lit(False).alias("same")).join(caps.drop("scores"), "akey"), negatives,
                       "negatives-found")

    # an anchor vector with very many rows: its few positives and negatives are dealt out with them
    deals = F.ceil(F.col("times") / 4096).cast("int")
    times = asks.select("akey", deals.alias("deals"))
    own = rows.join(times, "akey").withColumn("deal", F.pmod(F.xxhash64("id"), F.col("deals")).cast("int"))
    dealt = times.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
    after = Window.partitionBy("anchor_id", "akey").orderBy(F.desc("positive_score"), "positive_id")
    pos = (own.select(F.col("id").alias("anchor_id"), "akey", "deal")
           .join(same.join(dealt, "akey").select("akey", "deal", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                 ["akey", "deal"]).filter("positive_id <> anchor_id")
           .withColumn("at", F.row_number().over(after)).filter(F.col("at") <= positives).drop("at"))
    score_of = caps.select("akey", F.posexplode("scores").alias("w", "positive_score"))
    neg = (other.join(score_of, ["akey", "w"]).join(dealt, "akey")
           .select("akey", "deal", "positive_score", F.col("rank").cast("int").alias("rank"),
                   F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))
    return (pos.join(neg, ["akey", "deal", "positive_score"])
            .select("anchor_id", "positive_id", "rank", "negative_id", F.col("positive_score").cast("long").alias("positive_score"),
                    F.col("negative_score").cast("long").alias("negative_score")))
