"""Operator 13: periodic runs of words by online sparse diagonal dynamic programming.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical) that no neighbouring word extends, at least
``max(shortest, copies * q)`` words long.  Words are read left to right.  Each
word's earlier occurrences that end an equal word gram lie on diagonals, one for
each lag; they increment the match lengths of active lags and open new ones, and
a diagonal that ends with sufficient length emits its run at once.  Every run
matches at its lag for ``2 / 3`` of ``shortest`` words or more, so a diagonal is
opened only by an equal gram of that many words (a power of two); texts without
equal grams are never looked at word by word.

Inside a run with period ``q`` two kinds of lags are not followed, which keeps a
text of one word repeated linear: multiples of ``q`` end where the run ends and
have its start, so they would only repeat it; other lags of ``q / (copies - 1)`` or more
cannot be a whole run inside it (two periods over so many words would have a
common divisor as a period), so those alive at its end are opened there.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import blocks, solid

SHORTEST, COPIES = 24, 3

_FIELDS = ("start", "length", "period")
_RUN = "struct<start: bigint, length: bigint, period: bigint>"
_ARROW_RUN = pa.struct([(name, pa.int64()) for name in _FIELDS])


def gram_width(shortest: int, copies: int) -> int:
    """Words that any run matches at its lag, rounded down to a power of two."""
    least = min(max(shortest - q, (copies - 1) * q) for q in range(1, shortest + 1))
    return 1 << (least.bit_length() - 1)


def grams(codes: np.ndarray, width: int) -> np.ndarray:
    """An exact name for the ``width`` codes (a power of two) from each place on; places near the end are cut."""
    names, step = codes.astype(np.int64), 1
    while step < width and len(names) > step:
        names = np.unique(names[:-step] * (int(names.max()) + 1) + names[step:], return_inverse=True)[1]
        step *= 2
    return names if step == width else names[:0]


def find_runs(codes: list[int], places: dict[int, list[int]], width: int, shortest: int, copies: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start and period.

    ``places`` holds, for each place whose gram has occurred before, all places
    of that gram in the text in increasing order (one list, shared by them).
    """
    n = len(codes)
    runs: list[tuple[int, int, int]] = []
    active: dict[int, int] = {}  # lag -> words matched up to the last word read
    period, first = 0, 0  # the smallest lag matched for a whole period, and where its stretch starts
    before = -2

    def close(ended: list[int], at: int) -> None:
        """Emit the diagonals ``ended``, whose last match is the word ``at``."""
        seen = set()
        for q in sorted(ended):
            size = active[q] + q
            start = at - size + 1
            if size >= max(shortest, copies * q) and start not in seen:
                seen.add(start)  # a larger lag over the same words is not their smallest period
                runs.append((start, size, q))

    def reopen(place: int) -> None:
        """Open the lags left out inside the run that ends with the gram at ``place``."""
        own = places[place]
        at = place + width - 1
        for p in own[bisect_left(own, first):bisect_left(own, place)]:
            q = place - p
            if q % period and q not in active:
                k = width
                while at - k - q >= 0 and codes[at - k] == codes[at - k - q]:
                    k += 1
                active[q] = k

    for place in sorted(places):
        own = places[place]
        at = place + width - 1
        if place != before + 1:
            close(list(active), before + width - 1)
            active.clear()
            period = 0
        elif period and codes[at] != codes[at - period]:
            reopen(before)
            period = 0
        ended = [q for q in active if codes[at] != codes[at - q]]
        if ended:
            close(ended, at - 1)
            for q in ended:
                del active[q]
        for q in active:
            active[q] += 1
        top = bisect_left(own, place)
        # a lag opened at p needs copies * lag words from p on
        low = bisect_left(own, -((n - copies * place) // (copies - 1)), 0, top)
        if period:
            inside = bisect_left(own, first, low, top)
            near = bisect_left(own, place - (period - 1) // (copies - 1), inside, top)
            opened = own[low:inside] + own[near:top]
            for q in [q for q in active if q != period and q % period == 0 and place - q >= first]:
                del active[q]
        else:
            opened = own[low:top]
        for p in opened:
            q = place - p
            if q not in active and not (period and q % period == 0 and p >= first):
                active[q] = width
        if not period:
            whole = [q for q, k in active.items() if k >= q]
            if whole:
                period = min(whole)
                first = at - active[period] - period + 1
        before = place
    close(list(active), before + width - 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def block_runs(flat: pa.Array, count: np.ndarray, shortest: int, copies: int) -> list[list[tuple[int, int, int]]]:
    """Runs of each text of a block, given all its words and the number of words of each text."""
    width = gram_width(shortest, copies)
    out: list[list[tuple[int, int, int]]] = [[] for _ in count]
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    names = grams(codes, width) if len(codes) else codes
    if not len(names):
        return out
    start = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(count)), count)
    whole = np.flatnonzero(owner[:len(names)] == owner[width - 1:width - 1 + len(names)])  # grams inside one text
    order = whole[np.argsort(names[whole], kind="stable")]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (names[order][1:] != names[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    group = np.cumsum(fresh) - 1
    many = np.bincount(group, minlength=1)
    ends = np.cumsum(many)
    by_text: dict[int, list[int]] = {}
    for g in np.flatnonzero(many > 1):
        by_text.setdefault(int(owner[order[ends[g] - 1]]), []).append(int(g))
    for text, groups in by_text.items():
        if count[text] < shortest:
            continue
        places: dict[int, list[int]] = {}
        for g in groups:
            own = (order[ends[g] - many[g]:ends[g]] - start[text]).tolist()
            for p in own[1:]:
                places[p] = own
        out[text] = find_runs(codes[start[text]:start[text] + count[text]].tolist(), places, width, shortest, copies)
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest exact length / period; ties go to the smaller start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
                  copies: int = COPIES) -> DataFrame:
    """One row per document: id, ``n_words``, ``runs``, ``strongest`` and ``collapsed``.

    ``runs`` lists every run (start, length, period; in words from 0) by start
    and period, ``strongest`` is the one with the greatest length / period
    (null without runs).  ``collapsed`` is the text's words joined by one space, without
    those that some run contains after its first ``period`` words.  A null text
    counts as one without words: no runs, an empty collapsed text.  Repeated
    rows and ids are documents of their own; an id may be null.  Other columns
    are not carried.  One narrow pass: nothing is shuffled, and a task holds
    one text or about 4 MB of texts at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, "text"):
                lists = pc.ascii_split_whitespace(solid(b["text"]))
                owner = np.repeat(np.arange(b.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                words = lists.flatten()
                full = pc.not_equal(words, "")
                words, owner = words.filter(full), owner[full.to_numpy(zero_copy_only=False)]
                count = np.bincount(owner, minlength=b.num_rows)
                found = block_runs(words, count, shortest, copies)
                keep = np.ones(len(words), bool)
                for begin, runs in zip(np.cumsum(count) - count, found, strict=True):
                    for start, length, period in runs:
                        keep[begin + start + period:begin + start + length] = False
                kept = words.filter(pa.array(keep))
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=b.num_rows))])
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), kept.cast(pa.string())), " ")
                rows = [[dict(zip(_FIELDS, r, strict=True)) for r in runs] for runs in found]
                best = [runs and dict(zip(_FIELDS, strongest(runs), strict=True)) or None for runs in found]
                yield pa.record_batch([b["id"], pa.array(count.astype(np.int64)), pa.array(rows, pa.list_(_ARROW_RUN)),
                                       pa.array(best, _ARROW_RUN), joined],
                                      ["id", "n_words", "runs", "strongest", "collapsed"])

    kind = dict(docs.select(F.col(id_col).alias("id")).dtypes)["id"]
    out = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
           .mapInArrow(run, f"id {kind}, n_words long, runs array<{_RUN}>, strongest {_RUN}, collapsed string"))
    return out.withColumnRenamed("id", id_col)

