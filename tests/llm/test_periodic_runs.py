import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa

from recspark.llm import periodic_runs as P
from recspark.llm.queries import op13_periodic_runs


def brute(w, shortest=24, copies=3):
    """Every lag's matching stretches; of equal stretches the smallest period."""
    n, best = len(w), {}
    for q in range(1, n // copies + 1):
        i = q
        while i < n:
            if w[i] == w[i - q]:
                j = i
                while j + 1 < n and w[j + 1] == w[j + 1 - q]:
                    j += 1
                if j - i + 1 + q >= max(shortest, copies * q):
                    best.setdefault((i - q, j - i + 1 + q), q)
                i = j + 1
            i += 1
    return sorted([(s, n, q) for (s, n), q in best.items()], key=lambda r: (r[0], r[2]))


def text(rnd):
    k, out = rnd.choice([1, 2, 2, 3, 5, 50]), []
    while len(out) < rnd.randint(0, 250):
        kind = rnd.random()
        if kind < .4:
            out += [str(rnd.randrange(k)) for _ in range(rnd.randint(1, 30))]
        elif kind < .9:
            b = [str(rnd.randrange(k)) for _ in range(rnd.randint(1, 25))]
            if rnd.random() < .4:  # a run inside each copy of a longer one
                b += b[:rnd.randint(1, 3)] * rnd.randint(2, 15)
            out += (b * rnd.randint(2, 12))[:rnd.randint(10, 200)]
        elif out:
            a = rnd.randrange(len(out))
            out += out[a:a + rnd.randint(1, 100)] * rnd.randint(1, 3)
    return out


def test_runs_equal_brute_force():
    rnd = random.Random(1)
    for _ in range(120):
        docs = [text(rnd) for _ in range(5)]
        flat = pa.array([x for d in docs for x in d], pa.large_string())
        assert P.block_runs(flat, np.array([len(d) for d in docs]), 24, 3) == [brute(d) for d in docs]
        assert P.block_runs(flat, np.array([len(d) for d in docs]), 9, 2) == [brute(d, 9, 2) for d in docs]


def test_long_texts_stay_linear():
    for doc, runs in ((["a"] * 200_000, 1), (["a", "b", "c"] * 60_000, 1), ([str(i) for i in range(100_000)], 0),
                      (([str(i) for i in range(500)] + ["x", "y"] * 20) * 200, 201)):
        assert len(P.block_runs(pa.array(doc, pa.large_string()), np.array([len(doc)]), 24, 3)[0]) == runs


def test_operator_on_odd_rows(spark):
    rows = [(1, None, 1), (None, "", 1), (2, " \n\t ", 1), (3, "a " * 30, 1), (3, "a " * 30, 1), (4, "x  y\n" * 12 + "z", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    out = sorted(P.periodic_runs(df).collect(), key=lambda r: (r["doc_id"] or 0))
    assert [r["n_words"] for r in out] == [0, 0, 0, 30, 30, 25]
    assert [r["collapsed"] for r in out] == ["", "", "", "a", "a", "x y z"]
    assert [tuple(r["strongest"]) if r["strongest"] else None for r in out] == [None] * 3 + [(0, 30, 1)] * 2 + [(0, 24, 2)]
    assert P.periodic_runs(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(2)
    docs = [(i, " ".join(text(rnd) if i % 3 else [rnd.choice("abcdefgh") + str(rnd.randrange(40)) for _ in range(rnd.randrange(400))]))
            for i in range(150)] + [(1000, None), (1001, ""), (None, "a " * 40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(w), zlib.crc32(str(i).encode()) if i is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = brute(w)
        keep = [True] * n
        for s, m, q in runs:
            keep[s + q:s + m] = [False] * (m - q)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in
               ("".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(x for x, k in zip(w, keep, strict=True) if k))]
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha))
    assert got == sorted(want, key=str) and any(r[1] for r in got)
