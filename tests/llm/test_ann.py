import numpy as np

from recspark.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, dim string, v int"


def brute(rows, queries, k=5):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v
            and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q, u in good:
        if q not in queries:
            continue
        u = np.array(u, float)
        near = [(-(np.array(v) * u).sum() / np.sqrt((np.array(v) ** 2).sum()) / np.sqrt((u * u).sum()), i)
                for i, v in good if i != q and len(v) == len(u)]
        out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def test_recall_on_vectors_without_structure(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 64)).astype("f4")
    rows = [(i, x[i].tolist(), "a", 1) for i in range(len(x))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in A.nearest(df, df.filter("vec_id % 50 = 0"), block=100).collect():
        got.setdefault(r["query_id"], []).append(r)
    want = brute([(i, v) for i, v, *_ in rows], set(range(0, 3000, 50)))
    assert got.keys() == want.keys()
    hits = sum(len({r["vec_id"] for r in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    for q, rs in got.items():
        assert [r["rank"] for r in sorted(rs, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]
        for r in rs:
            a, b = x[q].astype(float), x[r["vec_id"]].astype(float)
            assert abs(r["score"] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_ties_bad_vectors_and_few_candidates(spark):
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(0, 40)] + [(50, [1.0, 0.0, 2.0]), (100, [-1.0, 3.0, 0.0])]
    rows += [(150, None), (200, [0.0, 0.0, 0.0]), (250, [1.0, None, 1.0]), (300, [float("nan"), 1.0, 1.0]),
             (350, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (400, [1.0, 2.0]), (450, [2.0, 1.0]),
             (500, [1.0]), (0, [1.0, 0.0, 2.0]), (550, [])]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    queries = df.filter("vec_id % 50 = 0")
    got = {}
    for r in A.nearest(df, queries).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = {q: v for q, v in brute(rows, set(range(0, 600, 50))).items() if v}
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    assert A.nearest(df.limit(0), queries.limit(0)).collect() == []


def test_two_hashes_find_exact_copies_scaled(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 16))
    rows = [(i, (x[i // 2] * (1 + i % 2)).astype("f4").tolist(), None, None) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = A.nearest(df, df.filter("vec_id % 50 = 0"), k=1, hashes=2, probes=8).collect()
    assert all(r["vec_id"] == r["query_id"] + 1 and r["score"] > 1 - 1e-6 for r in out) and len(out) == 8
