import numpy as np
import pytest

from recspark.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score string, v int"


def brute(rows, anchors, positives=5, negatives=10):
    good = {(i, label, tuple(np.floor(256 * np.array(v, np.float32).astype(float)))) for i, v, label in rows
            if i is not None and v and label is not None and None not in v and np.isfinite(v).all()}
    out = []
    for a, own, u in good:
        if a not in anchors:
            continue
        score = sorted((-int(np.dot(u, v)), i, label) for i, label, v in good)
        pos = [(i, -s) for s, i, label in score if label == own and i != a][:positives]
        for p, ps in pos:
            neg = [(i, -s) for s, i, label in score if label != own and 30 * ps <= -100 * s <= 90 * ps][:negatives]
            out += [(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(neg)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA)
    return sorted(map(tuple, H.mine(df, df.filter("vec_id % 100 = 0"), **options).collect()))


@pytest.mark.parametrize("options", [{}, {"block_rows": 60, "anchor_rows": 3, "seed_rows": 20}])
def test_equals_brute_force(spark, options):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(12, 9))
    x = centre[rng.integers(0, 12, 900)] + rng.normal(size=(900, 9)) * rng.choice([0.1, 1.0], (900, 1))
    x = (x / 3).round(2)
    rows = [(i, x[i].astype("f4").tolist(), int(rng.integers(0, 4))) for i in range(900)]
    rows += [(1000 + i, rows[0][1], int(i % 2)) for i in range(200)]  # one vector many times, with two labels
    assert run(spark, rows, **options) == brute(rows, set(range(0, 2000, 100)))


def test_second_round_completes_the_windows(spark, monkeypatch):
    """With one row seen by the heap, nearly everything comes from the certified second round."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=16).astype("f4").tolist(), int(rng.integers(0, 3))) for i in range(400)]
    assert run(spark, rows, seed_rows=1) == brute(rows, {0, 100, 200, 300})


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (2, [0.25, 0.0], 2), (3, [0.25, 0.0], 3), (4, None, 1),
            (5, [1.0, None], 1), (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 2), (8, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
            (100, [-1.0, 0.5], 1), (200, [0.0, 0.0], 2), (300, [], 2), (400, [0.3, 0.3], 9)]
    assert run(spark, rows) == brute(rows, {0, 100, 200, 300, 400})
    assert run(spark, rows[:2]) == [] and run(spark, []) == []


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x, a = rng.normal(size=(500, 10)) * 50, rng.normal(size=(20, 10)) * 50
    index = H.MultiIndex((H.lloyd(x[:, :5], 8, 5, 1), H.lloyd(x[:, 5:], 8, 5, 2)))
    i, r, j, s = index.codes(x)
    radii = tuple(np.array([d[c == k].max(initial=0) for k in range(8)]) for c, d in ((i, r), (j, s)))
    sizes = np.zeros((8, 8), int)
    np.add.at(sizes, (i, j), 1)
    index = H.MultiIndex(index.books, radii, sizes)
    u, v = index.bounds(a)
    assert (a @ x.T <= u[:, i] + v[:, j]).all()
    for k in range(len(a)):  # the heap's cells are those of the highest bounds
        tau = index.first_cells(u[k], v[k], 100)
        bound = u[k][:, None] + v[k][None, :]
        assert sizes[bound >= tau].sum() >= 100 > sizes[bound > tau].sum()
