"""Encoding by matrix products agrees with the definition, ties and large codebooks included."""

import numpy as np
import pytest

from recspark.operators import semantic as SM


def _by_definition(x, layers):
    codes, norms, left = [], [], [float(v) for v in x]
    for book in layers:
        def far(c):
            total = 0.0
            for a, b in zip(left, c[1]):
                total += (a - b) * (a - b)
            return total
        code, best = min(sorted(book), key=far)  # the first of equals
        left = [a - b for a, b in zip(left, best)]
        codes.append(code)
        total = 0.0
        for a in left:
            total += a * a
        norms.append(total)
    return codes, [a - b for a, b in zip([float(v) for v in x], left)], norms


@pytest.mark.parametrize("kind", ["spread", "ties", "offset"])
def test_encode_equals_the_definition(spark, kind):
    rng = np.random.default_rng(4)
    if kind == "ties":  # few distinct values: equal distances and equal codes everywhere
        x = rng.integers(0, 3, (150, 6)).astype(float)
        books = [rng.integers(0, 3, (40, 6)).astype(float) for _ in range(2)]
    else:  # a large common offset leaves the matrix product little precision
        add = 1e6 if kind == "offset" else 0.0
        x = rng.normal(size=(150, 6)) + add
        books = [rng.normal(size=(40, 6)) + add, rng.normal(size=(40, 6)) * 1e-3]
    layers = [[(i * 3 + 1, list(map(float, v))) for i, v in enumerate(b)] for b in books]
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id int, vec array<double>")
    book = spark.createDataFrame([(la, c, v) for la, b in enumerate(layers) for c, v in b],
                                 "layer int, code int, vec array<double>")
    got = {r.id: r for r in SM.rq_encode(df, "vec", book, 2).collect()}
    assert len(got) == 150
    for i, v in enumerate(x):
        codes, quantized, norms = _by_definition(v, layers)
        assert (got[i].codes, got[i].quantized, got[i].residual_norms) == (codes, quantized, norms)


def test_vectors_without_a_code(spark):
    book = spark.createDataFrame([(0, 0, [0.0, 0.0]), (0, 1, [1.0, 1.0])], "layer int, code int, vec array<double>")
    rows = [(0, [0.9, 0.9]), (1, None), (2, [1.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, []), (6, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "id int, vec array<double>")
    got = {r.id: (r.codes, r.quantized, r.residual_norms) for r in SM.rq_encode(df, "vec", book, 1).collect()}
    assert got[0][0] == [1] and got[6][0] == [0]
    assert all(got[i] == (None, None, None) for i in (1, 2, 3, 4, 5))
    none = SM.rq_encode(df, "vec", book, 2).collect()  # the second layer has no codes
    assert all(r.codes is None for r in none) and len(none) == 7
    assert SM.rq_encode(df.limit(0), "vec", book, 1).count() == 0


def test_nearest_of_a_large_codebook():
    rng = np.random.default_rng(8)
    x, codes = rng.normal(size=(3000, 16)), rng.normal(size=(2048, 16))
    want = np.concatenate([((x[a:a + 100, None, :] - codes) ** 2).sum(2).argmin(1) for a in range(0, 3000, 100)])
    assert (SM.nearest_rows(x, codes) == want).all()


def test_vectors_are_encoded_in_one_place(spark):
    df = spark.createDataFrame([(i, [float(i % 5), float(i % 3)]) for i in range(40)] + [(40, None), (41, [1.0]), (42, [float("nan"), 1.0])],
                               "id long, vec array<double>")
    books = spark.createDataFrame([(0, c, [float(c), 1.0]) for c in range(4)] + [(1, c, [0.0, c - 1.0]) for c in range(3)],
                                  "layer int, code int, vec array<double>")
    from recspark.operators import semantic as SM
    out = SM.rq_encode(df, "vec", books, 2).where("codes is not null").select("id", "codes", "residual_norms")
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert out.count() == 40 and {r.codes[0] for r in out.collect()} == {0, 1, 2, 3}
