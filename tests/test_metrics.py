"""G2 metric goldens and the bucketed AUC against a brute-force rank sum."""

import random

import pytest

from recspark.operators import metrics as M


def _df(spark, ys, ps, gs=None):
    gs = gs or ["a"] * len(ys)
    return spark.createDataFrame(list(zip(gs, ys, ps)), "g string, y int, p double")


def test_auc_accuracy_logloss(spark):
    df = _df(spark, [0, 1, 0, 1, 0], [.1, .2, .35, .8, .7])
    r = M.classification_metrics(df, "y", "p").first()
    assert r.auc == pytest.approx(0.666667, abs=1e-6)
    assert r.accuracy == pytest.approx(0.6)
    assert r.logloss == pytest.approx(0.714540, abs=1e-6)


def test_single_class_is_zero(spark):
    assert M.auc(_df(spark, [1, 1], [.3, .4]), "y", "p").first().auc == 0.0


def test_gauc(spark):
    df = _df(spark, [0, 1, 0, 1, 0, 1], [.1, .2, .35, .8, .9, .4], ["u1", "u1", "u2", "u2", "u2", "u3"])
    g = M.gauc(df, "y", "p", "g").first()
    assert g.gauc_reference == pytest.approx(0.194444, abs=1e-6)
    assert g.gauc_weighted == pytest.approx(0.583333, abs=1e-6)
    assert g.gauc_standard == pytest.approx(0.7, abs=1e-6)


def _brute(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    if not pos or not neg:
        return 0.0
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_bucketed_auc_matches_brute_force_with_ties(spark):
    rnd = random.Random(3)
    ys = [rnd.randint(0, 1) for _ in range(400)]
    ps = [round(rnd.random(), 2) for _ in range(400)]  # many ties
    gs = [f"g{rnd.randint(0, 5)}" for _ in range(400)]
    df = _df(spark, ys, ps, gs)
    assert M.auc(df, "y", "p", buckets=7).first().auc == pytest.approx(_brute(ys, ps), abs=1e-12)
    per = {r.g: r.auc for r in M.auc_table(df, "y", "p", ["g"], buckets=3).collect()}
    for g in set(gs):
        sub = [(y, p) for y, p, gg in zip(ys, ps, gs) if gg == g]
        assert per[g] == pytest.approx(_brute([a for a, _ in sub], [b for _, b in sub]), abs=1e-12)


def test_rela_impr(spark):
    from pyspark.sql import functions as F
    r = spark.range(1).select(M.rela_impr(F.lit(0.75), F.lit(0.7)).alias("x")).first()
    assert r.x == pytest.approx(0.25)


def test_tie_modes(spark):
    df = spark.createDataFrame([(0, 1, .5), (1, 0, .5), (2, 1, .9), (3, 0, .1)], "i long, y int, p double")
    avg = M.auc(df, "y", "p").first().auc
    ordered = M.auc(df, "y", "p", ties="order", order="i").first().auc
    # pairs: (.9 > .5, .1), (.5 vs .5 tie, .5 > .1): average 3.5/4; stable order puts the positive first -> 3/4
    assert avg == pytest.approx(0.875) and ordered == pytest.approx(0.75)
    from pyspark.sql import functions as F
    g2 = _df(spark, [0, 1, 0, 1, 0], [.1, .2, .35, .8, .7]).withColumn("i", F.col("p"))
    assert M.auc(g2, "y", "p", ties="order", order="i").first().auc == pytest.approx(0.666667, abs=1e-6)
    with pytest.raises(ValueError):
        M.auc(df, "y", "p", ties="order")
