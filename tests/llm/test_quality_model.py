import random

import numpy as np
import pyarrow as pa

from recspark.llm import quality_model as Q


def corpus(n=600, seed=2):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(1, 9))) for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randint(20, 300))]
        good = rnd.random() < 0.8
        if not good:
            k = rnd.randint(0, 2)
            w = [x.upper() + "!!" for x in w] if k == 0 else [rnd.choice(w)] * len(w) if k == 1 else [x + "###" for x in w]
        docs.append((i, " ".join(w), "clash", 5.0))
        labels.append((i, int(good)))
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    docs, labels = corpus()
    edge = [(None, None, "x", 1.0), (9001, "", None, 1.0), (9002, "#" * 200_000, "x", 1.0), (9003, "a " * 50_000, "x", 1.0)]
    df = spark.createDataFrame(docs + edge + docs[:1], "doc_id long, text string, score string, extra double")
    lab = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    model = Q.fit(df, lab)
    out = Q.score(df, model).collect()
    assert len(out) == len(docs) + 5 and all(0 <= r["score"] <= 1 and r["extra"] for r in out)
    from zlib import crc32
    truth = dict(labels)
    held = [r for r in out if r["doc_id"] in truth and crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.3) == truth[r["doc_id"]] for r in held]) > 0.95
    low, high = (np.mean([r["score"] for r in held if truth[r["doc_id"]] == k]) for k in (0, 1))
    assert high - low > 0.8
    again = {r["doc_id"]: r["score"] for r in Q.score(df.select("text", "doc_id"), model).collect()}
    assert all(again[r["doc_id"]] == r["score"] for r in out)


def test_no_labels_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in Q.score(df, Q.fit(df, none)).collect()] == [0.5, 0.5]
    assert Q.score(df.limit(0), Q.fit(df.limit(0), none)).collect() == []


def test_pool_is_isotonic_and_keeps_the_mean():
    rng = np.random.default_rng(1)
    w, y = rng.integers(1, 5, 50).astype(float), rng.random(50)
    x, v = Q.pool(np.arange(50.0), w, y * w)
    assert (np.diff(v) > 0).all() and (np.diff(x) > 0).all()
    brute = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(k, 50)) for a in range(k + 1)) for k in range(50)]
    assert np.allclose(sorted(set(np.round(brute, 9))), np.round(v, 9))


def test_statistics_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["a a b\nb b\nb b", "", "Zed 12, ü!", " \t\n"]
    together = Q.statistics(pa.array(texts, pa.large_string()))
    for k, t in enumerate(texts):
        assert np.array_equal(together[k], Q.statistics(pa.array([t], pa.large_string()))[0])
