import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from recspark.llm import toxicity as T


def corpus(n=1500):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9))) for _ in range(2500)]
    bad = ["".join(rnd.choice("kqxzvw") for _ in range(rnd.randint(4, 9))) for _ in range(40)]
    docs, labels = [], []
    for i in range(n):
        w = [vocab[int(2500 * rnd.random() ** 2)] for _ in range(rnd.randint(40, 400))]
        toxic = i % 8 == 3
        if toxic:
            for _ in range(max(3, len(w) // 40)):
                w[rnd.randrange(len(w))] = rnd.choice(bad)
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    return d, y, dict(labels), T.fit(d, y)


def test_held_out_accuracy(fitted):
    d, _, labels, model = fitted
    out = [(r["doc_id"], r["score"]) for r in T.score(d, model).collect()]
    held = [(labels[i], s) for i, s in out if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([s >= 0.5 for y, s in held if y]) > 0.9
    assert np.mean([s >= 0.5 for y, s in held if not y]) < 0.03
    assert all(0 <= s <= 1 for _, s in out)


def test_gains_equal_brute_force(fitted):
    _, _, _, model = fitted
    docs, _ = corpus(30)
    texts = pa.array([t for _, t in docs] + ["", None, "one", docs[3][1] * 30])
    got = model.gains(texts)
    sides = [zstandard.ZstdCompressor(level=T.LEVEL, dict_data=zstandard.ZstdCompressionDict(c, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                      write_checksum=False, write_content_size=False, write_dict_id=False)
             for c in (model.ordinary, model.ordinary + model.toxic)]
    for k, text in enumerate(texts.to_pylist()):
        codes, _ = T.coded(pa.array([text]))
        parts = [codes[a:a + T.WINDOW].tobytes() for a in range(0, len(codes), T.WINDOW)]
        saved = [len(sides[0].compress(p)) - len(sides[1].compress(p)) for p in parts]
        assert got[k].tolist() == [len(parts)] + [sum(s >= g for s in saved) for g in range(1, T.GAINS + 1)]


def test_labels_of_the_held_out_fold_change_nothing(spark, fitted):
    d, y, _, model = fitted
    other = y.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    again = T.fit(d, other)
    assert (again.ordinary, again.toxic, again.gain) == (model.ordinary, model.toxic, model.gain)
    assert again.values.tolist() == model.values.tolist()


def test_odd_rows_and_few_labels(spark, fitted):
    d, y, labels, model = fitted
    rows = spark.createDataFrame([(1, None, 2.0), (1, "", 2.0), (None, "a text", 3.0)], "doc_id long, text string, score double")
    out = T.score(rows, model).collect()
    assert len(out) == 3 and all(r["score"] < 0.5 for r in out) and out[0].asDict().keys() == {"doc_id", "text", "score"}
    assert T.score(rows.limit(0), model).collect() == []
    none = T.fit(d, y.limit(0))
    assert {r["score"] for r in T.score(rows, none).collect()} == {0.0}
    only = T.fit(d, y.filter("toxic = 1"))
    assert {r["score"] for r in T.score(rows, only).collect()} == {1.0}
    few = T.fit(d.filter("doc_id < 12"), y)
    assert all(0 <= r["score"] <= 1 for r in T.score(rows, few).collect())
