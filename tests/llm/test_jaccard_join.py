import random
import re

import numpy as np
import pyarrow as pa
import pytest

from recspark.llm import jaccard_join as J
from recspark.llm.graph import components
from recspark.llm.shingles import shingle_sets


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


def brute_set(t, width=3):
    w = words(t)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(rows, width=3, num=9, den=10):
    sets = [brute_set(t, width) if i is not None else set() for i, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    degree = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
                degree[a] += 1
                degree[b] += 1
    first = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            first[root(k)] = min(first.get(root(k), i), i)
    return sorted((i, len(sets[k]) if i is not None else len(brute_set(t, width)), first.get(root(k)) if i is not None else None,
                   degree[k]) for k, (i, t) in enumerate(rows) if i is not None)


def corpus(seed=5):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(30):
        text = [rnd.choice(vocab) for _ in range(rnd.choice([9, 11, 12, 13, 30, 60, 150, 400]))]
        for _ in range(rnd.randint(1, 8)):
            t = list(text)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            rows.append((len(rows) * 7 % 1009, " ".join(t)))
    hub = [rnd.choice(vocab) for _ in range(150)]
    for _ in range(120):  # near copies of one text that mostly don't link with each other
        t = list(hub)
        for _ in range(rnd.randint(0, 6)):
            t[rnd.randrange(150)] = rnd.choice(vocab)
        rows.append((2000 + len(rows), " ".join(t)))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "ONE"), (5005, "one two"), (5006, "a b c"),
             (5007, "A  b\tc"), (5008, "é É a"), (4999, "one two"), (5009, "x y " * 3000), (5010, "x y " * 2999), (5003, "one"),
             (5003, "other text"), (5011, hub and " ".join(hub))]
    return rows


@pytest.mark.parametrize("block,strong", [(256, 3), (13, 3), (13, 1000)])
def test_equals_brute_force(spark, block, strong, monkeypatch):
    monkeypatch.setattr(J, "STRONG", strong)  # 1000: every link goes across clusters
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in [*rows, (None, "one"), (None, None)]], "doc_id long, text string, class string")
    out = J.jaccard_join(df, block_rows=block).collect()
    assert len(out) == len(rows) + 2
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in out if r["doc_id"] is not None)
    assert got == brute(rows)
    assert all(r["component_id"] is None and r["n_links"] == 0 for r in out if r["doc_id"] is None)


def test_equals_brute_force_at_five_words(spark):
    rows = corpus(seed=9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = J.jaccard_join(df, width=5, num=4, den=5, block_rows=40).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in out) == brute(rows, 5, 4, 5)


def test_one_of_each_keeps_one_row_of_a_group(spark):
    text, other = "a b c d e f g h i j", "an other text of its own with words"
    rows = [(1, text, 5), (2, text, 6), (2, other, 7), (2, other, 8), (2, other, 8), (3, text + " ", 9), (None, text, 1), (None, text, 1),
            (4, None, 1), (4, " ", 1), (4, " ", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `row` int")
    got = sorted(J.one_of_each(df).collect(), key=str)
    assert [r["row"] for r in got if r["doc_id"] == 1] == [5]
    assert [(r["text"]) for r in got if r["doc_id"] == 2] == [other]
    assert [r["doc_id"] for r in got if r["doc_id"] in (3, 4, None)].count(3) == 0
    assert sum(r["doc_id"] is None for r in got) == 2 and sum(r["doc_id"] == 4 for r in got) == 3
    again = sorted(J.one_of_each(df).collect(), key=str)
    assert again == got and J.one_of_each(df).columns == df.columns
    assert J.one_of_each(df.limit(0)).collect() == []


def test_empty_table(spark):
    assert J.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("num,den", [(9, 10), (4, 5)])
def test_linked_sets_always_share_a_signature(num, den):
    rng = np.random.default_rng(3)
    seen = 0
    for size in [4, 5, 6, 8, 9, 10, 11, 12, 15, 19, 27, 28, 40, 97, 300, 900]:
        most = max(1, size * (den - num) // (den + num) + 1)
        for _ in range(120):
            a = rng.integers(0, 2 ** 62, size).astype(np.uint64)
            b = a.copy()
            changes = rng.integers(0, most + 1)
            b[:changes] = rng.integers(0, 2 ** 62, changes)
            b = b[:size - rng.integers(0, most)]
            inter = len(set(a.tolist()) & set(b.tolist()))
            if den * inter < num * (len(a) + len(b) - inter) or inter == len(a) == len(b):  # equal sets are one class
                continue
            seen += 1
            sig, who = J.signatures(np.concatenate([np.sort(a), np.sort(b)]), np.repeat([0, 1], [len(a), len(b)]), 2, num, den)
            assert set(sig[who == 0].tolist()) & set(sig[who == 1].tolist())
    assert seen > 400


def test_no_signature_of_empty_sub_parts():
    """Sets without a common element share no signature, so chance never makes large groups."""
    rng = np.random.default_rng(8)
    sets = [np.sort(rng.integers(0, 2 ** 62, size).astype(np.uint64)) for size in rng.integers(4, 400, 1500)]
    for num, den in ((4, 5), (9, 10)):
        sig, who = J.signatures(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets]), len(sets), num, den)
        _, many = np.unique(np.unique(np.stack([sig.view(np.int64), who]), axis=1)[0], return_counts=True)
        assert many.max() == 1


def test_shingles_match_brute_force():
    texts = [t for _, t in corpus()[:40]] + [None, "", "a", "a b", "A b C d"]
    h, own = shingle_sets(pa.array(texts, pa.string()), 3)
    assert [int((own == k).sum()) for k in range(len(texts))] == [len(brute_set(t)) for t in texts]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 501), (600, 600)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
