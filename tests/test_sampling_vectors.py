"""E19/E20 properties, blocked exact top-k against numpy, LSH recall against exact."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.operators import sampling as SA
from recspark.operators import vectors as V
from recspark.session import read_table

SF = "/root/testdata/sf0.001"


def _positives(spark):
    o = read_table(spark, SF, "orders", ["o_orderkey", "o_custkey"])
    li = read_table(spark, SF, "lineitem", ["l_orderkey", "l_partkey"])
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).distinct()


def test_negative_samples_properties(spark):
    pos = _positives(spark)
    items = read_table(spark, SF, "part", ["p_partkey"]).select(F.col("p_partkey").alias("item_id"))
    out = SA.negative_samples(pos, items, n=2).cache()
    known = {(r.user_id, r.item_id) for r in pos.collect()}
    negs = [(r.user_id, r.item_id) for r in out.where("label = 0").collect()]
    assert out.where("label = 1").count() == len(known)
    assert negs and not (set(negs) & known)
    per_user = out.where("label = 0").groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert per_user <= 2 * max(r["count"] for r in pos.groupBy("user_id").count().collect())
    again = {(r.user_id, r.item_id) for r in SA.negative_samples(pos, items, n=2).where("label = 0").collect()}
    assert again == set(negs)  # hash-based: repeatable


def test_split_fractions(spark):
    o = read_table(spark, "/root/testdata/sf0.01", "orders", ["o_orderkey"])
    c = {r.split: r["count"] for r in SA.split_by_hash(o, ["o_orderkey"], {"train": .7, "val": .2, "test": .1})
         .groupBy("split").count().collect()}
    total = sum(c.values())
    assert abs(c["train"] / total - .7) < .03 and abs(c["val"] / total - .2) < .03


def _vectors(spark, n=300, d=16, seed=1):
    rnd = np.random.default_rng(seed)
    m = rnd.normal(size=(n, d))
    return m, spark.createDataFrame([(i, [float(x) for x in m[i]]) for i in range(n)], "id long, vec array<double>")


def test_blocked_topk_matches_numpy(spark):
    m, df = _vectors(spark)
    got = V.topk_dot(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "iid"), 5, block_rows=37,
                     exclude_self=True)
    res = {}
    for r in got.collect():
        res.setdefault(r.qid, []).append((r["rank"], r.iid))
    s = m @ m.T
    np.fill_diagonal(s, -np.inf)
    for q in range(len(m)):
        want = list(np.lexsort((np.arange(len(m)), -s[q]))[:5])
        assert [i for _, i in sorted(res[q])] == want


def test_lsh_recall(spark):
    m, df = _vectors(spark, n=300, d=8, seed=2)
    mn = m / np.linalg.norm(m, axis=1, keepdims=True)
    got = V.topk_lsh(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "iid"), 10,
                     bucket_length=0.7, num_tables=6)
    approx = {}
    for r in got.collect():
        approx.setdefault(r.qid, set()).add(r.iid)
    s = mn @ mn.T
    hits = [len(approx.get(q, set()) & set(np.argsort(-s[q])[:10])) / 10 for q in range(len(m))]
    assert np.mean(hits) > 0.5 and all(len(approx[q]) == 10 for q in range(len(m)))


def test_residual_quantiser_shapes_and_loss(spark):
    from recspark.operators import semantic as SM
    e = read_table(spark, SF, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    books = SM.rq_fit(e, "vec", layers=3, k=8, seed=5, max_iter=5)
    assert books.count() == 24
    enc = SM.rq_encode(e, "vec", books, 3)
    r = enc.select(F.size("codes").alias("nc"), F.size("quantized").alias("nq"),
                   F.size("residual_norms").alias("nr"), F.array_max("codes").alias("mx")).distinct().collect()
    assert all(x.nc == 3 and x.nq == 64 and x.nr == 3 and x.mx < 8 for x in r)
    loss = SM.rq_loss(enc, "vec").first()
    assert loss.recon_mse >= 0 and loss.commit >= 0 and loss.loss == pytest.approx(loss.recon_mse + loss.commit)
    ids = enc.select(SM.semantic_id("codes", 8).alias("sid")).first().sid
    assert len(ids) == 3 and ids[0] < 8 and ids[1] < 64 and ids[2] < 512


def test_negatives_are_complete_and_unknown(spark):
    import random
    from collections import Counter
    rnd = random.Random(3)
    items = list(range(100, 120))
    pos = sorted({(u, rnd.choice(items)) for u in range(12) for _ in range(rnd.choice([1, 4, 40]))})
    pos += [(50, i) for i in items[:18]] + [(51, i) for i in items] + [(52, i) for i in items[:19]] + [(53, 999)]
    df = spark.createDataFrame(pos, "user_id long, item_id long")
    cat = spark.createDataFrame([(i,) for i in items], "item_id long")
    from recspark.operators import sampling as SA
    out = [(r.user_id, r.item_id) for r in SA.negative_samples(df, cat, n=3).where("label = 0").collect()]
    known = set(pos)
    assert not known & set(out)
    free = {u: sum((u, i) not in known for i in items) for u, _ in pos}
    per_user = Counter(u for u, _ in pos)
    assert Counter(u for u, _ in out) == Counter({u: per_user[u] * min(3, free[u]) for u in per_user if free[u]})


def test_requests_of_one_value_get_different_items(spark):
    from recspark.operators import recall as RC
    items = spark.createDataFrame([(i, "a" if i < 50 else "b") for i in range(52)], "item_id long, author string")
    req = spark.createDataFrame([(r, "a") for r in range(30)] + [(100, "b"), (101, "c"), (102, None)], "request_id long, author string")
    out = RC.recall_by_field(req, items, "author", 5, seed=1).collect()
    by = {}
    for r in out:
        by.setdefault(r.request_id, []).append((r.pos, r.item_id))
    assert sorted(p for p, _ in by[100]) == [0, 1] and 101 not in by and 102 not in by
    assert all([p for p, _ in sorted(v)] == list(range(5)) and len({i for _, i in v}) == 5 for k, v in by.items() if k < 100)
    assert len({frozenset(i for _, i in by[r]) for r in range(30)}) > 10


def test_independent_draws_are_uniform_pairs(spark):
    keys = spark.range(6000).select(F.col("id").cast("string").alias("k"))
    out = keys.select(SA.distinct_draws(F.col("k"), F.lit(6).cast("long"), F.lit(2)).alias("d")).collect()
    pairs = Counter(tuple(r.d) for r in out)
    assert len(pairs) == 30 and all(a != b for a, b in pairs)
    assert sum((n - 200) ** 2 / 200 for n in pairs.values()) < 58  # chi-square of 29 degrees at 0.1 %
    whole = keys.limit(20).select(SA.distinct_draws(F.col("k"), F.lit(5).cast("long"), F.lit(5)).alias("d")).collect()
    assert all(sorted(r.d) == [0, 1, 2, 3, 4] for r in whole)


def test_norm_bounds_skip_blocks_and_keep_the_answer(spark):
    rnd = np.random.default_rng(5)
    m = rnd.normal(size=(1500, 8)) * rnd.choice([0.01, 1.0, 30.0], (1500, 1), p=[.8, .15, .05])
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(1500)], "id long, vec array<double>")
    got = {}
    for r in V.topk_dot(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "iid"), 5, block_rows=100).collect():
        got.setdefault(r.qid, []).append((r["rank"], r.iid))
    s = m @ m.T
    assert all([i for _, i in sorted(got[q])] == list(np.lexsort((np.arange(1500), -s[q]))[:5]) for q in range(1500))


def test_inverted_file_with_all_cells_is_nearly_exact(spark):
    from recspark.operators import ivf
    m, df = _vectors(spark, n=400)
    q, i = df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "iid")
    index = ivf.build(i)
    out = ivf.search(index, q, i, 5, probe_share=1.0, block_rows=50, query_rows=90).collect()
    s = m @ m.T
    want = {(a, b) for a in range(400) for b in np.argsort(-s[a])[:5]}
    assert len({(r.qid, r.iid) for r in out} & want) >= 0.95 * len(want)
    assert all(abs(r.score - s[r.qid, r.iid]) < 1e-9 for r in out)


def test_blocks_of_a_side_stay_few(spark):
    _, df = _vectors(spark, n=900, d=4)
    _, most = V.norm_blocks(df.withColumnRenamed("id", "iid"), 4)
    assert len(most) <= V.BLOCKS
    assert V.rows_of_block(10 ** 9, 256) == V.MOST_ROWS and V.rows_of_block(900, 256) == 256


def test_topk_of_copies_goes_to_the_smaller_id(spark):
    rnd = np.random.default_rng(8)
    m = np.concatenate([np.tile(rnd.normal(size=(3, 16)), (200, 1)), rnd.normal(size=(900, 16)) / 4])
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(1500)], "id long, vec array<double>")
    got = {}
    for r in V.topk_dot(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "iid"), 5, block_rows=64, exclude_self=True).collect():
        got.setdefault(r.qid, []).append((r["rank"], r.iid))
    s = np.einsum("ij,kj->ik", m, m)
    np.fill_diagonal(s, -np.inf)
    for q in (0, 1, 5, 599, 600, 1499):
        first = m[np.arange(1500)] @ m[q]
        first[q] = -np.inf
        want = list(np.lexsort((np.arange(1500), -first.round(9)))[:5])
        assert [i for _, i in sorted(got[q])] == want


def test_lsh_finds_the_pairs_of_its_buckets_without_a_pair_table(spark, monkeypatch):
    from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
    from pyspark.ml.functions import array_to_vector

    def no_pairs(*args, **kwargs):
        raise AssertionError("every pair of a bucket in one table")
    monkeypatch.setattr(BucketedRandomProjectionLSHModel, "approxSimilarityJoin", no_pairs)
    m, df = _vectors(spark, n=200, d=8, seed=4)
    mn = m / np.linalg.norm(m, axis=1, keepdims=True)
    got = {}
    for r in V.topk_lsh(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "iid"), 4, bucket_length=0.3, num_tables=2).collect():
        got.setdefault(r.qid, []).append((r["rank"], r.iid))
    unit = spark.createDataFrame([(i, mn[i].tolist()) for i in range(200)], "id long, vec array<double>")
    unit = unit.select("id", array_to_vector("vec").alias("f"))
    model = BucketedRandomProjectionLSH(inputCol="f", outputCol="h", bucketLength=0.3, numHashTables=2, seed=7).fit(unit)
    h = np.array([[v[0] for v in r.h] for r in model.transform(unit).orderBy("id").collect()])
    s = mn @ mn.T
    s[~(h[:, None, :] == h[None, :, :]).any(2)] = -np.inf
    assert np.isneginf(s).any()
    for q in np.flatnonzero(np.isfinite(s).sum(1) >= 4):
        assert [i for _, i in sorted(got[q])] == list(np.lexsort((np.arange(200), -s[q]))[:4])


def test_inverted_file_multiplies_and_keeps_its_parts_few(spark):
    from recspark.operators import ivf
    m, df = _vectors(spark, n=400)
    q, i = df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "iid")
    assert not hasattr(ivf, "_tables")
    index = ivf.build(i, cells=4)
    out = ivf.search(index, q, i, 5, probe_share=0.25, rerank=400, block_rows=50, query_rows=1, exclude_self=True)
    got = {}
    for r in out.collect():
        got.setdefault(r.qid, []).append((r["rank"], r.iid))
    cell = {r.iid: r.cell for r in index.postings.collect()}
    s = m @ m.T
    np.fill_diagonal(s, -np.inf)
    mine = np.argmax(m @ index.centres.T, axis=1)
    s[np.array([[cell[c] != mine[r] for c in range(400)] for r in range(400)])] = -np.inf
    for r in range(400):
        want = [c for c in np.lexsort((np.arange(400), -s[r]))[:5] if np.isfinite(s[r, c])]
        assert [c for _, c in sorted(got.get(r, []))] == want


@pytest.mark.parametrize("draws", ["strides", "independent"])
def test_positives_are_worked_out_once(spark, monkeypatch, draws):
    from recspark.operators import sampling as SA
    worked = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        worked.add(1)
        return x

    rows = sorted({(None if u == 7 else u, (u * 31 + k * k) % 60 + 100) for u in range(12) for k in range(3 * u + 1)}, key=str)
    pos = spark.createDataFrame(rows, "user_id long, item_id long")
    cat = spark.createDataFrame([(i,) for i in range(100, 150)], "item_id long")
    got = sorted(map(str, SA.negative_samples(pos.select(seen("user_id").alias("user_id"), "item_id"), cat, n=3, draws=draws).collect()))
    assert worked.value == len(rows)
    monkeypatch.setattr(SA, "HEAVY_ROWS", 4)  # users above are cut into slices
    assert sorted(map(str, SA.negative_samples(pos, cat, n=3, draws=draws).collect())) == got
    monkeypatch.setattr(SA, "HEAVY_ROWS", 0)
    assert sorted(map(str, SA.negative_samples(pos, cat, n=3, draws=draws).collect())) == got
