"""G3 rerank goldens (K1-K5), route merge and the exact pool trim."""

import pytest
from pyspark.sql import functions as F

from recspark.operators import recall as RC
from recspark.operators import rerank as RR

# songs: id, score, author, topic, tags
ITEMS = [(21, .70, "Ida", "folk", ["calm", "home"]), (22, .99, "Ida", "jazz", ["night"]),
         (23, .93, "Bo", "folk", ["home", "rain"]), (24, .96, "Ida", "jazz", ["night", "rain"]),
         (25, .60, "Cy", "rock", ["loud"]), (26, .91, "Bo", "jazz", ["calm"]), (27, .85, "Di", "folk", ["rain"])]


def _cands(spark):
    rows = [(0, i, s, a, t, st, pos) for pos, (i, s, a, t, st) in enumerate(ITEMS)]
    return spark.createDataFrame(rows, "request_id long, item_id long, score double, author string, topic string, "
                                       "tags array<string>, pos int")


def _order(df):
    return [r.item_id for r in df.orderBy("mmr_rank").collect()]


def test_similarity(spark):
    c = _cands(spark)
    a, b = c.alias("a"), c.alias("b")
    j = a.join(b, F.col("a.item_id") < F.col("b.item_id"))
    sim = RR.item_similarity([(F.col("a.author"), F.col("b.author"), False), (F.col("a.topic"), F.col("b.topic"), False),
                              (F.col("a.tags"), F.col("b.tags"), True)])
    got = {(r.i, r.j): r.s for r in j.select(F.col("a.item_id").alias("i"), F.col("b.item_id").alias("j"),
                                                 sim.alias("s")).collect()}
    assert got[(22, 24)] == pytest.approx((1 + 1 + 1 / 2) / 3)
    assert got[(21, 23)] == pytest.approx((0 + 1 + 1 / 3) / 3)
    assert got[(25, 26)] == 0.0


def _greedy_by_hand(k, lam, mode):
    """The picks from the definition, over all candidates at every step."""
    def sim(a, b):
        if mode == "diversity":
            return 0.5 * (a[2] == b[2]) + 0.5 * (a[3] == b[3])
        tags = len(set(a[4]) & set(b[4])) / len(set(a[4]) | set(b[4]))
        return ((a[2] == b[2]) + (a[3] == b[3]) + tags) / 3
    left, picked = list(ITEMS), []
    while left and len(picked) < k:
        def value(x):
            near = max((sim(x, p) for p in picked), default=0.0)
            if mode == "diversity":
                return lam * (1 - near) + (1 - lam) * x[1]
            return lam * x[1] - (1 - lam) * near if picked else x[1]
        best = max(left, key=value)  # the first of equals
        left.remove(best)
        picked.append(best)
    return [x[0] for x in picked]


@pytest.mark.parametrize("lam", [0.01, 0.5, 0.9, 1.0])
def test_mmr_relevance(spark, lam):
    out = RR.mmr_rerank(_cands(spark), 5, lam, ["author", "topic", "tags"], mode="relevance")
    assert _order(out) == _greedy_by_hand(5, lam, "relevance")
    if lam == 1.0:
        assert _order(out) == [22, 24, 23, 26, 27]  # by score alone
    if lam == 0.5:
        assert _order(out)[:3] == [22, 23, 25]  # 24: .48 - .5 * 2.5 / 3; 23: .465; then 25: .3


@pytest.mark.parametrize("lam", [0.7, 0.3, 0.0])
def test_mmr_diversity(spark, lam):
    out = RR.mmr_rerank(_cands(spark), 5, lam, ["author", "topic"], mode="diversity")
    assert _order(out) == _greedy_by_hand(5, lam, "diversity")


@pytest.mark.parametrize("lam", [0.2, 0.5, 0.8, 0.95])
def test_trim_is_exact(spark, lam):
    import random
    rnd = random.Random(int(lam * 100))
    rows = [(r, i, rnd.random() * 3, rnd.choice("ABCD"), rnd.choice("XYZ"), [rnd.choice("pqrst")], i)
            for r in range(30) for i in range(25)]
    df = spark.createDataFrame(rows, "request_id long, item_id long, score double, author string, topic string, "
                                     "tags array<string>, pos int")
    for mode, fields in (("relevance", ["author", "topic", "tags"]), ("diversity", ["author", "topic"])):
        a = RR.mmr_rerank(df, 6, lam, fields, mode=mode, trim=True)
        b = RR.mmr_rerank(df, 6, lam, fields, mode=mode, trim=False)
        key = lambda d: sorted((r.request_id, r.item_id, r.mmr_rank) for r in d.collect())
        assert key(a) == key(b)


def test_bad_params(spark):
    with pytest.raises(ValueError):
        RR.mmr_rerank(_cands(spark), 5, 1.5, ["author"])
    with pytest.raises(ValueError):
        RR.mmr_rerank(_cands(spark), 5, 0.5, [])


def test_consecutive_duplicates(spark):
    order = [22, 24, 23, 21, 25]
    byid = {i[0]: i for i in ITEMS}
    rows = [(0, i, byid[i][2], byid[i][3], p) for p, i in enumerate(order)]
    df = spark.createDataFrame(rows, "request_id long, item_id long, author string, topic string, pos int")
    d = RR.consecutive_duplicates(df, ["author", "topic"])
    got = sorted((r.item_id, r.dup_author, r.dup_topic) for r in d.where("has_dup").collect())
    assert got == [(21, False, True), (24, True, True)]


def test_merge_routes(spark):
    a = spark.createDataFrame([(0, "x", "author", 0), (0, "y", "author", 1)], "request_id long, item_id string, route string, pos int")
    t = spark.createDataFrame([(0, "y", "topic", 0), (0, "z", "topic", 1), (0, "w", "topic", 2)],
                              "request_id long, item_id string, route string, pos int")
    m = RC.merge_routes([a, t]).orderBy("merged_rank").collect()
    assert [r.item_id for r in m] == ["x", "z", "y", "w"]
    assert [round(r.score, 6) for r in m] == [10.0, 6.666667, 5.0, 3.333333]


@pytest.mark.parametrize("mode,fields,lam", [("relevance", ["author", "topic", "tags"], 0.5),
                                             ("diversity", ["author", "topic"], 0.7),
                                             ("relevance", ["author", "topic", "tags"], 0.05)])
def test_hot_request_path_matches_pandas(spark, mode, fields, lam):
    import random
    rnd = random.Random(9)
    rows = [(r, i, round(rnd.random() * 2, 2), rnd.choice("ABC"), rnd.choice("XY"), [rnd.choice("pqr")], i)
            for r in range(6) for i in range(15 + r)]
    df = spark.createDataFrame(rows, "request_id long, item_id long, score double, author string, topic string, "
                                     "tags array<string>, pos int")
    key = lambda d: sorted((r.request_id, r.item_id, r.mmr_rank) for r in d.collect())
    normal = RR.mmr_rerank(df, 5, lam, fields, mode=mode)
    hot = RR.mmr_rerank(df, 5, lam, fields, mode=mode, max_pool=16)   # some requests hot, some not
    allhot = RR.mmr_iterative(df, 5, lam, fields, mode)
    assert key(normal) == key(hot) == key(allhot)


@pytest.mark.parametrize("mode,fields", [("relevance", ["author", "topic", "tags"]), ("diversity", ["author", "topic"])])
def test_paths_agree_on_repeated_and_null_items(spark, mode, fields):
    import random
    rnd = random.Random(5)
    rows = [(r, rnd.choice([1, 2, 3, None]), round(rnd.random(), 1), rnd.choice(["A", "B", None]), rnd.choice("XY"),
             rnd.choice([None, [], ["p"], ["p", "q"]]), i) for r in range(4) for i in range(30)]
    df = spark.createDataFrame(rows, "request_id long, item_id long, score double, author string, topic string, "
                                     "tags array<string>, pos int")
    key = lambda d: sorted((r.request_id, r.pos, r.mmr_rank) for r in d.collect())
    for lam in (0.3, 0.8):
        normal = key(RR.mmr_rerank(df, 5, lam, fields, mode=mode))
        assert normal == key(RR.mmr_rerank(df, 5, lam, fields, mode=mode, max_pool=3)) and len(normal) == 20
        assert normal == key(RR.mmr_rerank(df, 5, lam, fields, mode=mode, rows_per_task=7))


def test_requests_of_all_sizes_in_one_bucket():
    """The side-by-side greedy picks what the definition picks, request by request."""
    import random

    import pandas as pd
    rnd = random.Random(3)
    token = ["p", "q", "r", None]
    rows = [(r, i, round(rnd.random(), 1), rnd.choice(["A", "B", None]),
             rnd.choice([None, [], [rnd.choice(token) for _ in range(rnd.randrange(1, 5))]]), i)
            for r in range(25) for i in range(rnd.choice([1, 2, 3, 12]))]
    rnd.shuffle(rows)
    pdf = pd.DataFrame(rows, columns=["request_id", "item_id", "score", "author", "tags", "pos"])

    def sim(a, b):
        parts = [float(a[3] == b[3])] if a[3] is not None and b[3] is not None else []
        if a[4] is not None and b[4] is not None:
            x, y = set(a[4]), set(b[4])
            parts.append(len(x & y) / len(x | y) if x | y else 0.0)
        return sum(parts) / len(parts) if parts else 0.0

    want = []
    for r in sorted({row[0] for row in rows}):
        left, picked = sorted((row for row in rows if row[0] == r), key=lambda x: x[5]), []
        while left and len(picked) < 4:
            near = [max((sim(x, p) for p in picked), default=0.0) for x in left]
            best = max(range(len(left)), key=lambda j: 0.4 * left[j][2] - (1 - 0.4) * near[j] if picked else left[j][2])
            picked.append(left.pop(best))
        want += [(r, x[1], n + 1) for n, x in enumerate(picked)]
    out = RR.greedy_mmr(pdf, 4, 0.4, ["author", "tags"], "relevance", {"tags"})
    assert sorted(zip(out["request_id"], out["item_id"], out["mmr_rank"])) == sorted(want)
    assert RR.greedy_mmr(pdf.iloc[:0], 4, 0.4, ["author", "tags"], "relevance", {"tags"}).empty


def test_merge_parts_grow_with_the_rows(spark):
    from recspark.operators import recall as RC
    rows = [(r, r * 3 + i, name, i) for r in range(40) for i in range(5) for name in ("a", "b") if (r + i) % 3 or name == "a"]
    one, two = (spark.createDataFrame([x for x in rows if x[2] == name], "request_id long, item_id long, route string, pos int")
                for name in ("a", "b"))
    few, many = RC.merge_routes([one, two]), RC.merge_routes([one, two], rows_per_task=50)
    parts = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(request_id" in parts(many) and f", {-(-len(rows) // 50)}), REPARTITION_BY_NUM" in parts(many)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert many.where("route = 'b'").count() == 0  # all in route a already
