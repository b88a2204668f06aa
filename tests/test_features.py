"""G4-G7 goldens: hashing, bins, normalisers, codes, padding, time parts, FM term, n-grams."""

import pytest
from pyspark.sql import functions as F

from recspark.functions import scalars as S
from recspark.functions.hashing import list_hash, str_hash, xxh32_many
from recspark.operators import fm as FM
from recspark.operators import transformers as TR
from recspark.operators.ranking import dense_codes


def _col(spark, values, typ="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, x {typ}")


def _vals(df, col):
    return [r[col] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("text,md5,xxh", [("101", 671522, 221747), ("nan", 970581, 824836),
                                          ("UNKNOWN", 585727, 58251), ("", None, 591546)])
def test_hash_buckets(spark, text, md5, xxh):
    df = spark.createDataFrame([(text,)], "s string")
    r = df.select(str_hash("s", 1_000_000, "md5").alias("m"), str_hash("s", 1_000_000, "xxh32").alias("x")).first()
    if md5 is not None:
        assert r.m == md5
    assert r.x == xxh
    assert xxh32_many([text])[0] % 1_000_000 == xxh


def test_null_hashes_as_nan(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(str_hash("s", 1_000_000, "md5").alias("m")).first().m == 970581


@pytest.mark.parametrize("values,n,strategy,codes", [
    (list(range(1, 11)), 4, "quantile", [0, 0, 0, 1, 1, 2, 2, 3, 3, 3]),
    ([0, 0, 0, 0, 1, 2, 3, 4], 4, "quantile", [0, 0, 0, 0, 1, 1, 2, 2]),
    ([1, 1, 1], 2, "quantile", [-1, -1, -1]),
    (list(range(0, 11)), 5, "width", [0, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4]),
    ([5, 5, 5], 4, "width", [1, 1, 1]),
])
def test_bins(spark, values, n, strategy, codes):
    df = _col(spark, [float(v) for v in values])
    m = TR.NumericalBinner(["x"], n, strategy).fit(df)
    assert _vals(m.transform(df), "x_bin") == codes


def test_minmax_log_label(spark):
    df = _col(spark, [1.0, None, 3.0, 10.0])
    out = TR.MinMaxNormalizer(["x"], suffix="_mm").fit(df).transform(df)
    assert [round(v, 6) for v in _vals(out, "x_mm")] == [0.0, 0.222222, 0.222222, 1.0]
    lg = TR.LogTransformer([("x", "x_log")]).transform(_col(spark, [0.0, 3.0, 9.0, -1.0, None]))
    assert [round(v, 6) for v in _vals(lg, "x_log")] == [0.0, 1.386294, 2.302585, 0.0, 0.0]
    s = _col(spark, ["b", "a", "B"], "string")
    enc = TR.CategoricalEncoder(["x"]).fit(s)
    test = _col(spark, ["B", "a", "b", "zz", None], "string")
    assert _vals(enc.transform(test), "x_encoded") == [0, 1, 2, 0, 0]
    oov = TR.CategoricalEncoder(["x"], unseen="oov").fit(s)
    assert _vals(oov.transform(test), "x_encoded") == [0, 1, 2, 3, 3]


def test_dense_codes_large_path_matches_window(spark):
    df = spark.range(0, 3000).select((F.col("id") % 7).cast("string").alias("feature"),
                                     (F.col("id") * 7919 % 1000).cast("string").alias("value")).distinct()
    small = dense_codes(df, ["feature"], [F.col("value")])
    large = dense_codes(df, ["feature"], [F.col("value")], partitions=5)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.select(*small.columns).collect()))


def test_padding_and_split(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b", "c", "d"],), (None,)], "xs array<string>")
    got = [r.p for r in df.select(S.padding("xs", 3, "0").alias("p")).collect()]
    assert got == [["a", "b", "0"], ["a", "b", "c"], ["0", "0", "0"]]
    e = spark.createDataFrame([("",), (None,)], "s string").select(S.str_to_list("s", ",").alias("l")).collect()
    assert [r.l for r in e] == [[""], []]


def test_time_parts(spark):
    df = spark.createDataFrame([(1030, "2024-01-01", "19700101")], "hm int, d string, s string")
    r = df.select(S.hhmm_hour("hm").alias("h"), S.hhmm_minute("hm").alias("m"),
                  S.iso_weekday(F.to_timestamp("d")).alias("iso"), S.weekday0(F.to_timestamp("d")).alias("w0"),
                  S.str_to_date(F.lit("1970-01-01"), "%Y%m%d").alias("fallback"),
                  S.hhmm_hour(F.lit(2460)).alias("bad")).first()
    assert (r.h, r.m, r.iso, r.w0, r.bad) == (10, 30, 1, 0, None)
    assert r.fallback is not None
    spec = TR.TimeFeatureExtractor([TR.TimeSpec("hm", "hh", "int_to_hour", "hour")])
    nul = spark.createDataFrame([(None,)], "hm int")
    assert spec.transform(nul).first().hh == -1


def test_fm_second_order(spark):
    df = spark.createDataFrame([(0, [[1.0, 2.0], [3.0, 4.0]]), (1, [[0.5, 1.5], [2.5, 3.5]])],
                               "k long, v array<array<double>>")
    arr = [r.f for r in df.orderBy("k").select(S.fm_second_order_array("v").alias("f")).collect()]
    assert arr == [11.0, 6.5]
    long = df.select("k", F.explode("v").alias("vec"))
    got = {r.k: r.fm2 for r in FM.fm_second_order_long(long, "k", "vec").collect()}
    assert got == {0: 11.0, 1: 6.5}


def test_prefix_ngrams(spark):
    df = spark.createDataFrame([([7, 3, 5],)], "c array<long>")
    r = df.select(S.prefix_ngrams("c", 2048).alias("g"), S.prefix_ngrams("c", 2048, 1_000_000).alias("h")).first()
    assert r.g == [7, 14339, 29366277]
    assert r.h == [7, 14339, 366277]


def test_fill_mode_and_literal(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b"), (1, None), (None, None)], "n long, s string")
    m = TR.MissingValueFiller([TR.FillSpec("n", "mode"), TR.FillSpec("s", "UNKNOWN")]).fit(df)
    out = m.transform(df).collect()
    assert [r.n for r in out] == [1, 2, 2, 1, 1]  # tie between 1 and 2 -> smallest
    assert [r.s for r in out] == ["a", "UNKNOWN", "b", "UNKNOWN", "UNKNOWN"]


def test_exact_quantiles_and_modes_match_numpy(spark):
    import random

    import numpy as np

    from recspark.operators.quantiles import exact_modes, exact_quantiles
    rnd = random.Random(11)
    a = [float(rnd.randint(0, 30)) for _ in range(997)]          # heavy ties
    b = [rnd.random() if rnd.random() > .1 else None for _ in range(997)]  # nulls
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["a", "b"], probs, buckets=7)
    np.testing.assert_allclose(got["a"], np.quantile(a, probs), rtol=0, atol=1e-12)
    np.testing.assert_allclose(got["b"], np.quantile([x for x in b if x is not None], probs), rtol=0, atol=1e-12)
    m = exact_modes(df.withColumn("s", F.col("a").cast("int").cast("string")), ["a", "s"])
    counts = {}
    for x in a:
        counts[x] = counts.get(x, 0) + 1
    best = min(counts, key=lambda v: (-counts[v], v))
    assert m["a"] == best
    scounts = {}
    for x in a:
        scounts[str(int(x))] = scounts.get(str(int(x)), 0) + 1
    assert m["s"] == min(scounts, key=lambda v: (-scounts[v], v))


def test_quantiles_and_modes_equal_the_builtin_ones(spark):
    import random

    from recspark.operators.quantiles import exact_modes, exact_quantiles
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.random() * 100, rnd.randint(0, 9)) for _ in range(500)], "x double, k long")
    probs = [0.0, 0.3, 0.5, 0.77, 1.0]
    row = df.agg(F.percentile("x", F.lit(probs)).alias("x"), F.percentile("k", F.lit(probs)).alias("k"),
                 F.mode("k", deterministic=True).alias("m")).first()
    for buckets in (1, 5, 64):
        got = exact_quantiles(df, ["x", "k"], probs, buckets=buckets)
        assert got == {"x": list(row["x"]), "k": list(row["k"])}
    assert exact_modes(df, ["k"]) == {"k": row["m"]}


def test_xxh32_equals_the_library(spark):
    import random
    xxhash = pytest.importorskip("xxhash")
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abcé😀 01") for _ in range(n)) for n in range(70) for _ in range(4)]
    for seed in (0, 1024, 2 ** 32 - 1):
        assert xxh32_many(texts, seed).tolist() == [xxhash.xxh32(t, seed).intdigest() for t in texts]
    df = spark.createDataFrame([(1, ["a", None, ""]), (2, None), (3, [])], "id long, xs array<string>")
    got = {r.id: r.h for r in df.select("id", list_hash("xs", 1000).alias("h")).collect()}
    want = [xxhash.xxh32(t, 1024).intdigest() % 1000 for t in ("a", "nan", "")]
    assert got == {1: want, 2: None, 3: []}
    md5 = df.where("id = 1").select(list_hash("xs", 1000, "md5").alias("h"), str_hash(F.lit("nan"), 1000, "md5").alias("n")).first()
    assert md5.h[1] == md5.n


def test_text_lists_take_number_pads(spark):
    from recspark.functions.registry import apply_ops
    from recspark.operators import transformers as TR
    df = spark.createDataFrame([("a-b",), (None,)], "x string")
    chain = [{"str_to_list": {"sep": "-"}}, {"padding": {"max_len": 3, "padding_value": 0}}]
    assert [r.p for r in df.select(apply_ops("x", chain).alias("p")).collect()] == [["a", "b", "0"], ["0", "0", "0"]]
    spec = TR.MultiValueSpec("x", "y", "-", 3, 50, 0, ["split", "pad", "hash"], "md5")
    assert all(len(r.y) == 3 for r in TR.MultivaluedProcessor([spec]).transform(df).collect())


def test_whole_number_division_is_exact(spark):
    values = [9007199254740993, -9007199254740993, 7, -7, 0, 2 ** 63 - 1, -2 ** 63 + 1, None]
    df = spark.createDataFrame([(v,) for v in values], "n long")
    for d in (1, 2, 7, -7, 1000):
        got = [r.q for r in df.select(S.floor_divide("n", d).alias("q")).collect()]
        assert got == [None if v is None else v // d for v in values]
    f = spark.createDataFrame([(7.5,), (-7.5,), (8.0,)], "n double")
    for d in (2, -2, 2.5):
        assert [r.q for r in f.select(S.floor_divide("n", d).alias("q")).collect()] == [int(v // d) for v in (7.5, -7.5, 8.0)]


def test_integer_mean_is_not_cut(spark):
    from recspark.operators import transformers as TR
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "n long")
    got = sorted(r.n for r in TR.MissingValueFiller([TR.FillSpec("n", "mean")]).fit(df).transform(df).collect())
    assert got == pytest.approx([1, 5 / 3, 2, 2])


def test_more_scalar_edges(spark):
    from recspark.operators.joins import vocab_lookup
    df = spark.createDataFrame([("2014-11-18 20", "a:1,2;b:;a:3", " 4, x ,5", [7, 8])],
                               "t string, props string, csv string, xs array<bigint>")
    r = df.select(S.get_hour(S.str_to_date("t", "%Y-%m-%d %H")).alias("h"),
                  S.get_day(S.str_to_date("t", "%Y-%m-%d %H")).alias("d"),
                  S.property_map("props").alias("m"), S.csv_to_long_list("csv").alias("ints"),
                  S.padding("xs", 4, 0).alias("pad")).first()
    assert (r.h, r.d) == (20, 18)
    assert r.m == {"a": ["3"], "b": [""]}  # last entry of a repeated key wins
    assert r.ints == [4, 5]
    assert r.pad == [7, 8, 0, 0]
    v = spark.createDataFrame([("x", 5)], "value string, code long")
    got = vocab_lookup(spark.createDataFrame([("x",), ("y",)], "k string"), "k", v, "c", default=None)
    assert sorted((row.k, row.c) for row in got.collect()) == [("x", 5), ("y", None)]


def test_range_edges_are_worked_out_once(spark):
    from recspark.operators.quantiles import exact_quantiles, value_counts_with_rank
    df = spark.range(200).selectExpr("CAST((id * 37) % 91 AS DOUBLE) AS v")
    ranked = value_counts_with_rank(df, ["v"], buckets=8)
    assert "percentile_approx" not in ranked._jdf.queryExecution().toString()
    values = sorted((i * 37) % 91 for i in range(200))
    assert exact_quantiles(df, ["v"], [0.0, 0.5, 1.0], buckets=8)["v"] == [values[0], (values[99] + values[100]) / 2, values[-1]]


def test_lookups_shuffle_ids_not_vectors(spark, monkeypatch):
    from recspark.operators import joins as J
    table = spark.createDataFrame([(i, [float(i), i * 0.5]) for i in range(6)] + [(3, [9.0, 9.0]), (5, None)],
                                  "idx long, vec array<double>")
    df = spark.createDataFrame([(1, [0, 1]), (2, []), (3, [3, 3, 77]), (4, None), (5, [None, 5]), (None, [1])],
                               "k long, ids array<long>")
    w = spark.createDataFrame([(i, i * 0.25) for i in range(5)], "idx long, w double")

    def run():
        return [J.embedding_lookup(df, "k", "ids", table, "o", "sum"), J.embedding_lookup(df, "k", "ids", table, "o", "mean"),
                FM.fm_score(df, "k", "ids", 0.1, w, table, [0, 1, 0])]

    few = run()
    assert all("_vec" not in d._jdf.queryExecution().toString() for d in few)
    got = [sorted(map(str, d.collect())) for d in few]
    assert {r.k: r.o for r in few[0].collect()} == {1: [1.0, 0.5], 2: None, 3: [24.0, 21.0], 4: None, 5: [5.0, 2.5], None: None}
    monkeypatch.setattr(J, "HELD_ROWS", 0)  # more rows than that: the tables are joined
    many = run()
    assert all("_vec" in d._jdf.queryExecution().toString() for d in many)
    assert [sorted(map(str, d.collect())) for d in many] == got


def test_looked_up_vectors_are_not_broadcast(spark, monkeypatch):
    from recspark.operators import joins as J
    table = spark.createDataFrame([(i, [float(i), i * 0.5]) for i in range(4)], "idx long, vec array<double>")
    df = spark.createDataFrame([(1, [0, 1]), (1, [2]), (2, [None]), (3, None)], "k long, ids array<long>")
    for held in (J.HELD_ROWS, 0):
        monkeypatch.setattr(J, "HELD_ROWS", held)
        out = J.embedding_lookup(df, "k", "ids", table, "o")
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan[:plan.index("Join")].endswith("SortMerge"), plan  # the last join, which brings the vectors to the rows
        assert out.columns == ["k", "ids", "o"]
        assert sorted((r.k, r.o) for r in out.collect() if r.o) == [(1, [3.0, 1.5])] * 2
