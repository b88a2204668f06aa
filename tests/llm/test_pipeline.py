import random
from collections import Counter

import pytest

import corpus_pipeline as P
from test_jaccard_join import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 8))) for _ in range(900)]
    docs, labels = [], []
    for i in range(400):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(30, 200))]
        if i % 10 == 3:
            w = [x + "###" for x in w]
        if i % 10 == 7:
            w = w[:6] * 20
        text = " ".join(w)
        docs.append((i, text, "en", f"src{i % 6}", len(text)))
        labels.append((i, int(i % 10 not in (3, 7))))
        if i % 8 == 1:
            w[5] = "changed"
            docs.append((1000 + i, " ".join(w), "de", "src0", 0))
    return [*docs, (None, " ".join(vocab[:50]), None, None, None), (5000, None, "en", "src1", 0), docs[0]], labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, labels = corpus()
    sf = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for k, (_, f) in enumerate(P.STAGES):
        f(spark, out[-1], sf).write.parquet(f"{sf}/stage{k}")
        out.append(spark.read.parquet(f"{sf}/stage{k}"))
    return out, sf


def test_columns_and_shrinking(stages):
    out, _ = stages
    for d in out[:-1]:
        assert d.columns == out[0].columns
    assert 0 < out[2].count() <= out[1].count() < out[0].count()


def test_junk_goes_and_clean_stays(stages):
    out, _ = stages
    kept = {r["doc_id"] for r in out[2].collect()}
    clean = {i for i in range(400) if i % 10 not in (3, 7)}
    junk = set(range(400)) - clean
    assert len(clean & kept) >= 0.98 * len(clean)
    assert len(junk & kept) <= 0.05 * len(junk)


def test_one_of_each_group(stages):
    out, _ = stages
    before = [(r["doc_id"], r["text"]) for r in out[2].collect()]
    group = {i: c for i, _, c, _ in brute(before, 5, 4, 5)}
    after = [r["doc_id"] for r in out[3].collect()]
    assert Counter(group[i] for i in after if i is not None) == Counter({c: 1 for c in group.values()})
    assert after.count(None) == sum(i is None for i, _ in before)


def test_empty_documents_through_all_stages(spark, stages, tmp_path):
    out, sf = stages
    docs = out[0].limit(0)
    for _, f in P.STAGES:
        docs = f(spark, docs, sf)
        assert docs.collect() == []


def test_clashing_columns_and_a_long_text(spark, stages):
    _, sf = stages
    names = ["doc_id", "text", "lang", "source", "n_chars", "score", "kept", "epoch", "class", "row", "at"]
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(k, t, "en", "src0", 1, 0.5, True, 3, "c", k, 9) for k, t in enumerate([long, long + " more", "some words of a short text", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, "
                                       "epoch int, class string, row int, at int")
    for _, f in P.STAGES[:4]:
        after = f(spark, docs, sf)
        assert after.columns == names
        assert {tuple(r) for r in after.collect()} <= set(rows)
    assert sorted(r["doc_id"] for r in P.STAGES[2][1](spark, docs, sf).collect()) == [0, 2, 3]


def test_tokens_of_every_drawn_document(stages):
    from tokenizers import Tokenizer
    out, _ = stages
    tok = Tokenizer.from_file(P.vocabulary())
    drawn = Counter((r["doc_id"], tuple(tok.encode(r["text"], add_special_tokens=False).ids)) for r in out[4].collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in out[5].collect()) == drawn
    assert set(out[4].select("doc_id", "text").distinct().collect()) <= set(out[3].select("doc_id", "text").collect())


def test_run_gives_the_last_stage(spark, stages):
    out, sf = stages
    got = Counter((r["doc_id"], r["decoded_sha256"]) for r in P.run(spark, sf).collect())
    assert got == Counter((r["doc_id"], r["decoded_sha256"]) for r in out[5].collect())
