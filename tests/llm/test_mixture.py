import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest

from recspark.llm import mixture as M
from recspark.llm.queries import MIXTURE_SQL, op8_mixture

SCHEMA = "doc_id long, text string, domain string, lang string, source string, epoch string"


def share(total, kids):
    """Water-filling by repeated rounds: kids is {name: (capacity, weight)}."""
    got, live, left = {}, dict(kids), total
    while live:
        w = sum(x for _, x in live.values())
        over = {k for k, (c, x) in live.items() if c <= left * x / w + 1e-9}
        if not over:
            return {**got, **{k: left * x / w for k, (_, x) in live.items()}}
        for k in over:
            got[k] = live.pop(k)[0]
        left = total - sum(got.values())
    return got


def brute(rows, budget_share=0.7, alpha=0.5, epochs=4):
    n = lambda t: len((t or "").split())
    leaf = defaultdict(list)
    for i, t, d, lang, s, _ in rows:
        leaf[(d or "", lang or "", s or "")].append((i, n(t)))
    size = {k: sum(x for _, x in v) for k, v in leaf.items()}
    budget = {(): min(budget_share * sum(size.values()), epochs * sum(size.values()))}
    for depth in range(3):
        for top in [k for k in budget if len(k) == depth]:
            kids = Counter()
            for k, c in size.items():
                if k[:depth] == top and c:
                    kids[k[:depth + 1]] += c
            budget.update(share(budget[top], {k: (epochs * c, c ** alpha) for k, c in kids.items()}))
    out = Counter()
    for k, docs in leaf.items():
        b = int(budget.get(k, 0) + 1e-6)
        full, rest = divmod(b, size[k]) if size[k] else (0, 0)
        for e in range(1, full + 1):
            out.update((i, e) for i, _ in docs)
        h = lambda i: hashlib.md5(f"7:{full + 1}:{'' if i is None else i}".encode()).hexdigest()
        end = 0
        for i, x in sorted(docs, key=lambda r: (h(r[0]), str(r[0]), r[1])):
            end += x
            if rest and end <= rest:
                out[(i, full + 1)] += 1
    return out


def rows():
    out = []
    for i in range(600):
        source = "src0" if i % 3 == 0 else f"src{i % 17}"
        out.append((i, "word " * (1 + i * 7 % 40), f"d{i % 3 if i % 5 else 9}", ["en", "de", None][i % 3], source, "x"))
    return out + [(None, "a b", "d0", "en", "src0", "x"), (7, None, "d0", "en", "src0", "x"), (8, "", None, None, None, "x"),
                  (9, "tiny", "alone", "xx", "only", "x"), (10, "big " * 3000, "d1", "de", "src1", "x")]


@pytest.mark.parametrize(("budget", "alpha"), [(0.7, 0.5), (2.5, 0.2), (9.0, 1.0)])
def test_equals_brute_force(spark, budget, alpha):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    plan = M.plan_mixture(df, budget_share=budget, alpha=alpha)
    out = M.mix(df, plan)
    assert out.columns == [c for c in df.columns if c != "epoch"] + ["epoch"]
    got = Counter((r["doc_id"], r["epoch"]) for r in out.collect())
    want = brute(data, budget, alpha)
    worded = lambda c: {k: v for k, v in c.items() if k[0] not in (7, 8)}
    assert worded(got) == worded(want)
    assert sum(got.values()) >= sum(want.values()) - 8


def test_targets_and_empty(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    plan = M.plan_mixture(df, targets={"domain": {"d0": 1e9}}, budget_share=0.1)
    by = {r["domain"]: r["b"] for r in plan.groupBy("domain").agg({"budget": "sum"}).withColumnRenamed("sum(budget)", "b").collect()}
    assert by["d0"] > 100 * max(v for k, v in by.items() if k != "d0")
    none = df.limit(0)
    assert M.mix(none, M.plan_mixture(none)).collect() == []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{sf}/documents.parquet/*.parquet'" if __import__("os").path.isdir(
        f"{sf}/documents.parquet") else f"create view documents as select * from '{sf}/documents.parquet'")
    want = Counter(db.execute(f"select doc_id, domain, lang, source, n_tokens, epoch from ({MIXTURE_SQL})").fetchall())
    assert Counter(tuple(r) for r in op8_mixture(spark, sf).collect()) == want


def test_many_leaves_join_by_salts(spark, monkeypatch):
    from recspark.llm import common
    df = spark.createDataFrame(rows(), SCHEMA)
    want = Counter((r["doc_id"], r["epoch"]) for r in M.mix(df, M.plan_mixture(df)).collect())
    real = common.join_small
    monkeypatch.setattr(M, "join_small", lambda *a, **k: real(*a, **k, most=0, salts=5))
    out = M.mix(df, M.plan_mixture(df))
    assert out.columns == [c for c in df.columns if c != "epoch"] + ["epoch"]
    assert Counter((r["doc_id"], r["epoch"]) for r in out.collect()) == want
