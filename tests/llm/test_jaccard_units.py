import random

import pytest

from recspark.llm import jaccard_join as J
from test_jaccard_join import brute, corpus


def copies(n=400, length=120, seed=11):
    """Near copies of one text: most share signatures with each other, under many leaders."""
    rnd = random.Random(seed)
    hub = [f"h{rnd.randrange(10 ** 6)}" for _ in range(length)]
    rows = []
    for i in range(n):
        t = list(hub)
        for _ in range(rnd.randint(1, 9)):
            t[rnd.randrange(length)] = f"c{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(t)))
    return rows


@pytest.mark.parametrize("group,strong,common", [(2, 3, 64), (2, 1000, 64), (4, 1000, 64), (2, 3, 0)])
def test_guests_of_clusters_lose_no_link(spark, group, strong, common, monkeypatch):
    monkeypatch.setattr(J, "GROUP", group)
    monkeypatch.setattr(J, "STRONG", strong)
    monkeypatch.setattr(J, "COMMON", common)  # 0: nothing joins a cluster, every guest is compared as one
    rows = corpus(seed=13)
    out = J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), block_rows=13).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in out) == brute(rows)


def test_rows_of_near_copies_grow_no_faster_than_the_group(spark, monkeypatch):
    kept = {}

    def stored(df, what, real=J.stored):
        kept[what] = real(df, what)
        return kept[what]

    monkeypatch.setattr(J, "stored", stored)
    rows = {}
    for n in (150, 600):
        J.one_of_each(spark.createDataFrame(copies(n), "doc_id long, text string")).count()
        rows[n] = kept["jaccard-members"].selectExpr("sum(size(units))").first()[0]
    assert rows[150] <= 3 * 150 and rows[600] <= 3 * 600
