import random

import corpus_pipeline as P
from test_jaccard_join import brute_set


def brute_five(rows):
    """Smallest id of each group, linked by sets of five words at a similarity of 0.8."""
    sets, group = [brute_set(t, 5) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    return {min(i for (i, _), h in zip(rows, group, strict=True) if h == g) for g in group}


def test_near_copies_by_five_words(spark):
    rnd = random.Random(6)
    rows = []
    for n in range(40, 70):
        w = [f"t{n}w{k}" for k in range(n)]
        rows.append((len(rows), " ".join(w)))
        w[rnd.randrange(5, n - 5)] = "changed"
        rows.append((len(rows), " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in P.dedupe(spark, docs, "").collect()} == brute_five(rows)
