import zlib
from collections import defaultdict

import pytest

from recspark.llm import sharding as S


def shards(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, __x int")
    return S.shard_documents(df, **kw).collect()


def test_balanced_gapless_and_groups_together(spark):
    rows = [(i, f"text {i % 700} " * (1 + i % 13), "clash", 1) for i in range(4000)]
    out = shards(spark, rows, rows_per_range=100, max_probes=64)
    assert len(out) == 4000
    by, homes = defaultdict(list), defaultdict(set)
    for r in out:
        by[r["shard"]].append(r)
        homes[r["text_crc32"]].add(r["shard"])
    sizes = [sum(r["size"] for r in by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.025 * sum(sizes) / 8
    for s in range(8):
        assert sorted(r["slot"] for r in by[s]) == list(range(len(by[s])))
    assert sum(len(v) > 1 for v in homes.values()) <= 7
    assert {r["doc_id"]: r["text_crc32"] for r in out}[5] == zlib.crc32(rows[5][1].encode())


def test_hot_copies_are_cut(spark):
    rows = [(i, "same text" if i % 3 else f"other {i}", None, 1) for i in range(3000)]
    out = shards(spark, rows)
    sizes = defaultdict(int)
    for r in out:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 0.025 * sum(sizes.values()) / 8 + 20
    assert len({r["shard"] for r in out}) == 8


def test_nulls_repeats_and_empty(spark):
    out = shards(spark, [(None, None, None, 1), (None, None, None, 1), (1, "", None, 1), (1, "é", None, 1)])
    assert len(out) == 4
    assert sorted(r["size"] for r in out) == [1, 1, 1, 3]
    assert shards(spark, []) == []


@pytest.mark.parametrize("bits", [12, 40, 64, 80, 128])
def test_cell_numbers_round_trip(bits):
    for c in (0, 1, (1 << bits) - 1, (1 << bits) // 3):
        assert S._unsigned(*S._columns(c, bits), bits) == c
