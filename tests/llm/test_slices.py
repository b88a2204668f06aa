"""Operators read blocks of an Arrow batch as slices; a slice must give what a copy gives."""

import numpy as np
import pyarrow as pa
import pytest

from recspark.llm import bpe, context_mixing, license_scan, quality_model, shingles
from recspark.llm.common import blocks, solid
from recspark.llm.queries import vocabulary

TEXTS = ["Größe ÄÖ " * 7, None, "Short", *[f"Text {i} wIth É and {'word ' * (i % 9)}\nline" for i in range(40)],
         license_scan.TEMPLATES["MIT"], "", "zum Schluß"]


@pytest.fixture(params=[pa.string(), pa.large_string()])
def pairs(request):
    whole = pa.array(TEXTS, request.param)
    return [(whole.slice(a, n), pa.array(TEXTS[a:a + n], request.param)) for a, n in ((0, 5), (3, 20), (17, 29), (44, 2))]


def test_every_reader(pairs):
    known = license_scan.Templates(license_scan.TEMPLATES)
    for cut, copy in pairs:
        assert solid(cut).to_pylist() == [t or "" for t in copy.to_pylist()]
        for read in (lambda x: shingles.shingle_sets(x, 3), license_scan.plain_words,
                     lambda x: (quality_model.statistics(solid(x)),),
                     lambda x: context_mixing.streams(*context_mixing.lower_words(x))):
            for a, b in zip(read(cut), read(copy), strict=True):
                assert np.array_equal(a, b)
        assert license_scan.scan_texts(cut, known, 0.8) == license_scan.scan_texts(copy, known, 0.8)


def test_blocks_cover_a_batch_once():
    batch = pa.record_batch([pa.array(TEXTS), pa.array(range(len(TEXTS)))], ["text", "id"])
    for limit in (1, 50, 10 ** 6):
        assert [i for b in blocks(batch.slice(2), "text", limit) for i in b["id"].to_pylist()] == list(range(2, len(TEXTS)))


@pytest.mark.parametrize("limit", [1, 300])
def test_results_do_not_depend_on_blocks(spark, monkeypatch, limit):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").coalesce(1)
    from recspark.llm import jaccard_join
    jobs = [lambda: bpe.digests(df, vocabulary()), lambda: license_scan.scan(df), lambda: jaccard_join.jaccard_join(df),
            lambda: context_mixing.score_documents(df, bits=16)]
    want = [sorted(map(str, job().drop("score", "bits_per_byte").collect())) for job in jobs]
    real = blocks
    for module in (bpe, license_scan, jaccard_join, context_mixing):
        monkeypatch.setattr(module, "blocks", lambda b, c, _=0: real(b, c, limit))
    assert [sorted(map(str, job().drop("score", "bits_per_byte").collect())) for job in jobs] == want
