import hashlib
import random

import pytest
from tokenizers import Tokenizer

from recspark.llm import bpe as B
from recspark.llm.queries import vocabulary


@pytest.fixture(scope="module")
def both():
    with open(vocabulary(), encoding="utf-8") as f:
        return Tokenizer.from_file(vocabulary()), B.WordBpe(f.read())


def texts():
    rnd = random.Random(7)
    alphabet = "aeiou tshrnd'.,!?0123456789\n\t éüñß😀Σσς中文İ<|>́  "
    out = ["", " ", "don't WE'LL they're I'd 'sx", "a<|endoftext|>b<|startoftext|>", "<|endoftext|><|endoftext|", "ΑΣ ΣΑΣ",
           "x" * 40, "ab" * 500, "é" * 33, "supercalifragilisticexpialidocious", "école ́x", "1234 ½ ² ٣"]
    out += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 300))) for _ in range(300)]
    out += ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(1, 45))) for _ in range(500)]
    return out


def test_ids_equal_the_library(both):
    tok, own = both
    ids, offsets = own.encode(texts())
    for k, t in enumerate(texts()):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_long_and_short_merges_agree(both):
    _, own = both
    rnd = random.Random(1)
    words = [bytes(rnd.choice(b"etaoinshrdlu") for _ in range(rnd.randint(1, 32))) for _ in range(500)]
    flat, starts = own.merge_all(words)
    assert [flat[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == [own.merge_long(w) for w in words]


def test_segments_do_not_change_ids(both, monkeypatch):
    _, own = both
    text = "the quick  brown fox's tail\n" * 50
    whole = own.encode([text])[0].tolist()
    monkeypatch.setattr(B, "_SEGMENT", 7)
    assert own.encode([text])[0].tolist() == whole


def test_characters(both):
    tok, own = both
    codes = [*range(1, 0x3000), *range(0xA000, 0xAC00), *range(0xF900, 0x12000), *range(0x1D400, 0x1F700)]
    chars = [f"a{chr(c)}b" for c in codes]
    ids, offsets = own.encode(chars)
    bad = [t for k, t in enumerate(chars)
           if ids[offsets[k]:offsets[k + 1]].tolist() != tok.encode(t, add_special_tokens=False).ids]
    assert bad == []


def test_digests(spark, both):
    tok, _ = both
    rows = [(i, t, "clash") for i, t in enumerate([None, *texts()[:60], "word " * 60_000])]
    rows.append(rows[5])
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = B.digests(df, vocabulary()).collect()
    assert len(out) == len(rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in out:
        ids = tok.encode(rows[r["doc_id"]][1] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(tok.decode(ids, skip_special_tokens=False))
    assert B.digests(spark.createDataFrame([], "doc_id long, text string"), vocabulary()).collect() == []
