import random
import re

from recspark.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, source string, kept int, __x int"


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed)


def texts():
    rnd = random.Random(4)
    out = [None, "", " \t\r\n", "one", "a b c d e", "a a a a a a", "x\n\nx\n x\nx", "é ü z | # <>", "a b c d e " * 40]
    for _ in range(60):
        out.append(" ".join(rnd.choice("abcdef") + "\n" * rnd.randint(0, 1) for _ in range(rnd.randint(1, 80))))
        out.append(" ".join(str(rnd.randint(0, 500)) for _ in range(rnd.randint(1, 300))))
    out.append(" ".join(str(rnd.randint(0, 40)) for _ in range(30_000)))
    return out


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_measures_match_brute_force(spark, monkeypatch):
    rows = [(i, t, "h", 1, 1) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, SCHEMA)
    for bits in (24, 58):  # 58 leaves 6 hash bits, so the whole-hash path is taken
        monkeypatch.setattr(Q, "_POS_BITS", bits)
        monkeypatch.setattr(Q, "_POS", (1 << bits) - 1)
        got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in Q.measure(df).collect()}
        for i, t, *_ in rows:
            assert got[i] == brute(t), (i, t)


def test_host_verdict_is_strict_only_on_bad_hosts(spark):
    clean = " ".join(f"word{i}" for i in range(30))
    soft = " ".join(f"word{i} #" for i in range(30))
    rows = [(i, soft, "bad", 1, 1) for i in range(60)] + [(100 + i, clean, "bad", 1, 1) for i in range(5)]
    rows += [(200 + i, clean, f"ok{i % 4}", 1, 1) for i in range(120)] + [(400, soft, "ok0", 1, 1)]
    rows += [(500, clean, None, 1, 1), (None, soft, "tiny", 1, 1), (501, None, "bad", 1, 1)]
    out = {r["doc_id"]: r for r in Q.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(out) == len(rows)
    assert not any(out[i]["kept"] for i in range(60))
    assert all(out[100 + i]["kept"] for i in range(5)) and out[400]["kept"] and out[500]["kept"]
    assert out[0]["host_rate"] > 0.5 > out[200]["host_rate"]
    assert not out[501]["kept"] and out[0]["__x"] == 1


def test_empty_table(spark):
    assert Q.quality_rules(spark.createDataFrame([], SCHEMA)).collect() == []


def test_many_hosts_join_by_salts(spark, monkeypatch):
    from recspark.llm import common
    rows = [(i, t, f"h{i % 3}" if i % 4 else None, 1, 1) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(str, Q.quality_rules(df).collect()))
    real = common.join_small
    monkeypatch.setattr(Q, "join_small", lambda *a, **k: real(*a, **k, most=0, salts=5))
    assert sorted(map(str, Q.quality_rules(df).collect())) == want
