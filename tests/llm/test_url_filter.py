import numpy as np

from recspark.llm import url_filter as U
from recspark.llm.queries import URL_RULES

URLS = [None, "", "no-scheme/x", "HTTP://WWW.Example.NET/en/1?q=1", "http://example.net/EN/1", "http://a.net?x#y",
        "http://net/", "http://sub.example.com/de/3#t", "http://badexample.com/de/3", "https://m.site.org/fr/",
        "https://free-bets.site.org/en/7", "http://blog.casino-win.site.com/x", "http://www.ththble.site.com/en/9",
        "http://" + "long" * 30_000 + ".com/", "ftp://x#://y", "http://h/p?a=://b", "http://é.org/fr/ü"]


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def brute_rule(host, path):
    fit = [(h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda r: len(r[0])) if fit else (None, None)


def test_rules_and_model(spark):
    df = spark.createDataFrame([(i, u, "clash", 3) for i, u in enumerate(URLS)] + [(3, URLS[3], "clash", 3)],
                               "page_id long, url string, host string, other int")
    out = U.filter_urls(df, U.seed_urls(spark), URL_RULES).collect()
    assert len(out) == len(URLS) + 1
    for r in out:
        assert (r["host"], r["path"]) == brute_host_path(r["url"])
        rule, verdict = brute_rule(r["host"], r["path"])
        assert r["rule"] == rule and r["other"] == 3
        if verdict:
            assert r["verdict"] == verdict
    verdict = {r["url"]: r["verdict"] for r in out}
    assert verdict["https://free-bets.site.org/en/7"] == "block"
    assert verdict["http://blog.casino-win.site.com/x"] == "block"
    assert verdict["http://www.ththble.site.com/en/9"] == "allow"
    assert verdict[""] == "allow"


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert U.filter_urls(df, U.seed_urls(spark)).collect() == []


def test_held_out_stems(spark):
    held = (U.BLOCK_STEMS[::4], U.ALLOW_STEMS[::4])
    train = U.seed_urls(spark, *[[x for x in stems if x not in out] for stems, out in
                                 zip((U.BLOCK_STEMS, U.ALLOW_STEMS), held, strict=True)])
    got = U.filter_urls(U.seed_urls(spark, *held), train).collect()
    assert np.mean([(r["verdict"] == "block") == r["label"] for r in got]) > 0.85


def test_grams_do_not_cross_texts():
    a, own = U.gram_slots([b"abcdef", b"xy", b"abcdef"])
    assert sorted(a[own == 0]) == sorted(a[own == 2]) and not (own == 1).any()
