import random
import re

import pyarrow as pa

from recspark.llm import license_scan as L

CUT = ".,;:!?()[]{}<>\"'`*#/-"


def words(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    return [x.strip(CUT) for x in w if x.strip(CUT)]


def grams(w):
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def brute(text):
    """Best containment of each template over all stretches of the windows' reach."""
    g, out = grams(words(text)), {}
    for name, t in L.TEMPLATES.items():
        want, b = set(grams(words(t))), L.block_size(len(grams(words(t))))
        shares = [len(want & set(g[i:i + 2 * b])) / len(want) for i in range(0, len(g), b)]
        if shares and max(shares) >= 0.8:
            out[name] = max(shares)
    return out


def texts():
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(400)] + "the license under version work".split()
    out = [None, "", " \n\t", "MIT", *L.TEMPLATES.values(), "x " * 70_000 + L.TEMPLATES["GPL-3.0"]]
    for t in L.TEMPLATES.values():
        for _ in range(12):
            w = t.split()
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            out.append(" ".join([rnd.choice(vocab) for _ in range(rnd.randint(0, 400))] + w
                                + [rnd.choice(vocab) for _ in range(rnd.randint(0, 90))]))
    return out + [" ".join(rnd.choice(vocab) for _ in range(300)) for _ in range(40)]


def test_equals_brute_force(spark):
    rows = [(i, t, "clash") for i, t in enumerate(texts())] + [(4, texts()[4], "clash"), (None, texts()[5], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    out = L.scan(df).collect()
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], {})[r["license"]] = round(r["containment"], 9)
    want = {i: {k: round(v, 9) for k, v in brute(t).items()} for i, t, _ in rows}
    assert got == {k: v for k, v in want.items() if v}
    assert sum(r["doc_id"] == 4 for r in out) == 2 * len(want[4])


def test_span_points_at_the_notice():
    text = "one two three. " + L.TEMPLATES["Apache-2.0"] + " four five"
    ((_, name, share, first, last, _),) = L.scan_texts(pa.array([text]), L.Templates(L.TEMPLATES), 0.8)
    assert (name, share) == ("Apache-2.0", 1.0)
    assert " ".join(words(text)[first:last + 1]) == "licensed under the apache license version 2.0"


def test_clean_and_empty(spark):
    df = spark.createDataFrame([(1, "nothing of the kind is said here at all"), (2, None)], "doc_id long, text string")
    assert L.scan(df).collect() == [] and L.scan(df.limit(0)).collect() == []
    assert L.scan(df, {}).collect() == []


def test_wordings_that_are_not_in_the_list():
    said = {
        "MIT": "This project is licensed under the MIT License, see the file for details.",
        "GPL-3.0": "This program is licensed under the GNU General Public License, version 3, by its authors.",
        "GPL-2.0": "You may copy it under the GNU General Public License version 2 or later.",
        "LGPL": "The library may be linked as the GNU Lesser General Public License allows.",
        "AGPL": "Our server stands under the GNU Affero General Public License.",
        "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "ISC": "All of the code here is distributed under the ISC License by its maintainers.",
        "CC0-1.0": "The tables are given away by the CC0 1.0 Universal Public Domain Dedication.",
        "CC-BY": "These pictures have a Creative Commons Attribution 4.0 International licence.",
        "CC-BY-SA": "Text is under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "BSD": "The driver is available under the BSD 3-Clause License since last year.",
    }
    known = {" ".join(words(t)) for t in L.LICENSES.values()}
    assert not known & {" ".join(words(t)) for t in said.values()}
    for family, text in said.items():
        found = {m[1].split("/")[0] for m in L.scan_texts(pa.array([text]), L.Templates(L.LICENSES), 0.8)}
        assert family in found, (family, found)


def test_every_template_is_found_in_a_longer_text():
    known = L.Templates(L.LICENSES)
    names = list(L.LICENSES)
    texts = [f"some words that stand before it come first here {L.LICENSES[n]} and others follow it to the end of all" for n in names]
    found: dict[int, set[str]] = {}
    for text, name, *_ in L.scan_texts(pa.array(texts), known, 0.8):
        found.setdefault(text, set()).add(name)
    assert [n for k, n in enumerate(names) if n not in found.get(k, set())] == []
    assert min(len(words(t)) for t in L.LICENSES.values()) >= L.SHINGLE
