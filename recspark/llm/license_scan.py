"""Operator 5: license scan.

Texts are read as word shingles.  For every template the text is covered by
windows of two blocks that overlap by one block, a block being at least one and
a half times the template's shingles (a power of two), so that any stretch of
that length lies within one window.  A window whose MinHash agrees with the
template's in any of ``BANDS`` bands of one row retrieves the template; the
share of the template's shingles found in the window is then counted exactly.

A window holds at most four times its template's shingles or so (block below
three times, window below six), so a match of containment ``c`` has a Jaccard
similarity ``j`` of at least ``c / 7`` and is missed with probability
``(1 - j) ** BANDS``: below 1e-6 for 0.8 and 128 bands.  Block minima are
shared: the minima of a larger block come from those of its halves.

One narrow pass over whole texts; the templates are a parameter and travel with
the tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import blocks, solid
from recspark.llm.shingles import hash_strings, mix

BANDS = 128
SHINGLE = 5
_MARK = 14
_TOP = np.uint64(2 ** 64 - 1)
_ODD = (mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

#: Notices by which common licenses are applied to a work.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files, to deal in the Software without restriction, including without "
                  "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                  "copies of the Software, subject to the following conditions",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the "
                         "License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
}

#: Names of licenses, as notices put them after ``_BEFORE``, and passages that stand by themselves.  The wordings are
#: those of the licenses and of their usual notices; each is found in any text around it.
_BEFORE = ("licensed under the", "released under the", "distributed under the", "available under the",
           "provided under the", "published under the", "terms of the")
_NAMES = {
    "MIT": ("MIT License", "MIT Licence"),
    "Apache-2.0": ("Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"),
    "BSD": ("BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "3-Clause BSD License", "2-Clause BSD License"),
    "ISC": ("ISC License",),
    "GPL": ("GNU GPL", "GPL License"),
    "GPL-2.0": ("GPL v2", "GPL version 2", "GPLv2 License"),
    "GPL-3.0": ("GPL v3", "GPL version 3", "GPLv3 License"),
    "LGPL": ("GNU LGPL", "LGPL License"),
    "AGPL": ("GNU AGPL", "AGPL License"),
    "MPL": ("Mozilla Public License", "MPL 2.0"),
    "Zlib": ("zlib License",),
    "EPL": ("Eclipse Public License",),
    "BSL-1.0": ("Boost Software License",),
    "Artistic": ("Artistic License",),
    "EUPL": ("European Union Public Licence",),
}
_CC = ("CC BY", "CC BY-SA", "CC BY-ND", "CC BY-NC", "CC BY-NC-SA", "CC BY-NC-ND")
_PASSAGES = {
    "MIT": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
            "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    "Apache-2.0": ("software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
                   "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    "BSD": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
            "in the documentation and/or other materials provided with the distribution",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES"),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
            "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    "GPL": ("GNU General Public License as published by the Free Software Foundation",
            "You should have received a copy of the GNU General Public License along with this program",
            "under the terms of the GNU General Public License", "licensed under the GNU General Public License",
            "The GNU General Public License is a free, copyleft license for software and other kinds of works"),
    "GPL-2.0": ("GNU General Public License version 2", "GNU General Public License v2", "GNU General Public License v2.0",
                "Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    "GPL-3.0": ("GNU General Public License version 3", "GNU General Public License v3", "GNU General Public License v3.0",
                "Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    "LGPL": ("GNU Lesser General Public License", "GNU Library General Public License"),
    "AGPL": ("GNU Affero General Public License",),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0",
                "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    "EPL-2.0": ("Eclipse Public License, Version 2.0", "Eclipse Public License v. 2.0"),
    "CDDL": ("Common Development and Distribution License",),
    "Zlib": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License - Version 1.0"),
    "Unlicense": ("This is free and unencumbered software released into the public domain",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    "WTFPL": ("Do What The Fuck You Want To Public License",),
    "OFL-1.1": ("SIL Open Font License, Version 1.1",),
    "GFDL": ("GNU Free Documentation License, Version", "terms of the GNU Free Documentation License"),
    "ODbL": ("Open Data Commons Open Database License",),
    "PSF": ("Python Software Foundation License Version 2",),
    "CC0-1.0": ("CC0 1.0 Universal Public Domain Dedication", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal",
                "has waived all copyright and related or neighboring rights", "dedicated to the public domain under CC0",
                "released into the public domain under CC0", "licensed under a CC0 1.0 license"),
    **{f"CC-{short}": (f"Creative Commons {name} 4.0 International",
                       f"Creative Commons {name} 3.0 Unported", f"Creative Commons {name} 4.0 License")
       for short, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                           ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                           ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))},
    "CC-BY-SA-body": ("If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original",),
    "CC-BY-body": ("You must give appropriate credit, provide a link to the license, and indicate if changes were made",),
}


def _wordings() -> dict[str, str]:
    """All further wordings, named by their license and a number."""
    have, out = {" ".join(t.lower().rstrip(".").split()) for t in TEMPLATES.values()}, {}
    texts = [(k, f"{before} {name}") for k, names in _NAMES.items() for name in names for before in _BEFORE]
    texts += [(f"{c.replace(' ', '-')}-{v}", f"{verb} under {c} {v}") for c in _CC for v in ("4.0", "3.0") for verb in ("licensed", "released", "available")]
    texts += [(k, t) for k, passages in _PASSAGES.items() for t in passages]
    number: dict[str, int] = defaultdict(int)
    for name, text in texts:
        if " ".join(text.lower().split()) not in have:
            number[name] += 1
            out[f"{name}/{number[name]}"] = text
    return out


#: What the query looks for: the notices above and the wordings of the license families.
LICENSES = {**TEMPLATES, **_wordings()}


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (lower case, outer punctuation cut off), and each word's text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(solid(texts)))
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    codes = lists.flatten().dictionary_encode()
    names = pc.ascii_trim(codes.dictionary, characters=".,;:!?()[]{}<>\"'`*#/-").cast(pa.large_string())
    index = codes.indices.to_numpy(zero_copy_only=False)
    full = pc.not_equal(names, "").to_numpy(zero_copy_only=False)[index] if len(names) else np.zeros(0, bool)
    return hash_strings(names)[index[full]], owner[full]


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashed shingles of one text's words, one for each start; a shorter text is one shingle."""
    if not len(words):
        return words
    n, width = max(1, len(words) - SHINGLE + 1), min(SHINGLE, len(words))
    h = np.full(n, np.uint64(width))
    for k in range(width):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n])
    return h


def block_size(count: int) -> int:
    return 1 << max(1, (-(-3 * count // 2) - 1).bit_length())


def _upper(shingles: np.ndarray) -> np.ndarray:
    """The upper halves of shingle hashes, which the bands permute."""
    return (shingles >> np.uint64(32)).astype(np.uint32)


class Templates:
    """Templates by block size: distinct shingles and their minima in every band."""

    def __init__(self, texts: Mapping[str, str]):
        self.by_block: dict[int, list[tuple[str, np.ndarray, np.ndarray]]] = defaultdict(list)
        for name, text in texts.items():
            own = np.unique(shingles(plain_words(pa.array([text], pa.large_string()))[0]))
            if len(own):
                minima = np.array([(_upper(own) * m).min() for m in _ODD])
                self.by_block[block_size(len(shingles(plain_words(pa.array([text], pa.large_string()))[0])))].append((name, own, minima))
        self.sizes = sorted(self.by_block)
        # by block size and band: the sorted minima, their templates, and a mark at the upper bits of each
        self.lookup: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for b, own in self.by_block.items():
            rows = np.array([minima for _, _, minima in own], np.uint32).T
            which = np.argsort(rows, axis=1, kind="stable")
            marks = np.zeros((BANDS, 1 << _MARK), bool)
            for band in range(BANDS):
                marks[band, rows[band] >> np.uint32(32 - _MARK)] = True
            self.lookup[b] = [(rows[k][which[k]], which[k], marks[k]) for k in range(BANDS)]


def candidates(padded: np.ndarray, templates: Templates) -> dict[int, set[tuple[int, int]]]:
    """For each block size the (block, template) pairs whose window's MinHash agrees in a band.

    ``padded`` holds shingles in whole blocks of the largest size; ``_TOP`` fills up.
    """
    found: dict[int, set[tuple[int, int]]] = {b: set() for b in templates.sizes}
    upper = _upper(padded)
    fill = np.where(padded == _TOP, np.uint32(0xFFFFFFFF), np.uint32(0))  # never a minimum beside others
    for band in range(BANDS):
        h = upper * _ODD[band]  # shingles are mixed hashes already
        h |= fill
        size = 1
        for b in templates.sizes:
            while size < b:
                h = np.minimum(h[0::2], h[1::2])
                size *= 2
            window = h.copy()
            np.minimum(h[:-1], h[1:], out=window[:-1])
            minima, which, mark = templates.lookup[b][band]
            near = np.flatnonzero(mark[window >> np.uint32(32 - _MARK)])
            begin, end = (np.searchsorted(minima, window[near], side) for side in ("left", "right"))
            for k in np.flatnonzero(end > begin):
                found[b].update((int(near[k]), int(t)) for t in which[begin[k]:end[k]])
    return found


def scan_texts(texts: pa.Array, templates: Templates, least: float) -> list[tuple[int, str, float, int, int, int]]:
    """Matches of a batch: text, template, containment, first and last word, number of matching windows.

    For each text and template the window of highest containment counts, the
    earliest of equals.
    """
    words, owner = plain_words(texts)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    top = templates.sizes[-1] if templates.sizes else 1
    parts, place, at = [], [], 0
    for k in np.flatnonzero(np.diff(ends)):
        s = shingles(words[ends[k]:ends[k + 1]])
        whole = -(-len(s) // top) * top + top  # an empty block keeps windows inside their text
        part = np.full(whole, _TOP)
        part[:len(s)] = s
        parts.append(part)
        place.append((at, at + whole, int(k), len(s), int(ends[k + 1] - ends[k])))
        at += whole
    if not parts:
        return []
    padded = np.concatenate(parts)
    starts = np.array([p[0] for p in place])
    best: dict[tuple[int, str], tuple[float, int, int, int]] = {}
    for b, pairs in candidates(padded, templates).items():
        for block, t in sorted(pairs):
            name, own, _ = templates.by_block[b][t]
            begin, _, text, count, n_words = place[int(np.searchsorted(starts, block * b, side="right")) - 1]
            first = block * b - begin
            window = padded[begin + first:begin + min(first + 2 * b, count)]
            hit = np.flatnonzero(np.isin(window, own))
            share = len(np.unique(window[hit])) / len(own)
            if share >= least - 1e-12:
                old = best.get((text, name))
                span = (first + int(hit[0]), min(first + int(hit[-1]) + SHINGLE, n_words) - 1)
                if old is None or share > old[0]:
                    best[(text, name)] = (share, *span, (old[3] if old else 0) + 1)
                else:
                    best[(text, name)] = (*old[:3], old[3] + 1)
    return [(k, name, *v) for (k, name), v in sorted(best.items())]


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, least: float = 0.8, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row for each document and template found in it: id, ``license``, ``containment``, ``first_word``,
    ``last_word`` (of the best window) and ``n_windows``.

    Null and blank texts match nothing; repeated rows are scanned each.  Words
    count after outer punctuation is cut off, those of punctuation alone are
    left out.  Columns other than the id are not carried.
    """
    known = dict(TEMPLATES if templates is None else templates)
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Templates(known)
        names = ["id", "license", "containment", "first_word", "last_word", "n_windows"]
        for batch in batches:
            for b in blocks(batch, "text", 1 << 20):
                rows = scan_texts(b["text"], own, least)
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
                kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.record_batch([b["id"].take(arrays[0]), *arrays[1:]], names)

    out = df.mapInArrow(run, f"id {kind}, license string, containment double, first_word long, last_word long, n_windows long")
    return out.withColumnRenamed("id", id_col)
