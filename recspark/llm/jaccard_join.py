"""Operator 4: n-gram Jaccard join by PartEnum signatures.

Documents whose sets of word shingles have a Jaccard similarity of at least
``num / den`` are linked.  Sizes are cut into bands.  Two linked sets, the
smaller in a band with largest size ``r``, differ in at most
``k = r * (den - num) // num`` elements.  The element domain is hashed into
``n1`` parts of ``n2`` sub-parts each; at least ``good = n1 - k // (k2 + 1)``
parts hold no more than ``k2`` differences, and in each of them both sets agree
on some ``n2 - k2`` sub-parts.  Each choice of sub-parts of each part is a
signature; a set gives those of its own band, and those of the band below when
its size is within reach of it.  ``plan`` picks ``n1, n2, k2`` for each band.

Sub-parts without elements agree between any two sets, so a signature of empty
sub-parts is never given.  The guarantee stays: a set is strong in one hashing of
the domain when fewer than ``good`` of its parts have an empty choice, and gives
the signatures of one hashing after the other up to the first in which it is
strong.  Of two linked sets, the one that is strong first has a part there in
which both agree and none of its choices is empty.

Equal sets are one class, and a class gives its signatures once a block of texts.
They travel packed, eight bytes each, to buckets of about ``BUCKET`` shingles, and
a bucket hands on only those that several classes share.  Classes that share
``STRONG`` signatures with the first class of each form clusters.  A class that
shares ``STRONG`` signatures with members of a cluster, each of them held by one
in ``COMMON`` members at least, brings its own cluster into that one.  What else
shares a signature is compared across clusters: inside that signature's group
alone while it has at most ``GROUP`` classes, so chance collisions never chain
clusters together; of a larger group, those outside its main cluster are guests
of that cluster, once however many signatures bring them there.  All kinds of
units are compared exactly: a unit is cut into blocks, and each pair of blocks
is one task that counts the intersections.  A cluster returns one row for each
class, with its number of links and at most one parent, so that no pair of a
large group of copies is ever a row; links across clusters are rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.common import blocks, stored
from recspark.llm.graph import components
from recspark.llm.shingles import mix, shingle_sets

BAND = 1.4
AGREED = 3.0
HASHINGS = 12
STRONG = 3
COMMON = 64
GROUP = 32
BUCKET = 2_000_000
SLICES = 16
BATCH = 4 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def bands(largest: int, num: int, den: int) -> np.ndarray:
    """The largest size of each band, the first being the sizes that only equal sets link."""
    out = [num // (den - num) - 1 if num % (den - num) == 0 else num // (den - num)]
    while out[-1] < largest:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return np.array(out, np.int64)


@cache
def plan(least: int, largest: int, num: int, den: int) -> tuple[int, int, int, int]:
    """``n1, n2, k2, good`` of a band of sizes: the fewest signatures that agree on enough elements.

    A signature of the band's smallest sets should stand for ``AGREED`` elements
    (or a bit over half of a tiny set), and few sets should be weak in a hashing.
    """
    k = largest * (den - num) // num
    best = None
    for k2 in range(1, min(k, 6) + 1):
        need = k // (k2 + 1)
        for n2 in range(k2 + 1, k2 + 6):
            for more in sorted({0, 1, 2, 3, 4, 6, 8, 12, need // 10, need // 8, need // 6, need // 4}):
                n1 = need + 1 + more
                agreed = least * (n2 - k2) / (n1 * n2)
                weak = n1 * min(1.0, math.comb(n2, k2) * math.exp(-agreed))  # expected parts with an empty choice
                tail = 1.0 if weak > more else 1 - sum(
                    math.exp(i * math.log(max(weak, 1e-300)) - weak - math.lgamma(i + 1)) for i in range(more + 1))
                fits = agreed >= min(AGREED, 0.55 * least) and tail < 0.3
                cost = (not fits, tail if not fits else n1 * math.comb(n2, k2) / (1 - tail))
                if best is None or cost < best[0]:
                    best = cost, (n1, n2, k2, 1 + more)
    return best[1]


def signatures(elements: np.ndarray, owner: np.ndarray, n: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of sets given as sorted (owner, element): signatures and their owners."""
    size = np.bincount(owner, minlength=n)
    tops = bands(int(size.max(initial=0)), num, den)
    band = np.searchsorted(tops, size)
    ends = np.cumsum(size)
    sigs, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for below in (0, 1):
        b = band - below
        near = (b >= 1) if below == 0 else (b >= 1) & (size * num <= tops[np.maximum(b, 0)] * den)
        for one in np.unique(b[near]):
            n1, n2, k2, good = plan(int(tops[one - 1]) + 1, int(tops[one]), num, den)
            sets = np.flatnonzero(near & (b == one))
            for hashing in range(HASHINGS):
                if not len(sets):
                    break
                place = np.repeat(np.arange(len(sets)), size[sets])
                mine = np.repeat(ends[sets] - size[sets], size[sets]) + np.arange(len(place)) - np.repeat(
                    np.cumsum(size[sets]) - size[sets], size[sets])
                seed = mix(np.full(1, one * HASHINGS + hashing + 1, np.uint64) * _ODD)
                h = mix(elements[mine] ^ seed)
                cell = place * (n1 * n2) + (h % np.uint64(n1 * n2)).astype(np.int64)
                total = np.zeros(len(sets) * n1 * n2, np.uint64)
                np.add.at(total, cell, mix(h + _ODD))
                total = total.reshape(-1, n1, n2)
                full = (np.bincount(cell, minlength=total.size) > 0).reshape(-1, n1, n2)
                part = mix(np.arange(n1, dtype=np.uint64) * np.uint64(1024) + seed)
                weak = np.zeros((len(sets), n1), bool)
                keep_empty = hashing == HASHINGS - 1  # reached by next to no set; then nothing is left out
                for number, chosen in enumerate(combinations(range(n2), n2 - k2)):
                    sig = part[None, :] + np.uint64(number)
                    some = np.zeros((len(sets), n1), bool)
                    for c in chosen:
                        sig = mix(sig * np.uint64(3) + total[:, :, c])
                        some |= full[:, :, c]
                    weak |= ~some
                    who, at = np.nonzero(some | keep_empty)
                    sigs.append(sig[who, at])
                    owners.append(sets[who])
                sets = sets[weak.sum(1) >= good]
    return np.concatenate(sigs), np.concatenate(owners)


def pack(sig: np.ndarray, who: np.ndarray, own: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    """Signatures (48 bits of them) by bucket: the classes there, then six bytes a signature and two for its class."""
    sig = sig >> np.uint64(16)
    bucket = (sig % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((sig, bucket))
    sig, who, bucket = sig[order], who[order], bucket[order]
    out = []
    for part in np.split(np.arange(len(sig)), np.flatnonzero(np.diff(bucket)) + 1):
        if len(part):
            rows, place = np.unique(who[part], return_inverse=True)
            short = sig[part].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            out.append((int(bucket[part[0]]), np.array([len(rows)], "<u4").tobytes() + own[rows].astype("<i8").tobytes()
                        + short.tobytes() + place.astype("<u2").tobytes()))
    return out


def unpack(data) -> tuple[np.ndarray, np.ndarray]:
    """The signatures and classes of ``pack``."""
    raw = np.frombuffer(data, np.uint8)
    n = int(raw[:4].view("<u4")[0])
    classes, rest = np.frombuffer(data, "<i8", n, 4), raw[4 + 8 * n:]
    many = len(rest) // 8
    wide = np.zeros((many, 8), np.uint8)
    wide[:, :6] = rest[:6 * many].reshape(-1, 6)
    place = np.frombuffer(rest[6 * many:].tobytes(), "<u2")
    return wide.reshape(-1).view("<i8"), classes[place]


def _classes(elements: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """One hash for each set from its elements and size; 0 for an empty set."""
    total = np.zeros((n, 2), np.uint64)
    np.add.at(total, owner, np.column_stack([mix(elements + _ODD), mix(elements * np.uint64(3))]))
    size = np.bincount(owner, minlength=n)
    return np.where(size > 0, mix(mix(total[:, 0]) + total[:, 1] * np.uint64(5) + size.astype(np.uint64)), 0).astype(np.int64)


def _compare(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, num: int, den: int) -> np.ndarray:
    """Links among the sets as a boolean matrix: of different labels, and only between sides 0 and 1 when there are two."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    code = np.cumsum(new) - 1
    shared = np.bincount(code)[code] > 1  # an element of one set is in no intersection
    owner, code = owner[shared], np.unique(code[shared], return_inverse=True)[1]
    both = np.zeros((n, n), np.float64)
    width = 8192
    for at in range(0, int(code.max(initial=-1)) + 1, width):
        lo, hi = np.searchsorted(code, [at, at + width])
        dense = np.zeros((n, width), np.float32)
        dense[owner[lo:hi], code[lo:hi] - at] = 1
        both += dense @ dense.T
    inter = both.astype(np.int64)
    links = inter * den >= num * (size[:, None] + size[None, :] - inter)
    if side.any():
        links &= side[:, None] != side[None, :]
    return links & (label[:, None] != label[None, :])


def _forest(links: np.ndarray) -> np.ndarray:
    """For each row its parent in a spanning forest of the links, itself for a root."""
    n = len(links)
    parent, seen = np.arange(n), np.zeros(n, bool)
    for root in range(n):
        if seen[root]:
            continue
        seen[root] = True
        queue = [root]
        while queue:
            x = queue.pop()
            fresh = np.flatnonzero(links[x] & ~seen)
            seen[fresh], parent[fresh] = True, x
            queue.extend(fresh.tolist())
    return parent


def _labelled(shared: DataFrame, near: DataFrame) -> DataFrame:
    """``shared`` with each class's label: its cluster, itself without one."""
    return (shared.select("sig", "class").join(near, "class", "left")
            .select("sig", "class", F.coalesce("cluster", "class").alias("label")))


def _mixed(labelled: DataFrame) -> DataFrame:
    """Signatures of several labels: ``main``, the label with most classes there, ``held`` such classes, ``m`` classes in all."""
    own = labelled.groupBy("sig", "label").agg(F.count(F.lit(1)).alias("c"))
    each = own.groupBy("sig").agg(F.min(F.struct((-F.col("c")).alias("less"), "label")).alias("main"), F.sum("c").alias("m"))
    return each.select("sig", F.col("main.label").alias("main"), (-F.col("main.less")).alias("held"), "m").filter("held < m")


def _units(shared: DataFrame) -> DataFrame:
    """Rows ``kind, unit, class, label``: the classes to compare with each other, those of one label only in kind 0."""
    strong = (shared.filter("class <> leader").groupBy("class", "leader").count().filter(F.col("count") >= STRONG)
              .select(F.col("class").alias("a"), F.col("leader").alias("b")))
    near = components(strong).select(F.col("id").alias("class"), F.col("component").alias("cluster"))
    # near copies whose signatures have many leaders: what shares as many signatures with a cluster as with a leader joins it
    labelled = stored(_labelled(shared, near), "jaccard-labelled")
    size = near.groupBy(F.col("cluster").alias("main")).agg(F.count(F.lit(1)).alias("size"))
    common = _mixed(labelled).join(size, "main", "left").filter(F.col("held") * COMMON >= F.coalesce("size", F.lit(1)))
    again = (labelled.join(common.select("sig", "main"), "sig").filter("label <> main").groupBy("class", "label", "main").count()
             .filter(F.col("count") >= STRONG).select(F.col("label").alias("a"), F.col("main").alias("b")))
    near = components(near.select(F.col("class").alias("a"), F.col("cluster").alias("b")).unionByName(again))
    near = near.select(F.col("id").alias("class"), F.col("component").alias("cluster"))
    labelled = stored(_labelled(shared, near), "jaccard-labelled")
    # of a large group, only those outside its main label are rows, once for each main label
    met = (labelled.join(_mixed(labelled), "sig").filter((F.col("m") <= GROUP) | (F.col("label") != F.col("main")))
           .select(F.when(F.col("m") <= GROUP, 1).otherwise(2).alias("kind"),
                   F.when(F.col("m") <= GROUP, F.col("sig")).otherwise(F.col("main")).alias("unit"), "class", "label").distinct())
    met = stored(met, "jaccard-met")
    hosts = met.filter("kind = 2").select("kind", "unit").distinct()
    whole = (hosts.join(near, hosts["unit"] == near["cluster"]).select("kind", "unit", "class")
             .union(hosts.select("kind", "unit", F.col("unit").alias("class"))).distinct()  # a label is its smallest class
             .withColumn("label", F.col("unit")))
    return (near.select(F.lit(0).alias("kind"), F.col("cluster").alias("unit"), "class", F.col("class").alias("label"))
            .unionByName(met).unionByName(whole))


def _linked(docs: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int, block_rows: int,
            block_elements: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``id, n, class`` of all documents, and of each class with an id and words:
    ``class, component, n_links, id, code`` (the smallest id, and that row's text as a hash).
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, "text", 1 << 20):
                e, o = shingle_sets(b["text"], width)
                yield pa.record_batch([b["id"], b["code"], pa.array(np.bincount(o, minlength=b.num_rows)),
                                       pa.array(_classes(e, o, b.num_rows))], ["id", "code", "n", "class"])

    # long texts would travel to Python ten thousand at a time
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    code = F.xxhash64(F.col(text_col))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), code.alias("code"), F.col(text_col).alias("text"))
    base = stored(texts.mapInArrow(read, "id long, code long, n long, class long"), "jaccard-base")
    some = base.filter("id is not null and n > 0")
    reps = some.groupBy("class").agg(F.min(F.struct("id", "code")).alias("first"), F.max("n").alias("n"),
                                     F.count(F.lit(1)).alias("copies"))
    reps = stored(reps.select("class", "first.id", "first.code", "n", "copies"), "jaccard-reps")
    buckets = (reps.agg(F.sum("n")).first()[0] or 0) // BUCKET + 8

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Signatures of the classes of each block of texts, packed by bucket."""
        for batch in batches:
            for b in blocks(batch, "text"):
                for at in range(0, b.num_rows, 1 << 15):
                    text = b["text"].slice(at, 1 << 15)
                    e, o = shingle_sets(text, width)
                    own = _classes(e, o, len(text))
                    lead = np.zeros(len(text), bool)  # copies within a block give their signatures once
                    lead[np.unique(own, return_index=True)[1]] = True
                    packed = pack(*signatures(e[lead[o]], o[lead[o]], len(text), num, den), own, buckets)
                    yield pa.record_batch([pa.array([k for k, _ in packed], pa.int64()),
                                           pa.array([d for _, d in packed], pa.binary())], ["bucket", "data"])
                    del e, o, packed
        pa.default_memory_pool().release_unused()

    def meet(group: pa.Table) -> pa.Table:
        """The signatures of a bucket that several classes share, with the smallest of them."""
        parts, out = [unpack(d.as_buffer()) for c in group["data"].chunks for d in c], []
        for k in range(SLICES):  # the parts are sorted; only what is shared outlives its slice
            cuts = [np.searchsorted(s, [k * (1 << 48) // SLICES, (k + 1) * (1 << 48) // SLICES]) for s, _ in parts]
            sig, klass = (np.concatenate([p[n][x:y] for p, (x, y) in zip(parts, cuts, strict=True)]) for n in (0, 1))
            order = np.lexsort((klass, sig))
            sig, klass = sig[order], klass[order]
            fresh = np.ones(len(sig), bool)
            fresh[1:] = (np.diff(sig) != 0) | (np.diff(klass) != 0)
            sig, klass = sig[fresh], klass[fresh]
            first = np.ones(len(sig), bool)
            first[1:] = np.diff(sig) != 0
            group_of = np.cumsum(first) - 1
            many = np.bincount(group_of)[group_of] > 1
            out.append(pa.table({"sig": sig[many], "class": klass[many], "leader": klass[first][group_of][many]}))
        del parts
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(out)

    shared = (texts.filter("id is not null").select("text").mapInArrow(sign, "bucket long, data binary")
              .groupBy("bucket").applyInArrow(meet, "sig long, class long, leader long"))
    shared = stored(shared, "jaccard-shared")
    units = _units(shared)
    members = units.join(reps, "class")
    sizes = members.groupBy("kind", "unit").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("e"))
    cut = F.greatest(F.ceil(F.col("m") / block_rows), F.ceil(F.col("e") / block_elements)).cast("int")
    members = members.join(sizes.select("kind", "unit", cut.alias("cuts")), ["kind", "unit"]).withColumn(
        "part", F.pmod(F.xxhash64("class"), F.col("cuts")).cast("int"))
    members = stored(members.groupBy("class", "id", "code", "copies").agg(
        F.collect_list(F.struct("kind", "unit", "label", "cuts", "part")).alias("units")), "jaccard-members")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["class", "copies", "units"]
        for batch in batches:
            for b in blocks(batch, "text", 1 << 20):
                e, o = shingle_sets(b["text"], width)
                own = pa.array(_classes(e, o, b.num_rows))
                ends = np.searchsorted(o, np.arange(b.num_rows + 1))
                data = [e[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
                out = pa.record_batch([*[b[c] for c in names], pa.array(data, pa.binary())], [*names, "elements"])
                yield out.filter(pa.compute.equal(own, b["class"]))

    # the same join at every size: texts are shuffled once, by id
    with_sets = texts.filter("id is not null").join(members.hint("merge"), ["id", "code"]).select("text", "class", "copies", "units")
    unit = "struct<kind: int, unit: bigint, label: bigint, cuts: int, part: int>"
    with_sets = (with_sets.mapInArrow(sets, f"class long, copies long, units array<{unit}>, elements binary")
                 .select("class", "copies", "elements", F.explode("units").alias("u")).select("class", "copies", "elements", "u.*"))
    # a pair of blocks is a task; units of one block share tasks
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    packs = members.agg(F.sum(F.size("units"))).first()[0] or 0
    packs = packs // 512 + 1
    pairs = (with_sets.withColumn("other", other)
             .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other"),
                           "pack": F.when(F.col("cuts") == 1, F.pmod(F.xxhash64("unit"), F.lit(packs))).otherwise(F.xxhash64("kind", "unit"))}))

    def verify(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        kind, unit, label, klass, copies = (np.asarray(group[c]) for c in ("kind", "unit", "label", "class", "copies"))
        order = np.lexsort((klass, unit, kind))
        again = np.zeros(len(order), bool)  # ids that repeat bring a class twice
        again[1:] = (np.diff(kind[order]) == 0) & (np.diff(unit[order]) == 0) & (np.diff(klass[order]) == 0)
        order = order[~again]
        elements, part = group["elements"], np.asarray(group["part"])
        one_block = int(group["i"][0].as_py()) == int(group["j"][0].as_py())
        out: dict[str, list] = {"kind": [], "a": [], "b": [], "links": []}
        for rows in np.split(order, np.flatnonzero((np.diff(unit[order]) != 0) | (np.diff(kind[order]) != 0)) + 1):
            two = part[rows] != part[rows].min()
            if len(rows) < 2 or (not one_block and not two.any()):
                continue
            links = _compare([np.frombuffer(elements[int(r)].as_py(), np.uint64) for r in rows], label[rows], two, num, den)
            if kind[rows[0]]:
                a, b = np.nonzero(links)
                count = copies[rows][b]
            else:
                a, b, count = np.arange(len(rows)), _forest(links), links @ copies[rows]
            out["kind"] += [int(kind[rows[0]])] * len(a)
            out["a"] += klass[rows][a].tolist()
            out["b"] += klass[rows][b].tolist()
            out["links"] += count.tolist()
        return pa.table({"kind": pa.array(out["kind"], pa.int32()), **{k: pa.array(out[k], pa.int64()) for k in ("a", "b", "links")}})

    found = stored(pairs.groupBy("pack", "i", "j").applyInArrow(verify, "kind int, a long, b long, links long"), "jaccard-found")
    across = found.filter("kind > 0").select("a", "b", "links").distinct()  # two classes may meet in several units
    found = found.filter("kind = 0").select("a", "b", "links").unionByName(across)
    linked = components(found.select("a", "b")).select(F.col("id").alias("class"), "component")
    degrees = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    of_class = (reps.join(linked, "class", "left").join(degrees, "class", "left")
                .select("class", F.coalesce("component", "class").alias("component"), "id", "code",
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    joined = base.select("id", "n", F.when(F.expr("id is not null and n > 0"), F.col("class")).alias("class"))
    return joined, stored(of_class, "jaccard-linked")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, num: int = 9,
                 den: int = 10, block_rows: int = 256, block_elements: int = 1_000_000) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``n_links``.

    Words are lower-cased (A-Z); a text of fewer than ``width`` words is one
    shingle, a text without words has none and links with nothing.  The
    component is the smallest id reachable over links, ``n_links`` the number
    of documents linked directly, copies included.  Rows that repeat an id are
    documents of their own with that id.  Rows without an id get null as their
    component and link with nothing.  Other columns are not carried.
    """
    rows, of_class = _linked(docs, id_col, text_col, width, num, den, block_rows, block_elements)
    first = of_class.groupBy("component").agg(F.min("id").alias("component_id"))
    answer = of_class.join(first, "component").select("class", "component_id", "n_links")
    return rows.join(answer, "class", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 4,
                den: int = 5) -> DataFrame:
    """``docs`` with one row of each group of linked documents: the one with the smallest id.

    Rows without an id and texts without words are linked with nothing and stay,
    repeated or not.  Where the smallest id of a group repeats, one of its rows
    that belong to the group stays, the first by text and then by all columns;
    rows of that id with another text belong to their own group.  All columns
    are carried.
    """
    names = docs.columns
    _, of_class = _linked(docs, id_col, text_col, width, num, den, 256, 1_000_000)
    first = of_class.groupBy("component").agg(F.min(F.struct("id", "code")).alias("first"))
    first = first.select(F.col("first.id").alias("id"), F.col("first.code").alias("code"))
    bare = F.coalesce(~F.col(text_col).rlike("[^\\x20\\x09-\\x0D]"), F.lit(True)) | F.col(id_col).isNull()
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    wrapped = docs.filter(~bare).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("code"), row.alias("row"))
    again = Window.partitionBy("id", "code").orderBy(F.xxhash64("row"), "row.c0")
    kept = wrapped.join(first, ["id", "code"]).withColumn("at", F.row_number().over(again)).filter("at = 1")
    return kept.select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(names)]).unionByName(docs.filter(bare))
