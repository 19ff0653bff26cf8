"""N-gram Jaccard join over count-vector R-trees.

A document's set is its distinct k-word shingles, hashed to 64 bits. Hashing shingles into
groups gives a vector of counts, a point; the overlap of two sets is at most the sum of the
coordinate minima of their points, and of a point and a tree node at most the sum of the
minima with the node's upper corner. Packed R-trees over the points are searched with this
bound, and surviving pairs are verified on the exact sets.

One tree over all points can't prune: points of unrelated texts of one length lie within a few
counts of each other in every coordinate, so its nodes overlap in all of them. So there is a
forest: a tree for each shingle of the sets' prefixes. Two sets of similarity t share a
shingle among the first n - ceil(t n) + 1 of each, in any order common to all sets; the
order here puts frequent shingles last, so that trees stay small. A shingle that still has
many documents gets a tree of several leaves by size band and hash, and only pairs of leaves
whose corners allow the overlap are opened.

Equal sets are joined as classes first, whatever their number; links are found between class
representatives. In large trees each document is first verified against one centre, the least
id of its tree and size band. Those that link to it are connected and need not meet each
other, so of a large group of near copies only the leftovers are compared with the rest: the
cost of a group grows with its documents and its leftovers, not with its pairs. A leaf's
candidates leave it as a star for each of its components, those of two leaves as a link for
each two components, and the verification of a cluster skips pairs that are connected already.

The operator returns components. It does not list links, nor count those of a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.operators.graph import connected_components

from .common import Scratch, arrow_map, documents, fold_table, marks_of, may_match, mix, most_frequent, release_memory, separators, signed, split_by_marks, text_slices, word_hashes

#: Shingles a group on the average, and the bounds of the number of groups, as powers of two.
#: Counts of unrelated sets then differ by more in sum than similar sets may.
GROUP_SHINGLES, LEAST_BITS, MOST_BITS = 16, 5, 13
#: Documents in a leaf; documents and shingles in a tile of a cluster.
LEAF, TILE_DOCS, TILE_SHINGLES = 128, 512, 1 << 20
#: Shingles that are put last in the order: the most frequent ones, at most so many.
FREQUENT, LAST = 64, 1 << 16
_APART, _FOLD = separators(), fold_table()
_M = np.uint64(0x9E3779B97F4A7C15)


# Sets -------------------------------------------------------------------------------------------


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's k-word shingles; fewer words are one shingle, no words none."""
    for begin, end, data, offsets in text_slices(texts):
        words, at, _, _ = word_hashes(data, offsets, _APART, _FOLD)
        rolled = words
        for j in range(1, k):
            rolled = mix(rolled[:-1] * _M + words[j:]) if len(rolled) > 1 else rolled[:0]
        for row in range(end - begin):
            a, b = at[row], at[row + 1]
            if b - a >= k:
                yield np.unique(rolled[a : b - k + 1])
            elif b > a:
                own = words[a : a + 1]
                for word in words[a + 1 : b]:
                    own = mix(own * _M + word)
                yield mix(own + np.uint64(b - a))
            else:
                yield words[:0]


def count_vector(own: np.ndarray) -> np.ndarray:
    """How many hashes of a set fall into each group; longer sets have more groups, by halving those of shorter ones."""
    bits = min(MOST_BITS, max(LEAST_BITS, (len(own) // GROUP_SHINGLES).bit_length()))
    return np.bincount((own >> np.uint64(64 - bits)).astype(np.intp), minlength=1 << bits).astype(np.int32)


def pack_counts(counts: np.ndarray) -> bytes:
    """One byte a count where they fit, else four; the first byte says which."""
    small = counts.max(initial=0) < 256
    return (b"\1" + counts.astype("u1").tobytes()) if small else b"\4" + counts.astype("<u4").tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "u1" if data[0] == 1 else "<u4", offset=1).astype(np.int32)


def prefix_length(n: int, percent: int) -> int:
    """n - ceil(n * percent / 100) + 1."""
    return n - -(-n * percent // 100) + 1


def points(docs: DataFrame, k: int, percent: int, last: np.ndarray | None) -> DataFrame:
    """(doc_id, n, sig1, sig2, prefix, point); without `last` only the prefixes, in hash order.

    last: hashes, sorted; they come after all others in the order.
    """

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, sig, prefix, point = [], [], [], []
        for own in shingle_sets(batch.column(1), k):
            p = prefix_length(len(own), percent) if len(own) else 0
            n.append(len(own))
            if last is None:
                prefix.append(signed(own[:p]))
                continue
            sig.append(np.frombuffer(blake2b(own.tobytes(), digest_size=16).digest(), np.int64))
            point.append(pack_counts(count_vector(own)))
            if len(last):
                # Of the frequent ones only as many are needed as others are lacking.
                at = np.minimum(np.searchsorted(last, own), len(last) - 1)
                rare = last[at] != own
                own = np.concatenate([own[rare], own[~rare]]) if np.count_nonzero(rare) < p else own[rare]
            prefix.append(signed(own[:p]))
        lists = pa.array(prefix, pa.list_(pa.int64()))
        if last is None:
            yield pa.RecordBatch.from_arrays([lists], ["prefix"])
            return
        sigs = np.stack(sig) if sig else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sigs[:, 0]), pa.array(sigs[:, 1]), lists, pa.array(point, pa.binary())], ["doc_id", "n", "sig1", "sig2", "prefix", "point"])

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin in range(0, len(batch), 1024):
            yield from rows(batch.slice(begin, 1024))

    schema = "prefix array<long>" if last is None else "doc_id long, n long, sig1 long, sig2 long, prefix array<long>, point binary"
    return arrow_map(docs, each, schema)


def frequent_shingles(docs: DataFrame, k: int, percent: int, scratch: Scratch) -> np.ndarray:
    """The hashes to put last: found in over FREQUENT prefixes, the LAST most frequent of them at most.

    All documents are counted. The result is at most LAST * 8 bytes at any input size; it only
    sets the order, every order gives the same links.
    """
    counts = points(docs, k, percent, None).select(F.explode("prefix").alias("t")).groupBy("t").count().where(F.col("count") > FREQUENT)
    top = most_frequent(scratch.save(counts, "frequent"), "count", LAST).select("t").collect()
    scratch.drop("frequent")
    return np.sort(np.array([r.t for r in top], np.int64).view(np.uint64))


# Trees ------------------------------------------------------------------------------------------


class CountTree:
    """A packed R-tree over count vectors, built bottom up from points sorted by their total.

    Nodes keep their upper corner and the range of totals below them.
    """

    def __init__(self, points: np.ndarray, totals: np.ndarray, fanout: int = 16) -> None:
        self.points, self.totals, self.fanout = points, totals, fanout
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        corner, low, high = points, totals, totals
        while len(corner) > fanout:
            cuts = np.arange(0, len(corner), fanout)
            corner, low, high = np.maximum.reduceat(corner, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((corner, low, high))

    def search(self, point: np.ndarray, total: int, percent: int) -> np.ndarray:
        """Places of the points that may have this similarity with a point."""
        found = None
        for corner, low, high in reversed(self.levels):
            found = np.arange(len(corner)) if found is None else _below(found, self.fanout, len(corner))
            bound = np.minimum(corner[found], point).sum(1)
            # A set below a node has at least `low` shingles, and one of over total * 100 / percent can't match.
            found = found[((100 + percent) * bound >= percent * (total + low[found])) & (100 * high[found] >= percent * total) & (100 * total >= percent * low[found])]
        found = np.arange(len(self.points)) if found is None else _below(found, self.fanout, len(self.points))
        bound = np.minimum(self.points[found], point).sum(1)
        return found[(100 + percent) * bound >= percent * (total + self.totals[found])]


def _below(nodes: np.ndarray, fanout: int, end: int) -> np.ndarray:
    below = (nodes[:, None] * fanout + np.arange(fanout)).ravel()
    return below[below < end]


def near_places(vectors: list[np.ndarray], n: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, places j > i that may have this similarity with i), for sets ordered by their sizes n.

    Vectors of each number of groups make a tree together with those of twice as many, folded;
    sets whose vectors differ by more differ too much in size.
    """
    groups = np.array([len(v) for v in vectors])
    for d in np.unique(groups):
        own = np.flatnonzero((groups == d) | (groups == 2 * d))
        matrix = np.stack([vectors[i] if groups[i] == d else vectors[i].reshape(d, 2).sum(1) for i in own])
        tree = CountTree(matrix, n[own])
        for at, i in enumerate(own):
            if groups[i] == d:
                found = own[tree.search(matrix[at], int(n[i]), percent)]
                yield int(i), found[found > i]


class _Labels:
    """Components of a tile's places, each named by its least place. Places of one label are connected from the start."""

    def __init__(self, labels: list[int]) -> None:
        self.of = np.unique(np.array(labels, np.int64), return_index=True, return_inverse=True)
        self.of = self.of[1][self.of[2].ravel()] if labels else np.zeros(0, np.int64)

    def join(self, places: np.ndarray, i: int) -> None:
        own = np.append(self.of[places], self.of[i])
        self.of[np.isin(self.of, own)] = own.min()

    def stars(self, ids: list[int]) -> list[tuple[int, int]]:
        """(least id of the component, other id)."""
        least: dict[int, int] = {}
        for label, i in zip(self.of.tolist(), ids, strict=True):
            least[label] = min(i, least.get(label, i))
        return [(least[label], i) for label, i in zip(self.of.tolist(), ids, strict=True) if least[label] != i]


class _Leaf(NamedTuple):
    """The documents of a leaf, or of several one after the other, as arrays."""

    ids: np.ndarray
    n: np.ndarray
    labels: np.ndarray
    points: list[np.ndarray]

    def __add__(self, other: _Leaf) -> _Leaf:
        return _Leaf(*(np.concatenate([x, y]) for x, y in zip(self[:3], other[:3], strict=True)), self.points + other.points)


def _leaves(column: pa.Array) -> Iterator[_Leaf | None]:
    """The leaves of a list column of (doc_id, n, point, label); a null list is None. Points are views of the column's bytes."""
    flat = column.flatten()
    ids, n, labels = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3))
    points = flat.field(2)
    _, at, data = points.buffers()
    at = np.frombuffer(at, np.int32)[points.offset : points.offset + len(points) + 1] if len(points) else np.zeros(1, np.int32)
    data = memoryview(data) if data is not None else memoryview(b"")
    a = 0
    for size in pc.list_value_length(column).to_pylist():
        if size is None:
            yield None
        else:
            yield _Leaf(ids[a : a + size], n[a : a + size], labels[a : a + size], [unpack_counts(data[at[k] : at[k + 1]]) for k in range(a, a + size)])
            a += size


def _open(left: _Leaf, right: _Leaf | None, percent: int) -> list[tuple[int, int]]:
    """Candidate links in one leaf, or between two, of documents of different labels.

    One leaf gives a star for each of its components, two leaves give a link for each pair of
    their components that it takes to join them.
    """
    both = left + right if right else left
    order = np.argsort(both.n, kind="stable")
    side, n = (np.arange(len(both.n)) < len(left.n))[order], both.n[order]
    ids = both.ids[order].tolist()
    labels, across = _Labels(both.labels[order].tolist()), []
    for i, found in near_places([both.points[i] for i in order], n, percent):
        own = found[(side[found] == side[i]) & (labels.of[found] != labels.of[i])]
        if len(own):
            labels.join(own, i)
        if right:
            across.append((i, found[side[found] != side[i]]))
    if not right:
        return labels.stars(ids)
    links = []
    for i, found in across:
        while len(found := found[labels.of[found] != labels.of[i]]):
            links.append((ids[i], ids[found[0]]))
            labels.join(found[:1], i)
    return links


def _trees(reps: DataFrame, scratch: Scratch) -> DataFrame:
    """(t, doc_id, n, c, band): the documents of each tree, a shingle that c > 1 prefixes hold."""
    entries = reps.select(F.explode("prefix").alias("t"), "doc_id", "n")
    shared = entries.groupBy("t").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "doc_id")).alias("y"))
    # Shingles with the same documents would make the same tree; one of them is kept.
    trees = scratch.save(shared.where("c > 1").groupBy("c", "x", "y").agg(F.min("t").alias("t")).select("t", "c"), "trees")
    return may_match(entries, trees, "t").join(trees, "t")


def centre_links(docs: DataFrame, large: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): true links of documents in large trees (t, band, doc_id) to a centre, one for each document.

    The centre is the least id of a tree's size band, for a document in several trees the one it
    meets most often. Documents of a centre are dealt to parts, each with the centre's text.
    """
    least = large.groupBy("t", "band").agg(F.min("doc_id").alias("centre"))
    met = large.join(least, ["t", "band"]).where("doc_id <> centre").groupBy("doc_id", "centre").count()
    pairs = scratch.save(met.groupBy("doc_id").agg(F.max_by("centre", F.struct("count", -F.col("centre"))).alias("centre")), "centred")
    parts = pairs.groupBy("centre").agg(F.ceil(F.count("*") / F.lit(float(TILE_DOCS))).cast("int").alias("parts"))
    dealt = pairs.join(parts, "centre").select("centre", F.pmod(F.xxhash64("doc_id"), F.col("parts").cast("long")).cast("int").alias("part"), "doc_id")
    copies = parts.select("centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("centre").alias("doc_id"))
    dealt = dealt.unionByName(copies)
    rows = may_match(docs, dealt, "doc_id").join(dealt, "doc_id").select("centre", "part", (F.col("doc_id") != F.col("centre")).alias("other"), "doc_id", "text")
    rows = rows.repartition("centre", "part").sortWithinPartitions("centre", "part", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = np.zeros(0, np.uint64)
        for batch in batches:
            links = []
            ids = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            for (a, other, b), own in zip(ids, shingle_sets(batch.column(4), k), strict=True):
                if not other:
                    centre = own
                elif similar(centre, own, percent):
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])
        release_memory()

    return scratch.save(rows.mapInArrow(run, "a long, b long"), "centre-links")


def candidates(trees: DataFrame, reps: DataFrame, labels: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): links that connect all pairs of different labels which the trees can't refute.

    trees: (t, doc_id, n, c, band); labels: (doc_id, label) of those known to be connected.
    """
    members = trees.join(reps.select("doc_id", "point"), "doc_id").join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    members = scratch.save(members.select("t", "c", "doc_id", "n", "point", "band", "label"), "members")
    large = F.col("c") > LEAF
    entry = F.collect_list(F.struct("doc_id", "n", "point", "label"))
    # Trees whose documents are all connected have nothing to find.
    mixed = lambda rows: (F.min(rows).alias("_l"), F.max(rows).alias("_m"))
    small = members.where(~large).groupBy("t").agg(entry.alias("left"), *mixed("label")).where("_l <> _m")
    small = small.select("left", F.lit(None).cast(small.schema["left"].dataType).alias("right"))

    # In a band of a large tree the documents of the most common label are the core. They have
    # leaves of their own, before those of the others.
    sizes = members.where(large).groupBy("t", "band", "label").count()
    sizes = sizes.join(sizes.groupBy("t").agg(*mixed("label")).where("_l <> _m").select("t"), "t", "left_semi")
    cores = sizes.groupBy("t", "band").agg(F.max_by("label", F.struct("count", "label")).alias("core"), F.max("count").alias("n_core"), F.sum("count").alias("n_all"))
    leaves_of = lambda n: F.ceil(n / F.lit(float(LEAF))).cast("int")
    bands = cores.select("t", "band", "core", leaves_of(F.col("n_core")).alias("core_leaves"), leaves_of(F.col("n_all") - F.col("n_core")).alias("other_leaves"))
    bands = scratch.save(bands, "bands")
    dealt = members.where(large).join(bands, ["t", "band"])
    is_core = F.col("label") == F.col("core")
    hashed = F.xxhash64("doc_id")
    leaf = F.when(is_core, F.pmod(hashed, F.col("core_leaves").cast("long"))).otherwise(F.col("core_leaves") + F.pmod(hashed, F.greatest(F.col("other_leaves"), F.lit(1)).cast("long")))
    leaves = scratch.save(dealt.withColumn("leaf", leaf.cast("int")).groupBy("t", "band", "leaf").agg(entry.alias("rows")), "leaves")

    # Leaf pairs: others with themselves, with later others and with the core of their band, and
    # with the next band's leaves; cores meet only where their labels differ.
    nxt = bands.select("t", (F.col("band") - 1).alias("band"), F.col("core").alias("core2"), F.col("core_leaves").alias("core2_leaves"), (F.col("core_leaves") + F.col("other_leaves")).alias("all2"))
    own = leaves.select("t", "band", "leaf").join(bands, ["t", "band"]).join(nxt, ["t", "band"], "left")
    in_core = F.col("leaf") < F.col("core_leaves")
    end = F.col("core_leaves") + F.col("other_leaves")
    upto = lambda a, b: F.filter(F.sequence(a, F.greatest(a, b)), lambda j: j < b)
    same = upto(F.when(in_core, F.col("core_leaves")).otherwise(F.col("leaf") + 1), end)
    ahead = upto(F.when(in_core & (F.col("core") == F.col("core2")), F.col("core2_leaves")).otherwise(0), F.coalesce("all2", F.lit(0)))
    partner = F.concat(
        F.when(in_core, F.array().cast("array<struct<band2:int,leaf2:int>>")).otherwise(F.array(F.struct(F.col("band").alias("band2"), F.lit(-1).alias("leaf2")))),
        F.transform(same, lambda j: F.struct(F.col("band").alias("band2"), j.alias("leaf2"))),
        F.transform(ahead, lambda j: F.struct((F.col("band") + 1).alias("band2"), j.alias("leaf2"))),
    )
    pairs = own.select("t", "band", "leaf", F.explode(partner).alias("p")).select("t", "band", "leaf", "p.band2", "p.leaf2")
    other = leaves.select("t", F.col("band").alias("band2"), F.col("leaf").alias("leaf2"), F.col("rows").alias("right"))
    opened = pairs.join(leaves.withColumnRenamed("rows", "left"), ["t", "band", "leaf"]).join(other, ["t", "band2", "leaf2"], "left").select("left", "right")

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin in range(0, len(batch), 64):
            part = batch.slice(begin, 64)
            links = [link for left, right in zip(_leaves(part.column(0)), _leaves(part.column(1)), strict=True) for link in _open(left, right, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])

    found = arrow_map(small, each, "a long, b long").unionByName(arrow_map(opened, each, "a long, b long"))
    found = scratch.save(found, "candidates")
    scratch.drop("members", "leaves")
    return found


# Verification -----------------------------------------------------------------------------------


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets link."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = _overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def verify(rows: list[tuple[int, int, int, np.ndarray]], cross: bool, percent: int) -> list[tuple[int, int]]:
    """Stars of the true links among (doc_id, side, label, set); with cross only links between the sides.

    Places that are connected already, as those of one label, are not compared again.
    """
    rows = sorted(rows, key=lambda r: (len(r[3]), r[0]))
    n = np.array([len(r[3]) for r in rows], np.int64)
    side = np.array([r[1] for r in rows])
    sets = [r[3] for r in rows]
    labels = _Labels([r[2] for r in rows])
    for i, found in near_places([count_vector(s) for s in sets], n, percent):
        found = found[side[found] != side[i]] if cross else found
        for j in found.tolist():
            if labels.of[j] != labels.of[i] and similar(sets[i], sets[j], percent):
                labels.join(np.array([j]), i)
    return labels.stars([r[0] for r in rows])


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def linked(docs: DataFrame, reps: DataFrame, found: DataFrame, labels: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """(node, component) by the true links, verified on the whole texts of each cluster of candidates.

    labels: (doc_id, label) of documents that are connected already; clusters of one label need
    no texts. A cluster of up to TILE_DOCS documents and TILE_SHINGLES shingles is verified by
    one task, which gives its components. A larger one is dealt to parts, the core (documents of
    the most common label) to parts of its own; pairs of parts are tiles, but for pairs of core
    parts. Texts are sent, not sets of hashes: a set takes more bytes than its text.
    """
    known = labels.select(F.col("label").alias("a"), F.col("doc_id").alias("b"))
    of = connected_components(found.unionByName(known), scratch, "clusters")
    of = scratch.save(of.unionByName(of.select(F.col("component").alias("node"), "component").distinct()), "cluster-of")
    labelled = of.join(labels.withColumnRenamed("doc_id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = scratch.save(labelled.join(reps.select(F.col("doc_id").alias("node"), "n"), "node"), "labelled")
    by_label = labelled.groupBy("component", "label").agg(F.count("*").alias("docs"), F.sum("n").alias("n"))
    parts_of = lambda docs, n: F.greatest(F.ceil(docs / F.lit(float(TILE_DOCS))), F.ceil(n / F.lit(float(TILE_SHINGLES)))).cast("int")
    sizes = by_label.groupBy("component").agg(F.max_by(F.struct("label", "docs", "n"), F.struct("docs", "label")).alias("core"), F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.count("*").alias("labels"))
    sizes = sizes.select(
        "component",
        (F.col("labels") == 1).alias("one"),
        (parts_of(F.col("docs"), F.col("n")) == 1).alias("whole"),
        F.col("core.label").alias("core"),
        parts_of(F.col("core.docs"), F.col("core.n")).alias("core_parts"),
        parts_of(F.col("docs") - F.col("core.docs"), F.col("n") - F.col("core.n")).alias("other_parts"),
    )
    sized = scratch.save(labelled.join(sizes, "component"), "sized")
    open_ = sized.where("not one")
    is_core, hashed = F.col("label") == F.col("core"), F.xxhash64("node")
    part = F.when(F.col("whole"), 0).when(is_core, F.pmod(hashed, F.col("core_parts").cast("long"))).otherwise(F.col("core_parts") + F.pmod(hashed, F.greatest(F.col("other_parts"), F.lit(1)).cast("long")))
    dealt = open_.withColumn("part", part.cast("int"))
    others = F.sequence(F.col("core_parts"), F.col("core_parts") + F.col("other_parts") - 1)
    everyone = F.sequence(F.lit(0), F.col("core_parts") + F.col("other_parts") - 1)
    tile = F.when(F.col("whole"), F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high")))).otherwise(
        F.transform(F.when(F.col("part") < F.col("core_parts"), others).otherwise(everyone), lambda j: F.struct(F.least(j, "part").alias("low"), F.greatest(j, "part").alias("high")))
    )
    dealt = dealt.select(F.col("node").alias("doc_id"), "component", "part", "whole", "label", F.explode(tile).alias("tile")).select("doc_id", "component", "part", "whole", "label", "tile.low", "tile.high")
    rows = may_match(docs, dealt, "doc_id").join(dealt, "doc_id").select("component", "low", "high", "whole", "part", "doc_id", "label", "text")
    rows = rows.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tile = None, []

        def close() -> pa.RecordBatch:
            stars = verify(tile, key[1] != key[2], percent) if len(tile) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in stars], pa.int64()), pa.array([b for _, b in stars], pa.int64()), pa.array([key[3]] * len(stars), pa.bool_())], ["a", "b", "whole"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)
            parts, ids, labels = (batch.column(c).to_pylist() for c in (4, 5, 6))
            for own, part, doc_id, label, shingles in zip(keys, parts, ids, labels, shingle_sets(batch.column(7), k), strict=True):
                if own != key:
                    if key is not None:
                        yield close()
                    key, tile = own, []
                tile.append((doc_id, part, label, shingles))
        if key is not None:
            yield close()
        release_memory()

    stars = scratch.save(rows.mapInArrow(run, "a long, b long, whole boolean"), "links")
    done = stars.where("whole").select(F.col("b").alias("node"), F.col("a").alias("component")).distinct()
    sure = sized.where("one").select("node", F.col("label").alias("component")).where("node <> component")
    parted = stars.where("not whole").select("a", "b").unionByName(sized.where("not one and not whole").select(F.col("label").alias("a"), F.col("node").alias("b")))
    return done.unionByName(sure).unionByName(connected_components(parted, scratch, "parted"))


# The join ---------------------------------------------------------------------------------------


def _joined(docs: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """`similar_components` of docs (doc_id, text) in which no id has two texts."""
    last = frequent_shingles(docs, k, percent, scratch)
    table = scratch.save(points(docs, k, percent, last), "points")
    same = ["n", "sig1", "sig2"]
    sets = scratch.save(table.select("doc_id", *same), "sets")
    classes = scratch.save(sets.where("n > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("rows")), "classes")
    # A set that occurs once is its class; only the rows of others are shuffled to find the first.
    twice = scratch.save(marks_of(sets.join(classes.where("rows > 1"), same, "left_semi").select("doc_id")), "twice")
    some, alone = split_by_marks(table.where("n > 0 and doc_id is not null").select("doc_id", "n", "prefix", "point"), twice)
    some = some.join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    reps = scratch.save(alone.unionByName(some), "reps")
    scratch.drop("points", "twice")
    # A size band spans the sizes that sets of this similarity may differ by.
    band = F.when(F.col("c") > LEAF, F.floor(F.log("n") / F.lit(np.log(100 / percent)))).otherwise(0).cast("int")
    trees = scratch.save(_trees(reps, scratch).withColumn("band", band), "placed")
    stars = centre_links(docs, trees.where(F.col("c") > LEAF), k, percent, scratch)
    labels = scratch.save(connected_components(stars, scratch, "centres").toDF("doc_id", "label"), "centre-labels")
    found = candidates(trees, reps, labels, percent, scratch)
    joined = linked(docs, reps, found, labels, k, percent, scratch)
    classes = classes.join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
    classes = scratch.save(classes.select(*same, "class_id", F.coalesce("component", "class_id").alias("component_id")), "labels")
    scratch.drop("reps", "classes", "trees", "candidates", "placed", "centred", "centre-links", "bands", "cluster-of", "labelled", "sized", "links")
    return sets.join(classes, same, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNull(), None).when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )



def other_texts(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, h1, h2, node): the texts of repeated ids besides the first, each with a negative number that is no document's id."""
    own = keyed(docs).where("doc_id is not null").select("doc_id", "h1", "h2").distinct()
    first = own.groupBy("doc_id").agg(F.min(F.struct("h1", "h2")).alias("first"), F.count("*").alias("texts")).where("texts > 1").select("doc_id", "first")
    more = scratch.save(own.join(first, "doc_id").where(F.struct("h1", "h2") != F.col("first")).select("doc_id", "h1", "h2"), "other-texts")
    if more.isEmpty():
        return more.withColumn("node", F.lit(None).cast("long"))
    salt = 0
    while True:
        numbers = more.withColumn("node", -1 - F.shiftrightunsigned(F.xxhash64(F.lit(salt), "doc_id", "h1", "h2"), 1))
        numbers = scratch.save(numbers, f"numbers-{salt}")
        taken = numbers.join(docs.select(F.col("doc_id").alias("node")), "node", "left_semi")
        if taken.isEmpty() and numbers.groupBy("node").count().where("count > 1").isEmpty():
            return numbers
        salt += 1


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit("second"), text)})


def similar_components(docs: DataFrame, k: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id), one row for each row of docs.

    Two texts link when 100 * |intersection| >= percent * |union| of their sets of k-word
    shingles (words `[^\\x20\\x09-\\x0D]+`, A-Z folded; fewer than k words are one shingle).
    percent is 50 or more. class_id is the smallest doc_id with the same set, component_id the smallest reachable by
    links, itself included. Null texts and texts without words have empty sets and link with
    nothing. Rows that share an id are one document: each has its own set and class, and all that
    any of them links with is one component. Repeated rows give repeated results.
    A null doc_id is taken as no document: its row has component_id null. Texts of any length
    are compared whole; of equal sets, or links of equal overlap, none is preferred: the least
    id names the class and the component. Other columns are ignored. An empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    more = other_texts(docs, scratch)
    if more.isEmpty():
        return _joined(docs, k, percent, scratch)
    # Other texts of an id are documents of their own numbers, and join the id's component afterwards.
    apart = keyed(docs).join(more, ["doc_id", "h1", "h2"], "left").select(F.coalesce("node", "doc_id").alias("doc_id"), "text")
    found = scratch.save(_joined(apart, k, percent, scratch), "of-texts")
    of = found.select("doc_id", "component_id").where("doc_id is not null").distinct()
    pairs = more.join(of, "doc_id").select("node", F.col("component_id").alias("a")).join(of.toDF("node", "b"), "node").select("a", "b")
    merged = connected_components(scratch.save(pairs.where("a <> b").distinct(), "of-ids"), scratch, "ids").toDF("component_id", "whole")
    named = found.join(merged, "component_id", "left").join(more.select(F.col("node").alias("doc_id"), F.col("doc_id").alias("own")), "doc_id", "left")
    named = scratch.save(named.select(F.coalesce("own", "doc_id").alias("doc_id"), "n_shingles", "class_id", F.coalesce("whole", "component_id").alias("component_id")), "named")
    # A class or component that holds such a number may be called by it: its least id takes its place.
    least = lambda c: named.where(F.col(c) < 0).groupBy(c).agg(F.min("doc_id").alias(f"_{c}"))
    out = named.join(least("class_id"), "class_id", "left").join(least("component_id"), "component_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("_class_id", "class_id").alias("class_id"), F.coalesce("_component_id", "component_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """docs with one document of each component, the one with the smallest id; all columns stay.

    All rows of that id stay, also where their texts differ; rows without an id and texts without words stay.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    found = similar_components(docs, k, percent, scratch)
    gone = scratch.save(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    ids = scratch.save(marks_of(gone), "gone-marks")
    # Only texts that may go are shuffled.
    some, stay = split_by_marks(docs.withColumn(key := "doc_id" + "_" * max(map(len, docs.columns)), F.col("doc_id").cast("long")), ids, key)
    return some.join(gone, some[key] == gone["doc_id"], "left_anti").unionByName(stay).select(docs.columns)


def op2_count_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(documents(spark, sf_dir), 3, 90)


QUERIES, ORACLE = {"op2_count_tree_join": op2_count_tree_join}, {}
