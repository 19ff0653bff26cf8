"""Hard negatives by exact inner products behind a PCA rotation.

Vectors of whole numbers are turned by an orthogonal matrix whose first directions hold most of
their length. The product of two vectors is then the product of their leading components plus a
rest of at most the product of their residual norms (Cauchy and Schwarz) and some slack for
rounding. Leading products are accumulated component group by component group, pairs whose bound
misses what is wanted are discarded after each, and what survives is verified with products of
whole numbers. So the rotation saves work and never changes a result.

Anchors go in blocks of bounded size, each sent to all tasks; rows are scanned where they lie
and never shuffled. A task returns the best few candidates of each anchor, which are merged by
anchor. Two scans a block: the anchors' positives, then the negatives in the windows that the
positives' scores open.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, finite_vector, mix, signed, usual_length

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: A negative's score lies between these shares of its positive's, in hundredths.
WINDOW = (50, 95)
#: Anchors sent to the tasks at a time, and about how many rows (a hash chooses them) the rotation is fitted on.
BLOCK, FIT_ROWS = 16_384, 65_536
#: Pairs are bounded in tiles of so many anchors and rows.
TILE_ANCHORS, TILE_ROWS = 1_024, 2_048
#: Below this share of pairs left, pairs are followed one by one.
SPARSE = 0.1
#: The place of rows without an id: after all others.
NO_ID = (1 << 63) - 1
LEAST = -(1 << 63)


def whole_vectors(column: pa.Array, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of vectors of one length without nulls, a row each."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values.reshape(len(column), -1) * scale).astype(np.int64)


def largest_entry(dimensions: int) -> int:
    """Entries up to which products of whole vectors fit a long."""
    return int((2.0**62 / max(1, dimensions)) ** 0.5)


def row_hash(label: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Tells rows of one id apart."""
    out = mix(label.astype(np.int64).view(np.uint64))
    for k in range(x.shape[1]):
        out = mix(out ^ np.ascontiguousarray(x[:, k]).view(np.uint64)) + np.uint64(k)
    return signed(out)


@dataclass(frozen=True)
class Rotation:
    """q: orthogonal, directions in columns by falling length; cuts: the components after which pairs are discarded."""

    q: np.ndarray
    cuts: tuple[int, ...]

    @classmethod
    def of(cls, gram: np.ndarray) -> Rotation:
        d = len(gram)
        return cls(np.linalg.eigh(gram)[1][:, ::-1], tuple(sorted({max(1, d * k // 8) for k in (1, 2, 4, 6)})))

    def turn(self, x: np.ndarray) -> Turned:
        r = x.astype(np.float64) @ self.q
        square = (r * r)[:, ::-1].cumsum(1)[:, ::-1]
        rest = np.sqrt(np.stack([square[:, c] if c < r.shape[1] else np.zeros(len(r)) for c in self.cuts]))
        return Turned(x, r.astype(np.float32), rest, np.sqrt(square[:, 0]))


@dataclass(frozen=True)
class Turned:
    """Whole vectors, the rotated ones, their residual norms after each cut and their norms."""

    x: np.ndarray
    r: np.ndarray
    rest: np.ndarray
    norm: np.ndarray

    def part(self, at: slice) -> Turned:
        return Turned(self.x[at], self.r[at], self.rest[:, at], self.norm[at])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of all rows of whole numbers."""
    if a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def pair_products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    out = [np.zeros(0, np.int64)]
    for at in range(0, len(i), step):
        out.append(np.einsum("ij,ij->i", a[i[at : at + step]], b[j[at : at + step]]))
    return np.concatenate(out)


def surviving_pairs(a: Turned, b: Turned, cuts: tuple[int, ...], wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, product) of the wanted pairs whose exact product is between low[i] and high[i]."""
    d = a.x.shape[1]
    slack = 8 * d * 2.0**-24
    floor, top = low.astype(np.float64), high.astype(np.float64)
    floor, top = floor - np.abs(floor) * 1e-15, top + np.abs(top) * 1e-15
    done, alive, i, j = 0, wanted, None, None
    partial = np.zeros(wanted.shape, np.float32)
    for s, cut in enumerate(cuts):
        if i is None:
            partial += a.r[:, done:cut] @ b.r[:, done:cut].T
            bound = np.outer(a.rest[s] * (1 + slack), b.rest[s]) + np.outer(slack * a.norm, b.norm)
            alive = alive & (partial + bound >= floor[:, None]) & (partial - bound <= top[:, None])
            if alive.mean() < SPARSE:
                i, j = np.nonzero(alive)
                value = partial[i, j].astype(np.float64)
        else:
            value = value + np.einsum("ij,ij->i", a.r[i, done:cut], b.r[j, done:cut])
            bound = a.rest[s][i] * (1 + slack) * b.rest[s][j] + slack * a.norm[i] * b.norm[j]
            left = (value + bound >= floor[i]) & (value - bound <= top[i])
            i, j, value = i[left], j[left], value[left]
        done = cut
    if i is None:
        i, j = np.nonzero(alive)
        exact = products(a.x, b.x)[i, j]
    else:
        exact = pair_products(a.x, b.x, i, j)
    left = (exact >= low[i]) & (exact <= high[i])
    return i[left], j[left], exact[left]


class Best:
    """The best k distinct rows (score, id, hash) of each group: higher scores first, then smaller ids, then hashes."""

    def __init__(self, groups: int, k: int, least: np.ndarray | None = None) -> None:
        self.k = k
        self.group, self.score, self.id, self.hash = (np.zeros(0, np.int64) for _ in range(4))
        self.floor = np.full(groups, LEAST, np.int64) if least is None else least.copy()

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray, hashed: np.ndarray) -> None:
        group, score = np.concatenate([self.group, group]), np.concatenate([self.score, score])
        ident, hashed = np.concatenate([self.id, ident]), np.concatenate([self.hash, hashed])
        order = np.lexsort((hashed, ident, -score, group))
        group, score, ident, hashed = group[order], score[order], ident[order], hashed[order]
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (score[1:] != score[:-1]) | (ident[1:] != ident[:-1]) | (hashed[1:] != hashed[:-1])
        group, score, ident, hashed = group[new], score[new], ident[new], hashed[new]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        kept = place < self.k
        self.group, self.score, self.id, self.hash = group[kept], score[kept], ident[kept], hashed[kept]
        full = place == self.k - 1
        self.floor[group[full]] = score[full]


@dataclass
class Anchors:
    """A block of anchors; windows: (anchor, positive's id, its score) in the order of anchors, once they are known."""

    ids: np.ndarray
    labels: np.ndarray
    hashes: np.ndarray
    turned: Turned
    windows: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None


def _batches(batches: Iterator[pa.RecordBatch], rotation: Rotation) -> Iterator[tuple[np.ndarray, np.ndarray, Turned]]:
    """(ids, labels, turned vectors) in tiles."""
    most = largest_entry(len(rotation.q))
    for batch in batches:
        for at in range(0, batch.num_rows, TILE_ROWS):
            part = batch.slice(at, TILE_ROWS)
            x = whole_vectors(part.column(2))
            fits = np.abs(x).max(1, initial=0) <= most
            ids = part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            yield ids[fits], part.column(1).to_numpy(zero_copy_only=False)[fits], rotation.turn(x[fits])


def _tiles(anchors: Anchors) -> Iterator[slice]:
    for at in range(0, len(anchors.ids), TILE_ANCHORS):
        yield slice(at, min(at + TILE_ANCHORS, len(anchors.ids)))


def scan_positives(rows: DataFrame, anchors, rotation: Rotation, k: int) -> DataFrame:  # noqa: ANN001
    """(anchor, score, id, hash): of each task the best k other rows of each anchor's label. anchors: a broadcast block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Anchors = anchors.value
        best = Best(len(own.ids), k)
        for ids, labels, b in _batches(batches, rotation):
            for at in _tiles(own):
                i, j, score = surviving_pairs(own.turned.part(at), b, rotation.cuts, own.labels[at, None] == labels, best.floor[at], np.full(at.stop - at.start, NO_ID))
                hashed = row_hash(labels[j], b.x[j])
                i = i + at.start
                other = (ids[j] != own.ids[i]) | (hashed != own.hashes[i])
                best.add(i[other], score[other], ids[j][other], hashed[other])
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (best.group, best.score, best.id, best.hash)], ["anchor", "score", "id", "hash"])

    return rows.mapInArrow(run, "anchor long, score long, id long, hash long")


def scan_negatives(rows: DataFrame, anchors, rotation: Rotation, k: int, window: tuple[int, int]) -> DataFrame:  # noqa: ANN001
    """(window, score, id, hash): of each task the best k rows of other labels in each window of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Anchors = anchors.value
        anchor, _, positive = own.windows
        low, high = -(-window[0] * positive // 100), window[1] * positive // 100
        begin = np.searchsorted(anchor, np.arange(len(own.ids) + 1))
        most, some = int(np.diff(begin).max(initial=0)), begin[1:] > begin[:-1]
        best = Best(len(anchor), k, low)
        top = np.full(len(own.ids), LEAST)
        np.maximum.at(top, anchor, high)
        for ids, labels, b in _batches(batches, rotation):
            for at in _tiles(own):
                floor = np.full(len(own.ids), NO_ID)
                np.minimum.at(floor, anchor, best.floor)
                wanted = (own.labels[at, None] != labels) & some[at, None]
                i, j, score = surviving_pairs(own.turned.part(at), b, rotation.cuts, wanted, floor[at], top[at])
                hashed, i = row_hash(labels[j], b.x[j]), i + at.start
                for place in range(most):
                    w = begin[i] + place
                    has = w < begin[i + 1]
                    has[has] = (score[has] >= best.floor[w[has]]) & (score[has] <= high[w[has]])
                    best.add(w[has], score[has], ids[j][has], hashed[has])
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (best.group, best.score, best.id, best.hash)], ["anchor", "score", "id", "hash"])

    return rows.mapInArrow(run, "anchor long, score long, id long, hash long")


def first_of_each(found: DataFrame, k: int) -> DataFrame:
    """found with rank: the first k distinct rows of each anchor over all tasks."""
    order = W.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "hash")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fit_rotation(rows: DataFrame, dimensions: int, n: int, fit_rows: int = FIT_ROWS) -> Rotation:
    """The rotation to the main directions of about fit_rows rows; products of entries are summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, most = np.zeros((dimensions, dimensions)), largest_entry(dimensions)
        for batch in batches:
            x = whole_vectors(batch.column(0))
            x = x[np.abs(x).max(1, initial=0) <= most].astype(np.float64)
            gram += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(gram.size, dtype=np.int32)), pa.array(gram.ravel())], ["place", "value"])

    chance = F.shiftrightunsigned(F.xxhash64(F.lit("fit"), "vec_id", "vector"), 11) / F.lit(float(1 << 53))
    sums = rows.where(chance < fit_rows / max(1, n)).select("vector").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    gram = np.zeros(dimensions * dimensions)
    for r in sums.collect():
        gram[r.place] = r.value
    return Rotation.of(gram.reshape(dimensions, dimensions))


def mine_negatives(table: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, block: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of a table (vec_id, label, embedding).

    An anchor's positives are its best rows of the same label, by inner product of the whole
    vectors, then by smaller id. For each of them come the best rows of other labels whose score
    is between the window's shares of the positive's. Exact, whatever the rotation.

    Rows without a label or with a null vector or a null, NaN or infinite entry take no part; nor
    do vectors of another length than the most frequent one, empty vectors, or vectors so large
    that their products would not fit a long. Rows equal in id, label and whole vector are one
    row; rows that share an id but differ are rows of their own, also as anchors (ties of id are
    broken by a hash). A row without an id comes after all others in ties and is an anchor only
    if `is_anchor` says so. Windows of negative positives are empty, as their lower end is the
    higher one. Without other rows of its label an anchor has no output; an empty table has none.
    Other columns are ignored.
    """
    spark = table.sparkSession
    scratch = scratch or Scratch(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    good = table.where(F.col("label").isNotNull() & finite_vector("embedding"))
    good = good.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    n, dimensions = usual_length(good, "vector")
    if not n:
        return spark.createDataFrame([], schema)
    rows = good.where(F.size("vector") == dimensions)
    rotation = fit_rotation(rows, dimensions, n)
    chosen = scratch.save(rows.where("is_anchor").select("vec_id", "label", "vector").distinct(), "anchors")
    blocks = max(1, -(-chosen.count() // block))
    rows, most = rows.select("vec_id", "label", "vector"), largest_entry(dimensions)
    out = "negatives"
    for k in range(blocks):
        own = chosen.where(F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)) == k).toArrow().combine_chunks()
        x = whole_vectors(own.column("vector").combine_chunks()) if own.num_rows else np.zeros((0, dimensions), np.int64)
        ids, labels = own.column("vec_id").fill_null(NO_ID).to_numpy(), own.column("label").to_numpy()
        hashes = row_hash(labels, x)
        fits = np.flatnonzero(np.abs(x).max(1, initial=0) <= most)
        fits = fits[np.sort(np.unique(np.stack([ids[fits], hashes[fits]]), axis=1, return_index=True)[1])]
        anchors = Anchors(ids[fits], labels[fits], hashes[fits], rotation.turn(x[fits]))
        sent = spark.sparkContext.broadcast(anchors)
        best = first_of_each(scan_positives(rows, sent, rotation, positives), positives).toPandas().sort_values(["anchor", "rank"])
        anchors.windows = tuple(best[c].to_numpy(np.int64) for c in ("anchor", "id", "score"))
        sent = spark.sparkContext.broadcast(anchors)
        found = first_of_each(scan_negatives(rows, sent, rotation, negatives, window), negatives)
        named = _named(found, sent)
        named.write.mode("append").parquet(f"{scratch.root}/{out}")
    return scratch.load(out, spark.createDataFrame([], schema))


def _named(found: DataFrame, anchors) -> DataFrame:  # noqa: ANN001
    """Ids and scores in place of a block's places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Anchors = anchors.value
        anchor, positive, score = own.windows
        for batch in batches:
            w = batch.column(0).to_numpy(zero_copy_only=False)
            named = lambda v: pa.array(v, mask=v == NO_ID)
            columns = [named(own.ids[anchor[w]]), named(positive[w]), batch.column(1), named(batch.column(2).to_numpy(zero_copy_only=False)), pa.array(score[w]), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return found.select("anchor", "rank", "id", "score").mapInArrow(run, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def op12_pca_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine_negatives(table.withColumn("label", moved), F.col("vec_id") % 50 == 0)


#: Pairs of all rows with all anchors, in SQL.
_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS other_id, b.label, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM (SELECT anchor_id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM s WHERE label = anchor_label) WHERE k <= 5),
r AS (SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.anchor_label AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3
"""
QUERIES, ORACLE = {"op12_pca_negatives": op12_pca_negatives}, {"op12_pca_negatives": _SQL}
