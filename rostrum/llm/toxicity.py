"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text (letters only, A-Z folded) and their beginnings of 3 to 6 bytes,
hashed to 64 bits. Counts of terms by label are aggregated over the training rows, a bounded
sample of the labelled ones; every term whose association with a label is beyond chance is an
input of the machine. Every text is scored. Its score is
sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j): pairs such as an insult and whom it
is said of are learned as pairs, which additive weights miss.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, documents, fold_table, mix, release_memory, separators, signed, text_slices, word_hashes

#: The machine's rank, and about how many labelled rows it is fitted on (a hash of the id chooses
#: them): a documented bound, the same at every input size, which bounds the terms too.
RANK, FIT_ROWS = 4, 20_000
#: Terms whose log odds differ from nothing by fewer standard errors are no inputs: chance alone brings those.
MIN_STRENGTH = 3.0
BEGINNINGS = (3, 4, 5, 6)
THRESHOLD = 0.3
_APART = separators("".join(map(chr, range(33, 128))).translate({ord(c): None for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"}))
_APART[:32] = True
_FOLD = fold_table()


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term hash, text number) of all words and beginnings of words, with repeats."""
    hashes, at, starts, ends = word_hashes(data, offsets, _APART, _FOLD)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    found, owner = [hashes], [text]
    length = ends - starts
    for k in BEGINNINGS:
        own = np.flatnonzero(length > k)
        if len(own):
            value = np.zeros(len(own), np.uint64)
            for j in range(k):
                value = mix(value * np.uint64(0x100000001B3) ^ _FOLD[data[starts[own] + j]])
            found.append(value ^ np.uint64(k))
            owner.append(text[own])
    return np.concatenate(found), np.concatenate(owner)


def distinct_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """terms_of without repeats in a text, ordered by text."""
    hashes, owner = terms_of(data, offsets)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


class Machine(NamedTuple):
    """terms are sorted; arrays are in their order."""

    terms: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for begin, end, data, offsets in text_slices(texts):
            term, owner = known_terms(self.terms, data, offsets)
            out.append(_sigmoid(_raw(self, term, owner, end - begin)))
        return np.concatenate(out)


def known_terms(terms: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in terms, text number) of the distinct known terms of each text."""
    hashes, owner = terms_of(data, offsets)
    if not len(terms) or not len(hashes):
        return np.zeros(0, int), np.zeros(0, int)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = terms[at] == hashes
    pairs = np.unique(owner[hit].astype(np.int64) * len(terms) + at[hit])
    return pairs % len(terms), pairs // len(terms)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _raw(m: Machine, term: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    z = m.w0 + np.bincount(owner, m.w[term], n)
    for f in range(m.v.shape[1]):
        own = m.v[term, f]
        z += 0.5 * (np.bincount(owner, own, n) ** 2 - np.bincount(owner, own**2, n))
    return z


def fit_machine(terms: np.ndarray, term: np.ndarray, owner: np.ndarray, label: np.ndarray, rank: int = RANK, epochs: int = 60, rate: float = 0.05, decay: float = 1e-5, seed: int = 1) -> Machine:
    """Full-batch Adam on the logistic loss. term and owner are the sparse rows, ordered by owner."""
    n, k = len(label), len(terms)
    rng = np.random.default_rng(seed)
    base = np.clip(label.mean() if n else 0.0, 1e-3, 1 - 1e-3)
    params = [np.array([np.log(base / (1 - base))]), np.zeros(k), rng.normal(0, 0.01, (k, rank))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, epochs + 1 if n else 1):
        m = Machine(terms, float(params[0][0]), params[1], params[2])
        error = (_sigmoid(_raw(m, term, owner, n)) - label) / n
        each = error[owner]
        grad_v = np.empty_like(params[2])
        for f in range(rank):
            own = params[2][term, f]
            total = np.bincount(owner, own, n)
            grad_v[:, f] = np.bincount(term, each * (total[owner] - own), k)
        grads = [np.array([error.sum()]), np.bincount(term, each, k) + decay * params[1], grad_v + decay * params[2]]
        for p, g, a, b in zip(params, grads, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-10)
    return Machine(terms, float(params[0][0]), params[1], params[2])


def labelled(docs: DataFrame, labels: DataFrame, wanted: Column, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of about fit_rows rows with a label for which `wanted` holds, or of all if there are fewer.

    A hash of the id chooses them among the labels, so what is broadcast has a bound that does
    not grow with the input and no other texts are shuffled. Equal rows of an id count once; where
    ids have so many texts that twice fit_rows would be passed, a hash of id and text thins them.
    """
    known = labels.where(F.col("toxic").isNotNull()).where(wanted).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = fit_rows / max(1, known.count())
    chance = F.shiftrightunsigned(F.xxhash64(F.lit("fit"), "doc_id"), 11) / F.lit(float(1 << 53))
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("_row")).join(F.broadcast(known.where(chance < share)), "doc_id")
    found = rows.select("_row").distinct().count()
    if found > 2 * fit_rows:
        rows = rows.where(F.shiftrightunsigned(F.xxhash64(F.lit("thin"), "_row"), 11) / F.lit(float(1 << 53)) < fit_rows / found)
    return rows.dropDuplicates(["_row"]).drop("_row")


def train(docs: DataFrame, labels: DataFrame, wanted: Column, fit_rows: int = FIT_ROWS, scratch: Scratch | None = None) -> Machine:
    """Counts terms by label, picks the inputs and fits the machine, all on the same labelled rows.

    Term counts are summed in each task before they are shuffled; what the driver gets is the
    hashes of the terms beyond chance and which of them about fit_rows rows have. Labels with a
    null id or a null toxic are left out; of several labels of an id the largest holds, and each
    different row of docs with that id is learned from, up to the bound of `labelled`.
    Without labels or documents the machine has no terms and scores every text alike. Other
    columns of docs and labels are ignored.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for begin, _, data, offsets in text_slices(batch.column(0), 1 << 20):
                hashes, owner = distinct_terms(data, offsets)
                toxic = label[begin:][owner].astype(np.int64)
                found, inverse = np.unique(hashes, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(np.bincount(inverse, 1 - toxic, len(found)).astype(np.int64)), pa.array(np.bincount(inverse, toxic, len(found)).astype(np.int64))], ["term", "clean", "toxic"])
        release_memory()

    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.save(labelled(docs, labels, wanted, fit_rows), "fitted")
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    counts = rows.select("text", "toxic").mapInArrow(count, "term long, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # The log odds of a term's toxic documents against the overall share, in standard errors.
    odds = F.log(((F.col("toxic") + 0.5) * (n0 + 1.0)) / ((F.col("clean") + 0.5) * (n1 + 1.0)))
    strength = F.abs(odds) / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    top = counts.where("toxic + clean >= 2").where(strength >= MIN_STRENGTH).select("term").collect()
    terms = np.sort(np.array([r.term for r in top], np.int64).view(np.uint64))

    def known(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists: list[np.ndarray] = []
        for begin, end, data, offsets in text_slices(batch.column(1)):
            term, owner = known_terms(terms, data, offsets)
            lists += np.split(term.astype(np.int32), np.searchsorted(owner, np.arange(1, end - begin)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(2), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "key", "toxic", "terms"])

    got = arrow_map(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic", F.xxhash64("text").alias("key")), known, "doc_id long, key long, toxic int, terms array<int>").toPandas()
    scratch.drop("fitted")
    got = got.sort_values(["doc_id", "key"], kind="stable")
    term = np.concatenate([np.zeros(0, np.int64), *(np.asarray(t, np.int64) for t in got["terms"])])
    owner = np.repeat(np.arange(len(got)), [len(t) for t in got["terms"]]) if len(got) else np.zeros(0, np.int64)
    return fit_machine(terms, term, owner, got["toxic"].to_numpy(np.float64))


def score_toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score) of every whole text, one row for each row of docs.

    A null or empty text has the score of no terms. The score depends on the text alone, so
    repeated rows and rows without an id are scored like all others; long texts are scored
    whole. Other columns are ignored, an empty table gives no rows.
    """

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(machine.scores(batch.column(1)), pa.float64())], ["doc_id", "score"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), each, "doc_id long, score double")


def drop_toxic(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose text scores below the threshold, with all their columns.

    Null and empty texts, repeated rows and null ids are treated as by `score_toxicity`.
    """
    where = docs.columns.index("text")

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(machine.scores(batch.column(where)) < threshold))

    return arrow_map(docs, each, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id has no label to hold out: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out(F.col("doc_id")))
    return score_toxicity(docs, machine).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES, ORACLE = {"op6_toxicity_fm": op6_toxicity_fm}, {}
