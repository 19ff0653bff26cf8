"""Mixing sources to target weights by balanced sampling (the cube method of Deville and Tillé).

A source's rate is target / size. Each of its documents is taken floor(rate) times and once
more with probability rate - floor(rate). The flight phase moves these fractional
probabilities along the null space of two constraints, the words and the number of documents,
until at most two documents of a block stay fractional. Blocks are fixed-size parts of a
source, so a large source is spread over many tasks; what stays fractional goes to the next
round, hundreds of times smaller, until one block a source is left. There the longest units fly
first, against all others, so that short ones are left; the landing decides the last two or so
by the word constraint alone, and the very last one as comes nearer to the target.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, documents, numbered, release_memory, word_count

_EPS = 1e-9


def source_targets(sized: DataFrame, weights: list[float] | Column | None = None, most: float = 3.0) -> DataFrame:
    """(source, source_size, source_docs, target) of rows (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... or by the given cycle. They
    share the size of all documents by weight, but none gets more than `most` times its own
    size; the excess is shared by the others' weights until none is above. All levels of
    sharing are found in one pass: sources are capped in the order of cap / weight.
    """
    cycle = weights or [1.0, 2.0, 3.0]
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    # One row a source from here on.
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weigh = sizes.withColumn("weight", F.get(F.lit([float(w) for w in cycle]), F.pmod(place, F.lit(len(cycle)))))
    everything = W.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    level = weigh.withColumn("cap", F.col("source_size") * F.lit(most)).withColumns(
        {
            "_left": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(order), F.lit(0.0)),
            "_weight": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)),
        }
    )
    # What is left a weight grows while sources are capped and falls after the first that is not: its top is the rate.
    rate = F.max(F.col("_left") / F.col("_weight")).over(everything)
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce(rate, F.lit(0.0)))
    return level.select("source", "source_size", "source_docs", F.when(F.col("source_size") == 0, 0.0).otherwise(target).alias("target"))


def flight(p: np.ndarray, balance: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, list[int]]:
    """Moves probabilities p so that balance @ p stays, until at most len(balance) are fractional.

    balance has a row for each constraint. Works on len(balance) + 1 units at a time, replacing
    those that reach 0 or 1. Returns p and the units that stayed fractional.
    """
    p = p.copy()
    queue = [int(i) for i in np.flatnonzero((p > _EPS) & (p < 1 - _EPS))]
    q, at = len(balance), 0
    window: list[int] = []
    while True:
        while len(window) <= q and at < len(queue):
            window.append(queue[at])
            at += 1
        if len(window) <= q:
            return p, window
        u = _null_vector(balance[:, window])
        now = p[window]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - now) / u, np.where(u < 0, -now / u, np.inf)).min()
            down = np.where(u > 0, now / u, np.where(u < 0, (now - 1) / u, np.inf)).min()
        step = up if rng.random() * (up + down) < down else -down
        moved = np.clip(now + step * u, 0, 1)
        moved[moved < _EPS] = 0
        moved[moved > 1 - _EPS] = 1
        p[window] = moved
        window = [i for i, x in zip(window, moved, strict=True) if 0 < x < 1]


def _null_vector(a: np.ndarray) -> np.ndarray:
    """A vector u with a @ u = 0, for one row more of unknowns than of constraints."""
    if a.shape == (2, 3):
        u = np.cross(a[0], a[1])
        if np.abs(u).max() <= 1e-12 * max(1.0, np.abs(a).max() ** 2):
            # The rows depend on each other: any vector orthogonal to one of them that is not zero.
            row = a[0] if np.abs(a[0]).max() >= np.abs(a[1]).max() else a[1]
            u = np.array([row[1], -row[0], 0.0]) if row[0] or row[1] else np.array([1.0, 0.0, 0.0])
        return u / np.abs(u).max()
    if a.shape == (1, 2):
        u = np.array([a[0, 1], -a[0, 0]])
        return u / np.abs(u).max() if u.any() else np.array([1.0, 0.0])
    u = np.linalg.svd(a)[2][-1]
    return u / np.abs(u).max()


def long_first(p: np.ndarray, balance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """As `flight`, the longest unit first: it moves alone, all shorter ones make up for it a little each.

    So long units reach 0 or 1 while there are many to balance them, and the last ones left
    are short. balance's first row is the size.
    """
    p = p.copy()
    open_ = [int(i) for i in np.argsort(-balance[0], kind="stable") if _EPS < p[i] < 1 - _EPS]
    while len(open_) > len(balance):
        first, rest = open_[0], np.array(open_[1:])
        others = balance[:, rest] / np.maximum(np.abs(balance[:, rest]).max(1, keepdims=True), 1e-300)
        scaled = balance[:, first] / np.maximum(np.abs(balance[:, rest]).max(1), 1e-300)
        u = np.concatenate([[1.0], -np.linalg.lstsq(others, scaled, rcond=None)[0]])
        if np.abs(others @ u[1:] + scaled).max() > 1e-9 * max(1.0, np.abs(scaled).max()):
            return flight(p, balance, rng)[0]
        at = np.array(open_)
        now = p[at]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 1e-15, (1 - now) / u, np.where(u < -1e-15, -now / u, np.inf)).min()
            down = np.where(u > 1e-15, now / u, np.where(u < -1e-15, (now - 1) / u, np.inf)).min()
        step = up if rng.random() * (up + down) < down else -down
        moved = np.clip(now + step * u, 0, 1)
        moved[moved < _EPS] = 0
        moved[moved > 1 - _EPS] = 1
        p[at] = moved
        left = [i for i, x in zip(open_, moved, strict=True) if 0 < x < 1]
        if len(left) == len(open_):
            return flight(p, balance, rng)[0]
        open_ = left
    return p


def land(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decides the units that the flight left: by words alone, then the last one as is nearer to the words wanted."""
    p, left = flight(p, size[None, :], rng)
    p[left] = p[left] >= 0.5
    return p


def _blocks(seed: int, last: bool):  # noqa: ANN202
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["draw", "doc_id", "size", "nth"], kind="stable", ignore_index=True)
        rng = np.random.default_rng([seed, int(key[0]) & 0xFFFFFFFF, int(key[1]) & 0xFFFFFFFF])
        size = rows["size"].to_numpy(np.float64)
        start, balance = rows["p"].to_numpy(np.float64), np.stack([size, np.ones(len(size))])
        rows["p"] = land(long_first(start, balance, rng), size, rng) if last else flight(start, balance, rng)[0]
        release_memory()
        return rows

    return run


def balanced_sample(rows: DataFrame, seed: int = 1, block: int = 1024, scratch: Scratch | None = None) -> list[DataFrame]:
    """rows (doc_id, size, nth, stratum long, p, ...) with p at 0 or 1, as disjoint tables.

    In each stratum the sums of p * size and of p are kept up to the landing of a few short units.
    A hash of doc_id, size and nth orders the rows, null ids too, so rows of equal size differ in
    their hashes only; rows equal in all three must be told apart by nth, or they share their
    draw and are decided in any order. Sizes of any length and 0 are units like all others, other
    columns pass through, an empty table gives one empty table.
    """
    spark = rows.sparkSession
    scratch = scratch or Scratch(spark)
    done, k = [], 0
    rows = rows.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "size", "nth"))
    now = scratch.save(rows, "cube-0")
    while True:
        fractional = now.where((F.col("p") > _EPS) & (F.col("p") < 1 - _EPS))
        done.append(now.where((F.col("p") <= _EPS) | (F.col("p") >= 1 - _EPS)))
        counts = fractional.groupBy("stratum").agg(F.ceil(F.count("*") / F.lit(float(block))).cast("int").alias("blocks"))
        most = counts.agg(F.max("blocks")).first()[0]
        if not most:
            return done
        k += 1
        dealt = fractional.join(counts, "stratum").withColumn("block", F.pmod(F.xxhash64(F.lit(k), "draw"), F.col("blocks").cast("long")))
        moved = dealt.groupBy("stratum", "block").applyInPandas(_blocks(seed + k, most == 1), dealt.schema).select(rows.columns)
        now = scratch.save(moved, f"cube-{k}")


def mix_sized(sized: DataFrame, weights: list[float] | None, most: float, seed: int, block: int, scratch: Scratch) -> DataFrame:
    """(doc_id, size, source, nth, source_size, target, copies) of distinct rows (doc_id, size, source, nth)."""
    sized = scratch.save(sized, "sized")
    targets = scratch.save(source_targets(sized, weights, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    by = sized.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
    by = by.select("doc_id", "size", "s.source", "nth", "source_size", "target", rate.alias("rate"))
    whole = F.floor(F.col("rate") + _EPS)
    rows = by.withColumns({"whole": whole, "p": F.greatest(F.lit(0.0), F.col("rate") - whole), "stratum": F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())}).drop("rate")
    out = reduce(DataFrame.unionByName, balanced_sample(rows, seed, block, scratch))
    return out.select("doc_id", "size", "source", "nth", "source_size", "target", (F.col("whole") + F.round("p").cast("long")).alias("copies"))


def mix_sources(docs: DataFrame, weights: list[float] | None = None, most: float = 3.0, seed: int = 1, block: int = 1024, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken), one row for each row of docs.

    size is the text's number of words, taken the words that the mix takes: copies * size. A
    text of any length is one document; those without words (null, empty) are taken as the
    others are and add nothing. A null source is a source of its own, the last. Each row is
    decided by itself, also with a null or repeated id: equal rows are numbered, so each has a
    draw of its own, and the result is the same however the rows are dealt. Other columns are
    ignored. An empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    sized = docs.select("doc_id", word_count(F.col("text")).alias("size"), F.col("source").cast("string").alias("source"))
    mixed = mix_sized(numbered(sized, scratch, "counted"), weights, most, seed, block, scratch)
    return mixed.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, weights: list[float] | None = None, most: float = 3.0, seed: int = 1, block: int = 1024, scratch: Scratch | None = None) -> DataFrame:
    """docs as the mix takes them: each row as many times as it has copies, with all its columns.

    Rows of one source that share an id are one document here, of their summed sizes, and taken
    together; rows without an id are one document for each different text. Else as `mix_sources`.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    unnamed = F.when(F.col("doc_id").isNull(), F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.lit(0).cast("long"))
    rows = docs.select("doc_id", word_count(F.col("text")).alias("size"), F.col("source").cast("string").alias("source"), unnamed.alias("nth"))
    units = rows.groupBy("doc_id", "source", "nth").agg(F.sum("size").alias("size"))
    mixed = mix_sized(units, weights, most, seed, block, scratch).select("doc_id", "source", "nth", "copies").where("copies > 0")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("d.source").eqNullSafe(F.col("m.source")) & (F.col("d._nth") == F.col("m.nth"))
    taken = docs.withColumn("_nth", unnamed).alias("d").join(mixed.alias("m"), same)
    taken = taken.select("d.*", F.explode(F.array_repeat(F.lit(0), F.col("m.copies").cast("int"))).alias("_copy"))
    return taken.select([F.col(f"`{c}`") for c in docs.columns])


def op1_mix_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES, ORACLE = {"op1_mix_cube": op1_mix_cube}, {}
