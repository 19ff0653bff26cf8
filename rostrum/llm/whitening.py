"""Whitening of embeddings by a covariance that Spark SQL sums in one aggregation.

For every pair of dimensions of the upper triangle an expression sum(c_i * c_j) over centred
integer columns is generated; all of them are one aggregation, which combines in each task and
shuffles one row a task. The driver gets the sums (a number for each pair, whatever the
rows), assembles the covariance exactly and has LAPACK decompose it. Whitened coordinates are
generated expressions again, so no step leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import finite_vector, usual_length

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Scaled entries beyond this are taken as this: doubles hold no more whole numbers.
LARGEST = 1 << 52
#: Sums an aggregation has at most; wider vectors take several over the same rows.
AT_ONCE = 4_096
#: Components whose variance is below this share of the largest have none: they can't be whitened.
NO_VARIANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """n vectors of whole numbers, their sums, least and largest entries a dimension, and the components in rows by falling variance."""

    n: int
    sums: tuple[int, ...]
    least: tuple[int, ...]
    most: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def middle(self) -> list[int]:
        return [s // self.n for s in self.sums]


def whole_numbers(vector: str, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """Entries c as floor(scale * c) + offset."""
    bound = lambda x: F.least(F.greatest(x, F.lit(float(-LARGEST))), F.lit(float(LARGEST)))
    return F.transform(vector, lambda c: F.floor(bound(c.cast("double") * F.lit(float(scale)))) + F.lit(offset).cast("long"))


def usable_vectors(table: DataFrame, vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """Rows (key, x array<long>) of the usable vectors, and their number of dimensions.

    Rows whose vector is null or holds a null, NaN or infinite entry are left out. Vectors of
    another length than the most frequent one (of two as frequent, the longer) have no
    covariance with the others and are left out too.
    """
    good = table.where(finite_vector(vector)).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    _, dimensions = usual_length(good, "vector")
    return good.where(F.size("vector") == dimensions).select("key", whole_numbers("vector").alias("x")), dimensions


def pair_sums(rows: DataFrame, columns: list[str], at_once: int = AT_ONCE) -> tuple[int, list, dict[tuple[int, int], int | float]]:
    """(number of rows, sum of each column, sum of the product of each pair i <= j).

    One aggregation for up to `at_once` pairs; its result is one row.
    """
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    count, sums, products = 0, [], {}
    for begin in range(0, len(pairs), at_once):
        own = pairs[begin : begin + at_once]
        more = ["count(1)", *(f"sum({c})" for c in columns)] if begin == 0 else []
        got = rows.selectExpr(*more, *(f"sum({columns[i]} * {columns[j]})" for i, j in own)).first()
        if more:
            count, sums = got[0], list(got[1 : len(more)])
        products |= dict(zip(own, got[len(more) :], strict=True))
    return count, sums, products


def assemble(n: int, sums: list, products: dict[tuple[int, int], int | float]) -> np.ndarray:
    """The covariance (divisor n) of columns from their sums and products; exact up to one rounding if they are integers."""
    out = np.zeros((len(sums), len(sums)))
    for (i, j), p in products.items():
        out[i, j] = out[j, i] = (n * p - sums[i] * sums[j]) / (n * n)
    return out


def decompose(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(variances by falling size, unit eigenvectors in rows); the largest entry of each is positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1].T
    largest = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)[:, None]


def _centred(rows: DataFrame, middle: list[int], kind: str = "long") -> DataFrame:
    return rows.selectExpr("key", *(f"cast(get(x, {i}) - {m}L as {kind}) AS c{i}" for i, m in enumerate(middle)))


def fit_whitening(rows: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of rows (key, x) with vectors of that many dimensions; None without any.

    Columns are centred by whole numbers next to their means, what is left of the means is
    taken off the sums. Sums are exact in longs where their bound, known from the least and
    largest entries, fits one, and doubles else. Components without variance are left out.
    """
    if not dimensions:
        return None
    of = range(dimensions)
    first = rows.selectExpr("count(1)", *(f"{f}(cast(get(x, {i}) as {kind}))" for f, kind in (("sum", "decimal(20,0)"), ("min", "long"), ("max", "long")) for i in of)).first()
    n, rest = first[0], [int(v) for v in first[1:]]
    sums, least, most = (tuple(rest[k * dimensions : (k + 1) * dimensions]) for k in range(3))
    middle = [s // n for s in sums]
    reach = max(max(high - m, m - low) for low, m, high in zip(least, middle, most, strict=True))
    kind = "long" if n * reach * reach < 1 << 63 else "double"
    _, left, products = pair_sums(_centred(rows, middle, kind), [f"c{i}" for i in of])
    covariance = assemble(n, left, products)
    values, vectors = decompose(covariance)
    kept = [k for k in range(min(components, dimensions)) if values[k] > NO_VARIANCE * max(values[0], 0)]
    return Whitening(n, sums, least, most, vectors[kept], values[kept], float(np.trace(covariance)))


def _deviation(w: Whitening) -> str:
    """SQL for the sum of (n * x - S)^2 over columns c, exact; null where it doesn't fit a long."""
    rest = [s - w.n * m for s, m in zip(w.sums, w.middle, strict=True)]
    bound = sum(max(abs(w.n * low - s), abs(w.n * high - s)) ** 2 for s, low, high in zip(w.sums, w.least, w.most, strict=True))
    if bound < 1 << 63:
        return " + ".join(f"({w.n}L * c{i} - {r}L) * ({w.n}L * c{i} - {r}L)" for i, r in enumerate(rest))
    out = "0L"
    for i, r in enumerate(rest):
        d = f"try_subtract(try_multiply({w.n}L, c{i}), {r}L)"
        out = f"try_add({out}, try_multiply({d}, {d}))"
    return out


def whiten(rows: DataFrame, w: Whitening) -> DataFrame:
    """(key, deviation long, whitened array<double>) of rows (key, x): the components' coordinates, each of variance 1."""
    rest = [(s - w.n * m) / w.n for s, m in zip(w.sums, w.middle, strict=True)]
    coordinate = lambda v, e: " + ".join(f"(c{i} - {rest[i]!r}D) * {float(a / np.sqrt(e))!r}D" for i, a in enumerate(v))
    whitened = ", ".join(coordinate(v, e) for v, e in zip(w.components, w.variances, strict=True))
    return _centred(rows, w.middle).selectExpr("key", f"{_deviation(w)} AS deviation", f"array({whitened}) AS whitened")


def identity_error(whitened: DataFrame, components: int) -> float:
    """The largest entry of the covariance of the whitened coordinates minus the identity."""
    columns = [f"w{k}" for k in range(components)]
    n, sums, products = pair_sums(whitened.selectExpr(*(f"get(whitened, {k}) AS w{k}" for k in range(components))), columns)
    return float(np.abs(assemble(n, sums, products) - np.eye(components)).max())


def whiten_embeddings(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each usable vector and component.

    All usable vectors are fitted on; which are, `usable_vectors` says. Repeated rows and rows
    with a null or repeated id count and are returned one by one. Entries beyond 2^42 count as
    that; deviation is null where it doesn't fit a long. Components without variance (fewer
    dimensions or vectors than components, vectors all alike) are left out, so one vector alone
    gives no rows; an empty table gives none. Of equal variances any components are taken, the
    same for all rows; a component's largest entry is positive. Other columns are ignored.
    """
    rows, dimensions = usable_vectors(table)
    w = fit_whitening(rows, dimensions, components)
    if w is None or not len(w.variances):
        return table.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    whitened = whiten(rows, w)
    error = identity_error(whitened, len(w.variances))
    explained = F.lit([float(e / w.trace) for e in w.variances])
    out = whitened.select(F.col("key").cast("long").alias("vec_id"), "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return out.select("vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))


def op11_whiten_triangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES, ORACLE = {"op11_whiten_triangle": op11_whiten_triangle}, {}
