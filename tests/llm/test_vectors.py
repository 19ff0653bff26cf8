"""Whitening and hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import negatives, whitening
from rostrum.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"
#: Names that the operators use themselves.
CLASHES = ["x", "key", "n", "c0", "component", "whitened", "deviation", "vector", "is_anchor", "rank", "score", "hash", "anchor"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, entries that are no numbers, other lengths, ties, repeated rows and ids, clashing columns."""
    rng = random.Random(4)
    rows = [(n, [rng.gauss(0, 1) * s for s in (3, 1, 1, 0.2)], n % 3) for n in range(60)]
    rows += [(100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [math.nan, 0.0, 0.0, 0.0], 1), (103, [math.inf, 0.0, 0.0, 0.0], 1), (104, [1.0, 2.0], 1), (105, [], 1), (106, [0.5, 0.5, 0.5, 0.5], None)]
    rows += [(None, [1.0, 1.0, 1.0, 1.0], 1)] + [(k, [2.0, 0.0, 1.0, 0.0], k % 2) for k in range(200, 230)] + [(50, [2.0, 0.0, 1.0, 0.0], 2)] * 3 + [(50, [1.0, 0.0, 1.0, 0.0], 2), (-50, [2.0, 0.0, 1.0, 0.0], 0), (0, rows[0][1], 0)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)


def usable(df, dimensions):
    return [r for r in df.collect() if r.embedding is not None and len(r.embedding) == dimensions and all(c is not None and math.isfinite(c) for c in r.embedding)]


# 11 -----------------------------------------------------------------------------------------------


def check_whitening(rows, got, dimensions, components=8):
    x = np.floor(1024 * np.array([r.embedding for r in rows], float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    v = np.cov(x.T.astype(float), bias=True)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviations = ((n * x - total) ** 2).sum(1)
    assert {r.component for r in got} == set(range(1, min(components, dimensions) + 1)) and len(got) == n * min(components, dimensions)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-9
    for k in range(min(components, dimensions)):
        own = sorted(((repr(r.vec_id), r.deviation, r.whitened) for r in got if r.component == k + 1), key=lambda r: (r[0], r[1], r[2]))
        w = (x - total / n) @ vectors[:, k] / np.sqrt(values[k])
        assert all(r.explained == pytest.approx(values[k] / np.trace(v), rel=1e-9) for r in got if r.component == k + 1)
        for sign in (1, -1):
            want = sorted(((repr(r.vec_id), int(d), sign * float(y)) for r, d, y in zip(rows, deviations, w, strict=True)), key=lambda r: (r[0], r[1], r[2]))
            if [r[:2] for r in want] == [r[:2] for r in own] and np.allclose([r[2] for r in own], [r[2] for r in want], atol=1e-9):
                break
        else:
            raise AssertionError(f"component {k + 1}")


def test_whitening_of_embeddings(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    check_whitening(usable(table, 64), QUERIES["op11_whiten_triangle"](spark, FOLDER).collect(), 64)


def test_whitening_of_odd_rows(spark, odd):
    got = whitening.whiten_embeddings(odd).collect()
    check_whitening(usable(odd, 4), got, 4)
    assert sum(r.vec_id is None for r in got) == 4 and sum(r.vec_id == 50 for r in got) == 20


def test_vectors_without_a_covariance(spark):
    make = lambda rows: sorted(whitening.whiten_embeddings(spark.createDataFrame(rows, SCHEMA)).collect())
    assert make([]) == [] and make([(1, [], 1), (2, None, 1)]) == [] and make([(1, [1.0, 2.0], 1)]) == [] and make([(1, [1.0], 1), (2, [1.0], 1)]) == []
    # One direction has variance: two rows at -1 and 1 of it.
    got = make([(1, [0.0, 5.0], 1), (2, [1.0, 5.0], 1), (3, [7.0], 1)])
    assert [(r.vec_id, r.component, r.n, r.deviation, round(r.whitened, 12), r.explained) for r in got] == [(1, 1, 2, 1024**2, -1.0, 1.0), (2, 1, 2, 1024**2, 1.0, 1.0)]


def test_very_large_entries(spark):
    """Beyond the exact range of longs sums are doubles and deviations that don't fit are null."""
    rows = [(1, [1e30, 1.0], 1), (2, [-1e30, 2.0], 1), (3, [0.0, 3.0], 1), (4, [0.0, 4.0], 1)]
    got = sorted(whitening.whiten_embeddings(spark.createDataFrame(rows, SCHEMA)).collect())
    assert {r.component for r in got} == {1} and [round(r.whitened, 6) for r in got] == [round(s * math.sqrt(2), 6) for s in (1, -1, 0, 0)]
    assert [r.deviation is None for r in got] == [True, True, False, False]


def test_pairs_in_several_aggregations(spark):
    rows = spark.createDataFrame([(k, k * k % 7, 3 - k) for k in range(20)], "a long, b long, c long")
    once, often = (whitening.pair_sums(rows, ["a", "b", "c"], n) for n in (100, 2))
    assert once == often and once[0] == 20 and once[2][0, 2] == sum(k * (3 - k) for k in range(20))
    x = np.array([(k, k * k % 7, 3 - k) for k in range(20)], float)
    assert np.allclose(whitening.assemble(*once), np.cov(x.T, bias=True))


def test_products_are_one_aggregation(spark):
    """All pairs of a table of 64 dimensions are summed by one job, a row a task."""
    rows, dimensions = whitening.usable_vectors(spark.read.parquet(f"{FOLDER}/embeddings.parquet"))
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    whitening.pair_sums(whitening._centred(rows, [100_000] * dimensions), [f"c{i}" for i in range(dimensions)])
    assert dimensions * (dimensions + 1) // 2 + dimensions + 1 == 2145 and len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before <= 2


# 12 -----------------------------------------------------------------------------------------------


def brute_negatives(rows, anchors, k=5, many=3, window=(50, 95)):
    """Distinct rows (id, label, whole vector) one by one."""
    last = lambda i: (i is None, i)
    rows = sorted({(last(i), label, tuple(math.floor(256 * c) for c in v)) for i, v, label in rows}, key=repr)
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2], strict=True))
    out = []
    for a in rows:
        if a[0][0] or not anchors(a[0][1]):
            continue
        best = sorted((r for r in rows if r != a and r[1] == a[1]), key=lambda r: (-score(a, r), r[0]))[:k]
        other = sorted((r for r in rows if r[1] != a[1]), key=lambda r: (-score(a, r), r[0]))
        for p in best:
            s = score(a, p)
            found = [r for r in other if window[0] * s <= 100 * score(a, r) <= window[1] * s][:many]
            out += [(a[0][1], p[0][1], n + 1, r[0][1], s, score(a, r)) for n, r in enumerate(found)]
    return sorted(out, key=repr)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_negatives_of_embeddings(spark):
    table = usable(spark.read.parquet(f"{FOLDER}/embeddings.parquet"), 64)
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table]
    got = QUERIES["op12_pca_negatives"](spark, FOLDER)
    assert plain(got) == brute_negatives(rows, lambda i: i % 50 == 0) and got.count() > 50


@pytest.mark.parametrize("block", [3, 1000])
def test_negatives_of_odd_rows(spark, odd, block):
    """Ties go by id, rows without an id last; equal rows are one, rows that share an id and differ are two."""
    rows = [(r.vec_id, r.embedding, r.label) for r in usable(odd, 4) if r.label is not None]
    # Two rows of id 50 differ; where they tie, their order is a hash's: leave out what hangs on it.
    got = plain(negatives.mine_negatives(odd, F.col("vec_id") % 10 == 0, block=block))
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert got == want and {r[0] for r in want} >= {-50, 0, 50} and any(r[3] is None for r in want)


def test_negatives_without_partners(spark):
    mine = lambda rows: plain(negatives.mine_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    assert mine([]) == [] and mine([(0, [1.0], 1)]) == [] and mine([(0, [1.0], 1), (1, [1.0], 1)]) == [] and mine([(7, [1.0], 1), (8, [1.0], 1)]) == []
    # Negative products open no window; a product of 0 takes products of 0.
    assert mine([(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.5, 0.0], 2)]) == []
    assert mine([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 2.0], 2)]) == [(0, 1, 1, 2, 0, 0)]
    assert mine([(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [1e12, 0.0], 2), (4, [0.9, 0.0], 2)]) == [(0, 1, 1, 4, 65536, 58880), (0, 1, 2, 2, 65536, 32768)]


@pytest.mark.parametrize(("scale", "spectrum"), [(256, 1.0), (256, 0.8), (100_000_000, 0.9), (3, 0.5)])
def test_no_pair_is_discarded_wrongly(scale, spectrum):
    """All pairs between the bounds survive, at any size of entries and any spectrum; few others get as far as a product."""
    rng = np.random.default_rng(7)
    turn = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    x = np.floor(scale * (rng.normal(size=(300, 32)) * spectrum ** np.arange(32)) @ turn.T).astype(np.int64)
    x[150:160] = x[0]
    rotation = negatives.Rotation.of((x.T @ x).astype(float))
    a, b = rotation.turn(x[:40]), rotation.turn(x)
    exact = np.array([[sum(int(p) * int(q) for p, q in zip(r, s, strict=True)) for s in x.tolist()] for r in x[:40].tolist()])
    wanted = rng.random(exact.shape) < 0.9
    for low, high in ((np.sort(exact, 1)[:, -5], np.full(40, negatives.NO_ID)), (np.sort(exact, 1)[:, -60], np.sort(exact, 1)[:, -40]), (np.full(40, negatives.LEAST), np.full(40, negatives.NO_ID))):
        i, j, score = negatives.surviving_pairs(a, b, rotation.cuts, wanted, low, high)
        want = {(p, q) for p, q in zip(*np.nonzero(wanted & (exact >= low[:, None]) & (exact <= high[:, None])), strict=True)}
        assert set(zip(i, j, strict=True)) == want and (score == exact[i, j]).all() and len(i) == len(want)


def test_leading_components_discard_pairs(monkeypatch):
    """With most of the length in a few directions hardly a pair needs its whole product."""
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.normal(size=(2000, 64)) * 0.7 ** np.arange(64)).astype(np.int64)
    rotation = negatives.Rotation.of((x.T @ x).astype(float))
    a, b = rotation.turn(x[:50]), rotation.turn(x)
    low = np.sort(x[:50] @ x.T, 1)[:, -5]
    verified = []
    whole = negatives.pair_products
    monkeypatch.setattr(negatives, "pair_products", lambda *args: verified.append(len(args[2])) or whole(*args))
    i, _, _ = negatives.surviving_pairs(a, b, rotation.cuts, np.ones((50, 2000), bool), low, np.full(50, negatives.NO_ID))
    assert len(i) >= 250 and sum(verified) < 0.02 * 100_000
