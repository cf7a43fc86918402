"""Whitening and bisector clustering against brute force, with odd rows, ties and repeats."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from simsearch.llm import bisector, whitening

DIM = 64
SCHEMA = "vec_id bigint, embedding array<double>, label int, n int, cluster string, `x y` string"


def _rows(count=150, dim=DIM, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(count, dim)) * np.linspace(0.2, 1.5, dim) + rng.normal(size=dim)
    x[-40:] = x[3]  # a vector that holds a large share of the rows
    rows = [(i, [float(v) for v in row], 1, 2, "clash", "odd") for i, row in enumerate(x)]
    bad = [None, [], [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [math.nan] + [1.0] * (dim - 1), [math.inf] * dim]
    rows += [(1000 + i, b, None, None, None, None) for i, b in enumerate(bad)]
    return rows + [rows[5], rows[5], (None, rows[6][1], 1, 2, "clash", "odd")]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(5)


def _usable(rows, dim=DIM):
    return [(r[0], r[1]) for r in rows if r[1] is not None and len(r[1]) == dim and all(v is not None and math.isfinite(v) for v in r[1])]


# ---- whitening


def _expected(rows):
    """vec_id and numbers of each usable row, by exact covariance and a library's eigenvectors."""
    kept = _usable(rows)
    x = [[math.floor(64 * v) + 1_000_000 for v in e] for _, e in kept]
    fit = sorted(set(map(tuple, x)))
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[n * a - s for a, s in zip(row, total, strict=True)] for row in fit], dtype=object)
    scatter = centred.T @ centred
    v = np.array([[float(Fraction(int(e), n**3)) for e in row] for row in scatter])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    own = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, total, strict=True)] for row in x])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, total, strict=True)) for row in x]
    return kept, n, deviation, own @ vectors[:, :16] / np.sqrt(values[:16]), values[:16] / np.trace(v)


def test_whitening_equals_brute_force(table):
    kept, n, deviation, whitened, explained = _expected(_rows())
    got = whitening.whiten(table)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.collect()
    assert len(rows) == 16 * len(kept) and {r["n"] for r in rows} == {n} and {r["component"] for r in rows} == set(range(1, 17))
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-10
    by_component = {}
    for r in rows:
        by_component.setdefault(r["component"], {}).setdefault(r["vec_id"], set()).add((r["deviation"], round(r["whitened"], 7)))
    for c in range(16):
        own = by_component[c + 1]
        sign = 1 if any(abs(w - whitened[0, c]) < 1e-6 for _, w in own[0]) else -1
        for (vec_id, _), d, w in zip(kept, deviation, whitened[:, c], strict=True):
            assert any(got_d == d and abs(got_w - sign * w) < 1e-6 for got_d, got_w in own[vec_id])
    assert all(abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 for r in rows)


def test_whitening_does_not_depend_on_how_rows_are_dealt(table):
    once, again = (whitening.whiten(df).select("vec_id", "component", "deviation", F.round("whitened", 12), "explained") for df in (table, table.repartition(2, "vec_id")))
    assert sorted(map(repr, once.collect())) == sorted(map(repr, again.collect()))


@pytest.mark.parametrize("rank", [1, 3])
def test_few_directions_give_as_many_components(spark, rank):
    rng = np.random.default_rng(1)
    base = rng.integers(-3, 4, size=(rank, 8))
    rows = [(i, [float(v) / 64 for v in rng.integers(-5, 6, size=rank) @ base]) for i in range(60)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert got.select("component").distinct().count() == rank and got.count() == 60 * rank
    assert got.first()["identity_error"] < 1e-9


def test_equal_vectors_ragged_ones_and_empty_tables_have_defined_results(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    for rows in ([], [(1, None)], [(1, []), (2, [float("nan")])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    ragged = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [1.0]), (4, [3.0, 3.0, 3.0])]
    assert {r["vec_id"] for r in whitening.whiten(spark.createDataFrame(ragged, schema)).collect()} == {1, 2}
    assert {r["vec_id"] for r in whitening.whiten(spark.createDataFrame(ragged + [(5, [1.0, 1.0, 3.0])], schema)).collect()} == {4, 5}


def test_huge_entries_are_bounded_and_deviations_beyond_a_long_are_null(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.5, 0.5]), (4, [0.25, -2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3, 4}
    assert {r["deviation"] for r in got if r["vec_id"] == 1} == {None}


def test_factor_and_rotations_give_the_eigenvalues():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(30, 12)) * np.logspace(0, -6, 12)
    v = a.T @ a
    low, order = whitening.pivoted_cholesky(v)
    assert np.allclose(low @ low.T, v[np.ix_(order, order)], rtol=1e-12, atol=1e-14) and np.allclose(low, np.tril(low))
    values, vectors = whitening.eigen(v)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    assert np.allclose(values[:6], np.linalg.eigvalsh(v)[::-1][:6], rtol=1e-10)


def test_packed_vectors_come_back():
    x = np.array([[1, -2], [127, -127], [128, 0], [70000, 1], [1 << 40, -(1 << 40)]])
    got = np.concatenate([u for part in whitening.packed(x) for u in whitening.unpacked(part, 2)])
    assert sorted(map(tuple, got.tolist())) == sorted(map(tuple, x.tolist()))


# ---- bisector clustering


def _clusters(rows, k=8, rounds=10, dim=DIM):
    kept = [(i, [math.floor(1024 * v) for v in e]) for i, e in _usable(rows, dim)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in first[:k]]
    apart = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    nearest = lambda x: min(range(len(centroids)), key=lambda j: (apart(x, centroids[j]), j))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x), []).append(x)
        centroids = [[sum(c) // len(groups[j]) for c in zip(*groups[j], strict=True)] if j in groups else centroids[j] for j in range(len(centroids))]
    placed = [(i, nearest(x), x) for i, x in kept]
    inertia = {}
    for _, j, x in placed:
        inertia[j] = inertia.get(j, 0) + apart(x, centroids[j])
    return [(i, j, apart(x, centroids[j]), inertia[j], sum(inertia.values()), centroids[j]) for i, j, x in placed]


@pytest.mark.parametrize("k", [1, 2, 8, 300])
def test_clusters_equal_brute_force(spark, table, k):
    if k > bisector.MOST_CENTROIDS:
        with pytest.raises(ValueError, match="between 1 and"):
            bisector.cluster(table, k=k)
        return
    got = sorted((tuple(r[:5]) + (list(r[5]),) for r in bisector.cluster(table, k=k).collect()), key=repr)
    assert got == sorted(_clusters(_rows(), k), key=repr)


def test_ties_go_to_the_smaller_number():
    centroids = np.array([[0, 0], [2, 0], [0, 2], [2, 2]])
    assert bisector.Tournament(centroids).winners(np.array([[1, 1], [2, 1], [1, 2], [0, 1], [2, 2]])).tolist() == [0, 1, 2, 0, 3]


def test_tournament_is_exact_beyond_doubles():
    rng = np.random.default_rng(2)
    centroids = rng.integers(-bisector.BOUND, bisector.BOUND, size=(6, 64))
    x = np.concatenate([rng.integers(-bisector.BOUND, bisector.BOUND, size=(50, 64)), centroids])
    want = [min(range(6), key=lambda j: (sum((int(a) - int(b)) ** 2 for a, b in zip(row, centroids[j], strict=True)), j)) for row in x]
    assert bisector.Tournament(centroids).winners(x).tolist() == want


def test_few_vectors_and_empty_tables(spark):
    schema = "vec_id bigint, embedding array<float>, cluster int"
    two = [(7, [1.0] * 64, 0), (9, [0.0] * 64, 0), (11, [1.0] * 63, 0)]
    got = bisector.cluster(spark.createDataFrame(two, schema)).collect()
    assert {r["vec_id"] for r in got} == {7, 9} and {r["distance"] for r in got} == {0} and len({r["cluster"] for r in got}) == 2
    for rows in ([], [(1, None, 0)]):
        assert bisector.cluster(spark.createDataFrame(rows, schema)).collect() == []
    huge = [(i, [float(10.0**i)] * 64, 0) for i in range(1, 30)]
    assert bisector.cluster(spark.createDataFrame(huge, "vec_id bigint, embedding array<double>, cluster int")).count() == 29
