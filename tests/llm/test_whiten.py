"""Whitening against exact whole-number covariances and numpy's eigenvectors."""

import numpy as np
import pytest

from basketry.llm import singular, whiten

DATA = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, id string, component string, n int"


def expected(vectors, components=16):
    """Vectors as given, without the bad ones: per row deviation and whitened values."""
    y = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors])
    fit = np.unique(y, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    return n, ((n * y - s) ** 2).sum(axis=1), (y - s / n) @ vector / np.sqrt(value), value / np.trace(centred.T @ centred / n)


def check(got, ids, vectors, components=16):
    n, deviation, white, explained = expected(vectors, components)
    k = white.shape[1]
    assert len(got) == len(ids) * k
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    for i, vec_id in enumerate(ids):
        assert {r.deviation for c in by[vec_id].values() for r in c} == {int(deviation[i])}
    for c in range(k):
        mine = np.array([by[i][c + 1][0].whitened for i in ids])
        sign = np.sign(mine @ white[:, c])
        np.testing.assert_allclose(mine * sign, white[:, c], atol=1e-8)
        assert abs(by[ids[0]][c + 1][0].explained / explained[c] - 1) < 1e-9
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    kept = [(r.vec_id, r.embedding) for r in table.collect() if r.embedding and np.isfinite(np.array(r.embedding, float)).all()]
    got = whiten.whiten(table.repartition(7)).collect()
    check(got, [i for i, _ in kept], [v for _, v in kept])


def test_bad_and_repeated_vectors(spark):
    rnd = np.random.default_rng(3)
    good = [(i, [float(c) for c in rnd.standard_normal(5)]) for i in range(40)]
    good += [(i + 100, v) for i, v in good[:10]]
    bad = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5),
           (204, [1.0, 1.0, float("inf"), 1.0, 1.0]), (205, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, "x", "y", 7) for i, v in good + bad], SCHEMA)
    got = whiten.whiten(frame).collect()
    check(got, [i for i, _ in good], [v for _, v in good])
    twice = whiten.whiten(frame.union(frame)).collect()
    assert len(twice) == 2 * len(got) and {r.n for r in twice} == {40}


def test_tables_without_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten.whiten(empty).columns[0] == "vec_id" and whiten.whiten(empty).isEmpty()
    one = spark.createDataFrame([(1, [0.5, 1.0], "x", "y", 1), (2, [0.5, 1.0], "x", "y", 1), (3, None, None, None, None)], SCHEMA)
    assert whiten.whiten(one).isEmpty()
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0], "x", "y", 1) for i in range(6)], SCHEMA)
    assert {r.component for r in whiten.whiten(line).collect()} == {1}


def test_few_triangles_at_a_time(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").repartition(9)
    few = whiten.whiten(table, settings=whiten.WhitenSettings(fan=2, block=3)).orderBy("vec_id", "component").collect()
    many = whiten.whiten(table).orderBy("vec_id", "component").collect()
    a, b = np.array([r.whitened for r in few]), np.array([r.whitened for r in many])
    np.testing.assert_allclose(np.abs(a), np.abs(b), atol=1e-9)


@pytest.mark.parametrize("seed", range(4))
def test_singular_values_and_vectors(seed):
    rnd = np.random.default_rng(seed)
    a = rnd.standard_normal((60, 24)) @ np.diag(10.0 ** (-np.arange(24) * seed / 6))
    if seed == 3:
        a[:, 5] = a[:, 4]
    r = np.linalg.qr(a, mode="r")
    values, vectors = singular.right_vectors(r, 16)
    want = np.linalg.svd(r)[1] ** 2
    np.testing.assert_allclose(values, want, rtol=1e-9, atol=1e-13 * want[0])
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(16), atol=1e-11)
    assert np.abs(r.T @ (r @ vectors) - vectors * values[:16]).max() <= 1e-12 * want[0]


def test_equal_singular_values():
    values, vectors = singular.right_vectors(np.diag([3.0, 3, 3, 1, 1, 0, 0]), 5)
    assert values.tolist() == [9, 9, 9, 1, 1, 0, 0]
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(5), atol=1e-14)
