import numpy as np
import pytest
from pyspark.sql import functions as F

from tagpulse.llm import whitening
from tagpulse.llm.queries import QUERIES, table

rng = np.random.default_rng(3)


def symmetric(n, kind):
    m = rng.standard_normal((n, n))
    if kind == "ties":
        q, _ = np.linalg.qr(m)
        m = q @ np.diag(rng.integers(-2, 3, n).astype(float)) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("kind", ["any", "ties"])
def test_inertia(kind):
    for _ in range(60):
        m = symmetric(int(rng.integers(1, 40)), kind)
        values = np.linalg.eigvalsh(m)
        for shift in rng.uniform(-4, 4, 5):
            assert whitening.inertia_below(m, shift) == (values < shift).sum()


@pytest.mark.parametrize("kind", ["full", "deficient", "ties", "close", "scaled"])
def test_leading_pairs(kind):
    for trial in range(12):
        n = int(rng.integers(2, 66))
        a = rng.standard_normal((n if kind != "deficient" else int(rng.integers(1, n)), n))
        m = a.T @ a
        if kind == "ties":
            m = np.diag(rng.integers(1, 4, n).astype(float))
        if kind == "close":
            m = np.eye(n) + 1e-11 * m
        if kind == "scaled":
            m = m * np.outer(s := 10.0 ** rng.uniform(-3, 3, n), s)
        values, vectors = whitening.leading_pairs(m.astype(np.longdouble), 32)
        expected = np.linalg.eigvalsh(m)[::-1][:32]
        trace = np.trace(m)
        assert len(values) == (expected > 4 * n * whitening.EPS * trace).sum()
        assert np.abs(values - expected[: len(values)]).max() <= 1e-13 * trace
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-9
        assert np.abs(m @ vectors.T - vectors.T * values).max() <= 1e-13 * trace
        assert (np.diff(values) <= 1e-13 * trace).all()


def expected_rows(vectors, components=32):
    """By numpy, exact sums by Python integers."""
    x = [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(col) for col in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(n * c - s) for c, s in zip(row, sums)] for row in x]) / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, deviations, centred @ axes / np.sqrt(values), values / np.trace(cov)


def hold(rows, vectors, components):
    """`vectors` by id, those that take part."""
    n, deviations, white, explained = expected_rows(list(vectors.values()), components)
    assert len(rows) == len(vectors) * white.shape[1]
    found = {(r.vec_id, r.component): r for r in rows}
    for k in range(white.shape[1]):
        mine = np.array([found[i, k + 1].whitened for i in vectors])
        assert min(np.abs(mine - white[:, k]).max(), np.abs(mine + white[:, k]).max()) < 1e-7
    for i, d in zip(vectors, deviations):
        assert all(found[i, k + 1].deviation == d for k in range(white.shape[1]))
    for r in rows:
        assert r.n == n and abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error <= 1e-4
    assert len({r.identity_error for r in rows}) == 1


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    vectors = {r.vec_id: r.embedding for r in table(spark, sf, "embeddings").collect()
               if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)}
    hold(QUERIES["op12_whitening"](spark, sf).collect(), vectors, 32)


def odd(spark, far=1e4):
    r = np.random.default_rng(1)
    rows = [(k, r.standard_normal(5).tolist()) for k in range(40)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, []), (105, [1.0, 2.0]), (106, [1e300] * 5)]
    good = [*rows, (None, [0.1] * 5), (7, rows[7][1]), (200, [far, -far, 3.0, 0.0, 5.5])]
    return good, spark.createDataFrame([*good, *bad], "vec_id long, embedding array<double>").withColumns({"n": F.lit("x"), "component": F.lit("x"), "key": F.lit("x"), "v": F.lit(1)})


def test_odd_vectors(spark):
    good, df = odd(spark)
    model = whitening.fit(df)
    rows = whitening.whiten(df.repartition(4), model).collect()
    vectors = {i: v for i, v in good}
    assert len(rows) == len(good) * 5
    n, deviations, _, _ = expected_rows([v for _, v in good])
    assert model.n == n == len(good)
    found = {r.vec_id: r.deviation for r in rows}
    assert all(found[i] == d for (i, _), d in zip(good, deviations))
    assert rows[0].identity_error < 1e-6 and set(found) == set(vectors)


def test_order_and_partitions_change_nothing(spark):
    _, df = odd(spark)
    one, other = whitening.fit(df.coalesce(1)), whitening.fit(df.repartition(7))
    assert (one.n, one.sums, one.trace) == (other.n, other.sums, other.trace)
    assert (one.values == other.values).all() and (one.vectors == other.vectors).all()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = whitening.fit(df)
    assert len(model.values) == 0 and whitening.whiten(df, model).collect() == []


def test_constant_dimensions_have_no_component(spark):
    rows = [(k, [float(k % 7), 3.0, float(k % 5), float(k % 7)]) for k in range(70)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = whitening.whiten(df, whitening.fit(df)).collect()
    assert {r.component for r in found} == {1, 2} and found[0].identity_error < 1e-9
    assert abs(sum({r.component: r.explained for r in found}.values()) - 1) < 1e-12


def test_large_numbers_stay_exact():
    x = np.array([[2**40, -(2**40)], [2**40 + 1, 5], [3, 2**39]])
    assert (whitening._gram(x) == x.astype(object).T @ x.astype(object)).all()
    sums = [int(s) for s in x.sum(0)]
    model = whitening.Whitening(3, sums, 1.0, np.ones(1), np.ones((1, 2)))
    assert model.deviations(x) == [sum((3 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]


def test_components_that_doubles_cannot_tell_from_zero(spark):
    """Beside a vector 10^9 away the others vary by less than the last digit of the trace."""
    good, df = odd(spark, 1e9)
    rows = whitening.whiten(df, whitening.fit(df)).collect()
    assert {r.component for r in rows} == {1} and len(rows) == len(good) and rows[0].identity_error < 1e-9
    deviations = expected_rows([v for _, v in good])[1]
    assert sorted(r.deviation for r in rows) == sorted(deviations)
