"""The solver against a dense one, and whitened rows against their definition."""

from decimal import Decimal

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings, strategies as st

from tablecontract.llm import whitening
from tablecontract.llm.bidiagonal import bidiagonalise, dqds, right_singular, twisted
from tablecontract.llm.whitening import whiten


def triangle(kind, n, r):
    rows = {
        "full": lambda: r.normal(size=(3 * n, n)),
        "graded": lambda: r.normal(size=(3 * n, n)) @ np.diag(10.0 ** -np.linspace(0, 7, n)),
        "few": lambda: r.normal(size=(n // 2 + 1, n)),
        "equal": lambda: np.diag(np.repeat([5.0, 3.0, 1.0], n)[:n]) @ np.linalg.qr(r.normal(size=(n, n)))[0],
        "wilkinson": lambda: np.diag(np.abs(np.arange(n) - n // 2) + 1e-3) + np.diag(np.ones(n - 1), 1),
        "parts": lambda: np.kron(np.eye(3), r.normal(size=(n, n)))[:, :n],
        "zero": lambda: np.zeros((n, n)),
    }[kind]()
    out = np.linalg.qr(rows, mode="r")
    return np.concatenate((out, np.zeros((n - len(out), n))))


@settings(max_examples=80, deadline=None)
@given(st.sampled_from(["full", "graded", "few", "equal", "wilkinson", "parts", "zero"]), st.integers(1, 40), st.integers(0, 10**6))
def test_values_and_directions(kind, n, seed):
    m = triangle(kind, n, np.random.default_rng(seed))
    values, vectors = right_singular(m)
    want = np.linalg.svd(m, compute_uv=False) ** 2
    assert values == pytest.approx(want, rel=1e-12, abs=1e-14 * want[0])
    live = values > 1e-13 * max(want[0], 1e-300)
    v = vectors[:, live]
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max(initial=0) < 1e-9
    assert np.abs(m.T @ (m @ v) - v * values[live]).max(initial=0) <= 1e-12 * max(want[0], 1e-300)


def test_small_values_keep_their_digits():
    a, b = 10.0 ** -np.arange(0, 12, 1.0), 10.0 ** -np.arange(0.5, 11.5, 1.0)
    from fractions import Fraction

    # The product of the squares is the square of the product of the diagonal, whatever their sizes.
    product = 1
    for x in dqds(a, b):
        product *= Fraction(float(x))
    exact = 1
    for x in a:
        exact *= Fraction(float(x)) ** 2
    assert float(product / exact) == pytest.approx(1, rel=1e-12)


def test_twisted_vector_of_a_small_value():
    r = np.random.default_rng(5)
    a, b, v = bidiagonalise(np.linalg.qr(r.normal(size=(90, 30)), mode="r"))
    full = np.diag(a) + np.diag(b, 1)
    for value in dqds(a, b):
        z = twisted(a, b, float(value))
        assert np.abs(full.T @ (full @ z) - value * z).max() < 1e-12
    assert np.abs(v.T @ v - np.eye(30)).max() < 1e-13


def brute(rows, components=32):
    x = np.floor(64 * np.array(rows, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    deviation = [sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, total, strict=True)) for row in x]
    return deviation, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def check(frame, rows, **options):
    out = sorted(whiten(frame, **options).collect(), key=lambda r: (r.vec_id, r.component))
    deviation, whitened, explained = brute(rows, options.get("components", 32))
    width = whitened.shape[1]
    assert [(r.vec_id, r.component, r.n) for r in out] == [(i, k + 1, len(rows)) for i in range(len(rows)) for k in range(width)]
    assert [int(r.deviation) for r in out[::width]] == deviation
    got = np.array([r.whitened for r in out]).reshape(-1, width)
    sign = np.sign((got * whitened).sum(axis=0))
    assert np.abs(got * sign - whitened).max() < 1e-8
    assert np.array([r.explained for r in out[:width]]) == pytest.approx(explained, rel=1e-9)
    assert {r.identity_error for r in out} == {out[0].identity_error} and out[0].identity_error < 1e-9


def test_given_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [list(r.embedding) for r in table.orderBy("vec_id").collect()]
    check(table, rows)


def test_many_tasks_join_their_triangles(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    r = np.random.default_rng(4)
    rows = (r.normal(size=(300, 6)) @ np.diag([8, 4, 2, 1, 0.5, 0.2]) + 3).astype(np.float32).tolist()
    check(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>").repartition(20), rows, components=4)


def test_odd_vectors_go_and_dead_components_are_null(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 5.0], [2.0, -1.0, 5.0], [0.5, 0.25, 5.0], [0.5, 0.25, 5.0]]
    odd = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1e30, 1.0, 1.0], [1.0, 2.0]]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(good)] + [(9, v, "x", 1) for v in odd] + [(None, good[0], "x", 1)], "vec_id long, embedding array<double>, N string, component int")
    out = whiten(frame).collect()
    assert sorted({r.vec_id for r in out if r.vec_id is not None}) == [0, 1, 2, 3] and len(out) == 15
    assert {(r.component, r.whitened is None) for r in out} == {(1, False), (2, False), (3, True)}
    assert {r.explained for r in out if r.component == 3} == {0.0} and {r.n for r in out} == {5}
    assert out[0].identity_error < 1e-9


def test_no_vectors_one_vector_and_far_ones(spark):
    schema = "vec_id long, embedding array<double>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    one = whiten(spark.createDataFrame([(1, [2.0, 3.0])], schema)).collect()
    assert [(r.whitened, r.deviation) for r in one] == [(None, 0), (None, 0)]
    far = whiten(spark.createDataFrame([(1, [3e12, 0.0]), (2, [-3e12, 1.0])], schema), components=1).collect()
    x = 64 * 3 * 10**12
    assert {r.deviation for r in far} == {Decimal((2 * x) ** 2 + 64**2)} and sorted(round(r.whitened, 9) ** 2 for r in far) == [1, 1]
