import math
import random
from fractions import Fraction

import numpy as np
import pytest

from scorelake.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, x string, component int, n string"


def run(spark, rows, components=4):
    frame = spark.createDataFrame([(i, v, "x", 9, "n") for i, v in rows], SCHEMA).repartition(5)
    return whitening.whiten(whitening.scaled_vectors(frame), components).collect()


def expected(rows):
    """n, sums, exact covariance of the distinct scaled vectors."""
    vectors = sorted({tuple(math.floor(256 * float(np.float32(c))) for c in v) for _, v in rows})
    n, sums = len(vectors), [sum(c) for c in zip(*vectors)]
    d = len(sums)
    covariance = [[sum((Fraction(v[i]) - Fraction(sums[i], n)) * (Fraction(v[j]) - Fraction(sums[j], n)) for v in vectors) / n for j in range(d)] for i in range(d)]
    return n, sums, covariance


def test_against_exact_covariance(spark):
    r = random.Random(3)
    mix = [[r.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    rows = [(i, [sum(m * z for m, z in zip(line, [r.gauss(0, 1.5**k) for k in range(6)])) + 7 for line in mix]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)] + [(None, rows[6][1]), (3, rows[7][1])]
    bad = [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2002, [math.nan] * 6), (2003, [-math.inf] + [0.0] * 5), (2004, [])]
    got = run(spark, rows + bad)
    n, sums, covariance = expected(rows)
    assert len(got) == 4 * len(rows) and {g.n for g in got} == {n}
    values, vectors = np.linalg.eigh(np.array(covariance, dtype=float))
    values, vectors = values[::-1], vectors[:, ::-1]
    by = {}
    for g in got:
        by.setdefault(g.component, {}).setdefault(g.vec_id, []).append(g)
    for k in range(4):
        shares = {g.explained for gs in by[k + 1].values() for g in gs}
        assert len(shares) == 1 and shares.pop() == pytest.approx(values[k] / values.sum(), rel=1e-12)
        x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in rows if i != 3}
        want = {i: (np.array([float(c - Fraction(s, n)) for c, s in zip(v, sums)]) @ vectors[:, k]) / math.sqrt(values[k]) for i, v in x.items()}
        sign = 1 if want[0] * by[k + 1][0][0].whitened > 0 else -1
        for i, w in want.items():
            assert by[k + 1][i][0].whitened == pytest.approx(sign * w, abs=1e-9)
            assert by[k + 1][i][0].deviation == sum((n * c - s) ** 2 for c, s in zip(x[i], sums))
        assert len(by[k + 1][3]) == 2 and len(by[k + 1][None]) == 1
    assert {g.identity_error for g in got}.pop() < 1e-12 and len({g.identity_error for g in got}) == 1


@pytest.mark.parametrize("gap", [1e-2, 1e-7, 1e-12, 0.0])
def test_refinement_parts_clusters(gap):
    r = np.random.default_rng(5)
    q, _ = np.linalg.qr(r.normal(size=(40, 40)))
    values = np.concatenate([5 + gap * np.arange(8), [5.5, 5.5 + 1e-9], r.uniform(0, 1, 30)])
    q = q.astype(np.longdouble)
    q = q @ (1.5 * np.eye(40) - 0.5 * q.T @ q)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.refine(a)
    assert np.allclose(got, np.sort(values)[::-1], rtol=0, atol=2e-15 * 6)
    assert np.abs(x.T @ x - np.eye(40)).max() < 1e-15 * 4
    assert np.abs(a.astype(float) @ x - x * got).max() < 1e-14
    inside = x.astype(np.longdouble).T @ a @ x.astype(np.longdouble)
    assert np.abs(inside - np.diag(np.diag(inside))).max() < 5e-15


def test_refinement_reaches_double_precision():
    """Separated eigenvectors agree with those of extended precision, where float32 has half the digits."""
    r = np.random.default_rng(1)
    q, _ = np.linalg.qr(r.normal(size=(30, 30)))
    q = q.astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(30) - 0.5 * q.T @ q)
    values = np.linspace(10, 1, 30)
    _, x = whitening.refine((q * values) @ q.T)
    want = q * np.sign(q[np.abs(q).argmax(0), np.arange(30)])
    assert np.abs(x - want).max() < 3e-16


def test_lengths_are_fitted_apart_and_flat_components_have_no_result(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [1.0, 5.0]), (10, [1.0, 0.0, 0.0]), (11, [0.0, 0.0, 0.0]), (20, [4.0])]
    got = {(g.vec_id, g.component): g for g in run(spark, rows)}
    assert sorted(got) == sorted([(i, k) for i in (0, 1, 2) for k in (1, 2)] + [(i, k) for i in (10, 11) for k in (1, 2, 3)] + [(20, 1)])
    assert {k: g.n for k, g in got.items() if k[1] == 1} == {(0, 1): 3, (1, 1): 3, (2, 1): 3, (10, 1): 2, (11, 1): 2, (20, 1): 1}
    assert got[0, 2].whitened is None and got[0, 1].explained == 1.0 and got[20, 1].whitened is None and got[20, 1].explained is None and got[20, 1].identity_error is None
    assert sorted(abs(got[i, 1].whitened) for i in (10, 11)) == [1.0, 1.0]


def test_wide_entries_and_empty_table(spark):
    got = run(spark, [(i, [3e9 * math.cos(i), 1e9 * math.sin(i), 5.0]) for i in range(40)])
    assert len(got) == 120 and all(g.identity_error < 1e-4 for g in got)
    got = run(spark, [(0, [3e38, 1.0]), (1, [-3e38, 1.0]), (2, [1.0, 1.0])])
    assert len(got) == 6 and all(g.n == 3 for g in got)
    assert run(spark, []) == []


def test_exact_sums_of_large_entries(spark, monkeypatch):
    monkeypatch.setattr(whitening, "_ROWS", 7)
    monkeypatch.setattr(whitening, "_FLUSH", 20)
    r = random.Random(9)
    rows = [(i, [float(np.float32(r.uniform(-4e6, 4e6))) for _ in range(3)]) for i in range(100)]
    n, sums, covariance = expected(rows)
    frame = spark.createDataFrame([(i, v, "x", 9, "n") for i, v in rows], SCHEMA)
    fit_list = whitening.scaled_vectors(frame).select("x").distinct()
    found = whitening._sums(fit_list)
    assert found[3][:2] == (n, sums)
    moments = whitening._moments(fit_list, found)[3]
    assert all(abs(Fraction(float(moments[i, j])) - covariance[i][j]) <= abs(covariance[i][j]) / 2**52 for i in range(3) for j in range(3))
