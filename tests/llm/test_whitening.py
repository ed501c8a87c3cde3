import numpy as np
import pyarrow.parquet as pq
import pytest

from sensorlake.llm import whitening
from tests.llm.conftest import SF


def plain_whitening(rows, want=8):
    """id -> (deviation, whitened) by whole-number sums and a library's eigenvectors; eigenvalues, trace."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(0)
    dev = ((n * x - sums) ** 2).sum(1)
    mid = np.array([[float(e) / n for e in row] for row in n * x - sums])
    cov = mid.T @ mid / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:want], vectors[:, ::-1][:, :want]
    return n, dev, mid @ vectors / np.sqrt(values), values / np.trace(cov)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, whitened string")


def run(spark, rows, components=8):
    usable, dims = whitening.usable(frame(spark, rows))
    return whitening.whiten(usable, dims, whitening.fit(usable, dims, components)).collect()


@pytest.mark.parametrize("spectrum", ["spread", "tied", "pairs", "low rank", "identity", "single"])
def test_components_of_any_spectrum(spectrum):
    draw = np.random.default_rng(3)
    d = {"single": 1, "identity": 7}.get(spectrum, 48)
    e = {"spread": 0.7 ** np.arange(d), "tied": np.repeat(draw.random(6), 8), "pairs": np.repeat(draw.random(24), 2),
         "low rank": np.r_[draw.random(3), np.zeros(45)], "identity": np.ones(7), "single": np.ones(1)}[spectrum]
    turn, _ = np.linalg.qr(draw.standard_normal((d, d)))
    a = (turn * e) @ turn.T
    a = (a + a.T) / 2
    values, vectors = whitening.leading(a, d)
    assert np.allclose(values, np.sort(e)[::-1], atol=1e-13) and len(values) == d
    assert np.abs(vectors @ vectors.T - np.eye(d)).max() < 1e-12
    assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-13
    first, _ = whitening.leading(a, min(4, d))
    assert np.allclose(first, values[:4], atol=1e-14)


def test_polar_factor_has_the_signs_of_the_eigenvalues():
    draw = np.random.default_rng(5)
    turn, _ = np.linalg.qr(draw.standard_normal((20, 20)))
    e = np.r_[draw.random(9) + 1e-9, -draw.random(11) - 1e-12]
    assert np.abs(whitening.polar((turn * e) @ turn.T) - (turn * np.sign(e)) @ turn.T).max() < 1e-6


def test_whitening_against_a_library(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    n, dev, white, explained = plain_whitening(rows)
    got = whitening.op11_whiten(spark, SF).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    at = {i: k for k, (i, _) in enumerate(rows)}
    table = np.zeros((n, 8))
    for r in got:
        table[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == dev[at[r.vec_id]]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    table *= np.sign((table * white).sum(0))
    assert np.abs(table - white).max() < 1e-8
    assert got[0].identity_error < 1e-9
    assert np.abs(np.cov(table.T, bias=True) - np.eye(8)).max() < 1e-9


def test_sums_are_exact_far_from_zero_and_partitions_make_no_difference(spark):
    draw = np.random.default_rng(1)
    rows = [(i, (v * [1, 2, 3] + [1e9, -1e6, 0.1]).tolist()) for i, v in enumerate(draw.standard_normal((300, 3)))]
    n, dev, white, _ = plain_whitening(rows)
    usable, dims = whitening.usable(frame(spark, rows))
    models = [whitening.fit(usable.repartition(k), dims) for k in (1, 7)]
    assert models[0].trace == models[1].trace and (models[0].vectors == models[1].vectors).all()
    assert models[0].sums == [sum(int(np.floor(1024 * v[j])) + 100000 for _, v in rows) for j in range(3)]
    got = {r.vec_id: r for r in whitening.whiten(usable, dims, models[0]).collect()}
    assert [got[i].deviation for i in range(n)] == dev.tolist()
    table = np.array([got[i].whitened for i in range(n)])
    assert np.abs(table * np.sign((table * white).sum(0)) - white).max() < 1e-8


def test_odd_vectors(spark):
    good = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (None, [0.5, 0.25]), (3, [1e4, -1e4])]
    odd = [(4, None), (5, []), (6, [None, 1.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0]), (9, [1.0]),
           (10, [1e300, 0.0]), (11, [1.0, 2.0, 3.0])]
    n, dev, white, _ = plain_whitening(good)
    got = run(spark, good + odd)
    assert sorted(r.vec_id or 0 for r in got) == [0, 1, 2, 2, 3]
    assert sorted(r.deviation for r in got) == sorted(dev)
    for rows in ([], odd[:5]):
        usable, dims = whitening.usable(frame(spark, rows))
        assert usable.count() == 0 and dims == 0
    assert all(r.whitened == [] for r in run(spark, [(1, [0.5, 0.5])] * 3))        # no variance: no component
    assert len(run(spark, [(1, [0.5, 1.0]), (2, [0.5, 2.0])])[0].whitened) == 1    # one of two dimensions varies


def test_a_deviation_beyond_a_long_is_null(spark):
    got = run(spark, [(i, [2e9 if i % 2 else -2e9]) for i in range(4000)])
    assert {r.deviation for r in got} == {None}
