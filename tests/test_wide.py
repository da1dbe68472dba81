"""Components of very many columns against numpy."""

import numpy as np
import pytest

from caresieve.operators import wide


def plain(x, standardise=True):
    z = x - x.mean(axis=0)
    if standardise:
        d = z.std(axis=0, ddof=1)
        z = np.where(d > 0, z / np.where(d > 0, d, 1), 0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    share = s**2 / (s**2).sum()
    top = np.abs(vt).argmax(axis=1)
    return share, (vt * np.sign(vt[range(len(vt)), top])[:, None]).T


def table(spark, x, parts=6):
    return spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").repartition(parts)


def loadings(df):
    rows = sorted(df.collect(), key=lambda r: r.column)
    assert [r.column for r in rows] == list(range(len(rows)))
    return np.array([r.loading for r in rows])


def data(n, p, seed, rank=4):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, rank)) * np.arange(rank, 0, -1) ** 2 @ rng.normal(size=(rank, p)) + rng.normal(size=(n, p)) * 0.3


@pytest.mark.parametrize("n, p, standardise", [(40, 20_000, True), (30, 700, False), (90, 60, True)])
def test_few_rows_of_many_columns(spark, monkeypatch, n, p, standardise):
    monkeypatch.setattr(wide, "TILE", 16)
    x = data(n, p, n)
    x[:, 5] = 3.0  # a constant column
    got, rows = wide.components(table(spark, x), "v", 0.9, standardise)
    share, want = plain(x, standardise)
    k = int(np.argmax(np.cumsum(share) >= 0.9)) + 1
    assert np.allclose(got.explained[: k + 3], share[: k + 3]) and got.kept == k
    assert np.allclose(loadings(rows), want[:, :k], atol=1e-8)


@pytest.mark.parametrize("standardise", [True, False])
def test_many_rows_are_iterated(spark, monkeypatch, standardise):
    monkeypatch.setattr(wide, "DUAL_ROWS", 50)
    x = data(300, 1200, 9)
    x[:, 7] = -1.0
    got, rows = wide.components(table(spark, x), "v", 0.8, standardise, most=6)
    share, want = plain(x, standardise)
    k = min(6, int(np.argmax(np.cumsum(share) >= 0.8)) + 1)
    assert got.kept == k and np.allclose(got.explained[:k], share[:k], atol=1e-8)
    assert np.allclose(loadings(rows), want[:, :k], atol=1e-6)


def test_rows_that_are_left_out(spark):
    x = data(12, 30, 2)
    rows = [(r.tolist(),) for r in x] + [(None,), ([float("nan")] * 30,), ([None] * 30,), ([float("inf")] + [1.0] * 29,)]
    got, found = wide.components(spark.createDataFrame(rows, "v array<double>"), "v", 1.0)
    assert np.allclose(loadings(found)[:, :3], plain(x)[1][:, :3])
    for bad in ([], [([1.0],)], [([1.0, 2.0],), ([1.0],)]):
        with pytest.raises(ValueError, match="two rows or more"):
            wide.components(spark.createDataFrame(bad, "v array<double>"), "v")
