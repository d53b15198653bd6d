"""Whitening against NumPy's dense eigensolver."""

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from songweave.llm import queries, whiten  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, component int, x int, part int, n string"


def scatter(x):
    return (x - x.mean(0)).T @ (x - x.mean(0))


def walked(x):
    found = whiten.Spectrum.empty(x.shape[1])
    for row in x:
        found.add(row)
    return found


def check(found, x):
    want = scatter(x)
    size = max(np.abs(want).max(), 1e-300)
    assert np.abs(found.basis.T @ found.basis - np.eye(x.shape[1])).max() < 1e-11
    assert np.abs(found.basis * found.values @ found.basis.T - want).max() < 1e-11 * size
    assert (np.diff(found.values) >= 0).all()


@pytest.mark.parametrize("kind", ["plain", "scaled", "few", "copies", "flat", "tiny", "steps"])
def test_updates_and_merges_equal_the_scatter(kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 12))
    if kind == "scaled":
        x *= 10.0 ** np.arange(-6, 6)
    elif kind == "few":
        x = x[:5]
    elif kind == "copies":
        x[20:120] = x[3]
    elif kind == "flat":
        x[:, 4:9] = 2.0
    elif kind == "tiny":
        x *= 1e-30
    elif kind == "steps":
        x = np.round(x)
    check(walked(x), x)
    cut = len(x) // 3
    both = walked(x[:cut])
    both.merge(walked(x[cut:]))
    check(both, x)
    assert both.n == len(x)


def test_roots_lie_between_poles():
    rng = np.random.default_rng(6)
    poles = np.sort(rng.normal(size=40)) * 10.0 ** rng.integers(-3, 3, 40)
    poles = np.unique(poles)
    squares = 10.0 ** rng.uniform(-12, 2, len(poles))
    origin, x = whiten.secular_roots(poles, squares)
    roots = poles[origin] + x
    assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all()
    want = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(squares), np.sqrt(squares)))
    assert np.abs(np.sort(roots) - want).max() < 1e-12 * np.abs(want).max()


def ran(spark, rows, monkeypatch):
    frame = spark.createDataFrame([(*r, 1, 2, 3, "n") for r in rows], SCHEMA).repartition(5)
    monkeypatch.setattr(queries.common, "read_table", lambda *_: frame)
    return queries.op12_whitening(spark, "").toPandas()


def against_numpy(got, rows, width):
    rows = [(i, v) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    x = np.stack([np.floor(64 * np.array(v, np.float32).astype(float)) for _, v in rows])
    x = x.astype(np.int64) + 1_000_000
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(0)
    values, basis = np.linalg.eigh(scatter(fitted) / n)
    values, basis = values[::-1], basis[:, ::-1]
    on = (x - sums / n) @ basis[:, :width] / np.sqrt(values[:width])
    assert len(got) == len(x) * width
    got = got.sort_values(["component", "deviation", "whitened"])
    for j in range(width):
        mine = got[got.component == j + 1]
        assert np.allclose(np.sort(np.abs(mine.whitened)), np.sort(np.abs(on[:, j])), atol=1e-8)
        assert np.allclose(mine.explained, values[j] / values.sum(), rtol=1e-9)
    assert (got.n == n).all() and got.identity_error.max() < 1e-9
    exact = sorted(((n * x - sums) ** 2).sum(1).tolist())
    assert sorted(got[got.component == 1].deviation.tolist()) == exact


def test_whitening_with_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=20).astype("f4").tolist()) for i in range(90)]
    rows += [(i, rows[0][1]) for i in range(100, 160)]  # a third are copies
    rows += [(None, rows[1][1]), (5, rows[2][1])]
    odd = [[float("nan")] + [1.0] * 19, [None] + [1.0] * 19, [float("-inf")] * 20, None, []]
    rows += [(200 + i, v) for i, v in enumerate(odd)]
    against_numpy(ran(spark, rows, monkeypatch), rows, 16)
    # Another length and components without an exact integer take no part.
    more = rows + [(300, [1.0] * 7), (301, [1e30] * 20)]
    against_numpy(ran(spark, more, monkeypatch), rows, 16)


def test_fewer_dimensions_than_components(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=3).astype("f4").tolist()) for i in range(40)]
    against_numpy(ran(spark, rows, monkeypatch), rows, 3)


def test_no_variance_and_nothing(spark, monkeypatch):
    got = ran(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])], monkeypatch)
    assert len(got) == 4 and set(got.n) == {1} and set(got.deviation) == {0}
    assert got.whitened.isna().all() and got.explained.isna().all() and got.identity_error.isna().all()
    assert len(ran(spark, [(1, None), (2, [])], monkeypatch)) == 0
    # One direction only: the others have a share of nothing.
    got = ran(spark, [(i, [float(i), 1.0]) for i in range(9)], monkeypatch)
    assert got[got.component == 1].whitened.notna().all()
    assert got[got.component == 2].whitened.isna().all()


def test_deviations_are_exact_beyond_64_bits():
    x = np.array([[2**57, 0], [0, 0]])
    sums = x.sum(0).tolist()
    whole, over = whiten._shift(sums, 2)
    assert whiten.deviations(x, whole, over, 2) == [None, None]
    x = np.array([[2**31 + 5, 3], [0, 0]])
    sums = x.sum(0).tolist()
    whole, over = whiten._shift(sums, 2)
    want = [sum((2 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    assert whiten.deviations(x, whole, over, 2) == want
