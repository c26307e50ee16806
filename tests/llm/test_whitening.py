import math
from decimal import Decimal

import numpy as np
import pytest

from tellstar.llm import whitening
from tellstar.llm.queries import op11_whitening

SF = "/root/testdata/sf0.001"


def usable(rows):
    return [(i, e) for i, e in rows if e and all(x is not None and abs(x) < 2.0 ** 50 for x in e)]


def brute(rows, components=8):
    """(vec_id, component) -> row, by plain integers and LAPACK's eigenvectors."""
    rows = usable(rows)
    x = [[math.floor(1024 * float(c)) + 100000 for c in e] for _, e in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    out = {}
    for (i, _), row, c in zip(rows, x, centred):
        off = sum((n * a - s) ** 2 for a, s in zip(row, sums))
        for k, j in enumerate(order):
            out[i, k + 1] = (n, off, float(c @ vectors[:, j]) / math.sqrt(values[j]), values[j] / np.trace(v))
    return out


def compared(got, want):
    assert len(got) == len(want)
    signs = {}
    for r in got:
        n, off, value, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation, r.deviation_exact) == (n, off, Decimal(off))
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert 0 <= r.identity_error < 1e-8
        sign = signs.setdefault(r.component, 1 if r.whitened * value > 0 else -1)
        assert r.whitened == pytest.approx(sign * value, abs=1e-8)
    assert len({r.identity_error for r in got}) == 1


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compared(op11_whitening(spark, SF).collect(), brute(rows))


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * [1, 5, 2, 3] + 7).tolist()) for i in range(60)] + [(60 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [1.0, float("nan"), 0.0, 1.0]), (204, [float("inf"), 0.0, 0.0, 0.0]), (205, [1e307, 1.0, 0.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 1.0) for i, v in rows + odd], "vec_id long, embedding array<double>, whitened double").repartition(3)
    compared(whitening.whitened(frame).collect(), brute(rows))
    assert whitening.whitened(frame.limit(0)).count() == 0
    # other lengths among themselves; no variance, no component; repeated and null ids are rows
    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (1, [2.0, 1.0]), (None, [0.0, 0.5]), (4, [5.0]), (5, [5.0]), (6, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>")
    got = whitening.whitened(mixed).collect()
    assert sorted(r.n for r in got) == [3] * 6 and sorted((r.vec_id is None) for r in got) == [False] * 4 + [True] * 2
    # a deviation that no long holds
    far = spark.createDataFrame([(1, [1e14, 0.0]), (2, [0.0, 1.0]), (3, [-1e14, 3.0])], "vec_id long, embedding array<double>")
    rows = {r.vec_id: r for r in whitening.whitened(far).where("component = 1").collect()}
    x = {i: [math.floor(1024 * a) + 100000 for a in v] for i, v in ((1, [1e14, 0]), (2, [0, 1]), (3, [-1e14, 3]))}
    sums = [sum(c) for c in zip(*x.values())]
    for i, row in rows.items():
        off = sum((3 * a - s) ** 2 for a, s in zip(x[i], sums))
        assert row.deviation_exact == Decimal(off) and row.deviation == (off if off < 1 << 63 else None)


@pytest.mark.parametrize("values", [range(1, 40), [1e-9] * 3 + [5.0] * 4 + [5.0 + 1e-13] + [1e6], [2.0] * 6, [0.0] * 5, [0.0] * 4 + [1.0], np.geomspace(1e-14, 1, 25), [-3.0, 0.0, 3.0]])
def test_spectral_divide_and_conquer(values):
    values = np.array(list(values), float)
    q, _ = np.linalg.qr(np.random.default_rng(len(values)).normal(size=(len(values), len(values))))
    h = (q * values) @ q.T
    h = (h + h.T) / 2
    top = np.sort(values)[::-1]
    for most in (3, len(values)):
        got, basis = whitening.eigenvectors(h, most)
        size = np.abs(values).max() + 1e-300
        assert np.allclose(got, top[:most], rtol=0, atol=1e-13 * size * len(values))
        assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), rtol=0, atol=1e-13 * len(values))
        assert np.abs(h @ basis - basis * got).max() <= 1e-13 * size * len(values)


def test_polar_sign():
    a = np.random.default_rng(1).normal(size=(30, 30))
    h = a + a.T
    values, vectors = np.linalg.eigh(h)
    assert np.abs(whitening.polar_sign(h) - (vectors * np.sign(values)) @ vectors.T).max() < 1e-12
