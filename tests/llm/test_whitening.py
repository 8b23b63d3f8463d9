import math
from fractions import Fraction

import numpy as np
import pytest

from tripleloom.llm import whitening as w

KIND = "vec_id long, embedding array<float>, x int, length string, turn int, n int, total int, salt int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "l", 2, 3, 4, 5) for i, v in rows], KIND)


def slow(rows, components=16):
    """(x by row, n, deviations, whitened, explained) by float64 alone, for vectors of one length."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    x = [(i, tuple(int(math.floor(64 * c)) + 1_000_000 for c in v)) for i, v in good]
    fit = sorted({v for _, v in x})
    n, d = len(fit), len(fit[0])
    total = [sum(v[j] for v in fit) for j in range(d)]
    mean = [Fraction(t, n) for t in total]
    y = np.array([[float(e - m) for e, m in zip(v, mean)] for v in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = [k for k in range(d) if values[k] > 1e-12 * values[0]][:components]
    white = np.array([[float(e - m) for e, m in zip(v, mean)] for _, v in x]) @ vectors[:, kept] / np.sqrt(values[kept])
    deviation = [sum((n * e - t) ** 2 for e, t in zip(v, total)) for _, v in x]
    return [i for i, _ in x], n, deviation, white, values[kept] / values.sum()


def found(frame):
    rows = frame.collect()
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    return rows, by


@pytest.mark.parametrize("size,seed", [(2, 0), (5, 1), (64, 2), (200, 3)])
def test_products_are_exact_beyond_float64(size, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=(size, size)), rng.normal(size=(size, 3)) * np.exp2(rng.integers(-20, 20, 3))
    got = w.product(a.astype(np.longdouble), b.astype(np.longdouble))
    for i, j in [(0, 0), (size - 1, 2), (size // 2, 1)]:
        true = sum(Fraction(a[i, k]) * Fraction(b[k, j]) for k in range(size))
        size_of = sum(abs(Fraction(a[i, k]) * Fraction(b[k, j])) for k in range(size))
        hi = float(got[i, j])
        value = Fraction(hi) + Fraction(float(got[i, j] - np.longdouble(hi)))
        assert abs(value - true) <= size_of * Fraction(1, 2**58)


def residual(a, values, x):
    return float(np.abs(w.product(a.astype(np.longdouble), x.astype(np.longdouble)) - x * values).max())


@pytest.mark.parametrize("spectrum", [
    [5.0, 4.0, 3.0, 2.0, 1.0], [1.0] * 6, [3.0, 1.0, 1.0, 1.0, 0.5, 0.0], [1.0, 1.0 - 1e-9, 1.0 - 2e-9, 0.5, 0.5 + 1e-12],
    list(np.linspace(1, 2, 40)), [1e6, 1.0, 1e-3, 1e-3 * (1 + 1e-7), 1e-6], [7.0], [0.0, 0.0],
])
def test_refined_vectors(spectrum):
    size = len(spectrum)
    q = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    values, x = w.refined(a)
    top = max(map(abs, spectrum)) or 1.0
    assert np.abs(values - np.sort(spectrum)[::-1]).max() <= 1e-14 * top * size
    assert np.abs(x.T @ x - np.eye(size)).max() < 1e-14 and residual(a, values, x) <= 2e-15 * top * max(size, 4)
    reference = np.linalg.eigvalsh(a)[::-1]
    for k in range(size):  # vectors of single eigenvalues are those of float64
        gap = min([abs(reference[k] - reference[j]) for j in range(size) if j != k], default=1.0)
        if gap > 1e-6 * top:
            true = np.linalg.eigh(a)[1][:, ::-1][:, k]
            assert min(np.abs(x[:, k] - true).max(), np.abs(x[:, k] + true).max()) < 1e-14 * top / gap * 10


def test_float32_alone_would_not_do():
    """What the refinement adds: float32's vectors are wrong by a millionfold of float64."""
    rng = np.random.default_rng(5)
    y = rng.normal(size=(500, 64))
    a = y.T @ y / 500
    rough = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(float)
    values, x = w.refined(a)
    assert residual(a, values, rough) > 1e-9 and residual(a, values, x) < 1e-14


def test_given_vectors_against_float64(spark, tiny):
    vectors = spark.read.parquet(f"{tiny}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    ids, n, deviation, white, explained = slow(rows)
    got, by = found(w.whitened(vectors))
    assert len(got) == 16 * len(ids) and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9 and len({r["identity_error"] for r in got}) == 1
    mine = np.array([[by[i][k]["whitened"] for k in range(1, 17)] for i in ids])
    sign = np.sign((mine * white).sum(0))
    assert np.abs(mine * sign - white).max() < 1e-8
    assert [int(by[i][1]["deviation"]) for i in ids] == deviation
    assert np.abs(np.array([by[ids[0]][k]["explained"] for k in range(1, 17)]) / explained - 1).max() < 1e-10


NAN, INF = float("nan"), float("inf")


def test_awkward_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(40, 6)))]
    rows += [(0, rows[0][1]), (None, rows[1][1]), (77, rows[2][1]), (78, rows[2][1])] + [(100 + i, rows[3][1]) for i in range(60)]
    bad = [(900, None), (902, [NAN] * 6), (903, [1.0] * 5 + [INF]), (904, [None] + [1.0] * 5), (905, [1e30] * 6), (906, [])]
    ids, n, deviation, white, explained = slow(rows)
    got, by = found(w.whitened(table(spark, rows + bad)))
    assert n == 40 and len(got) == 6 * len(rows) and set(by) == {i for i, _ in rows}
    mine = np.array([[by[i][k]["whitened"] for k in range(1, 7)] for i in ids])
    sign = np.sign((mine * white).sum(0))
    assert np.abs(mine * sign - white).max() < 1e-9 and got[0]["identity_error"] < 1e-9
    assert sorted(int(r["deviation"]) for r in got if r["component"] == 1) == sorted(deviation)


def test_lengths_are_spaces_of_their_own(spark):
    rng = np.random.default_rng(9)
    parts = [[(100 * d + i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(30, d)))] for d in (2, 3)]
    got, by = found(w.whitened(table(spark, parts[0] + parts[1] + [(999, [1.0])])))
    assert len(got) == 30 * 5 and 999 not in by
    for rows, d in zip(parts, (2, 3)):
        ids, n, deviation, white, _ = slow(rows)
        mine = np.array([[by[i][k]["whitened"] for k in range(1, d + 1)] for i in ids])
        assert np.abs(mine * np.sign((mine * white).sum(0)) - white).max() < 1e-9
        assert [int(by[i][1]["deviation"]) for i in ids] == deviation


def test_flat_directions_have_no_rows(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)]
    got, _ = found(w.whitened(table(spark, rows)))
    assert {r["component"] for r in got} == {1} and len(got) == 10 and abs(got[0]["explained"] - 1) < 1e-12


def test_large_components_stay_exact(spark):
    rows = [(1, [3e15, 1.0]), (2, [-2e15, 5.0]), (3, [7e14, 2.0])]
    _, n, deviation, _, _ = slow(rows)
    got, by = found(w.whitened(table(spark, rows)))
    assert [int(by[i][1]["deviation"]) for i in (1, 2, 3)] == deviation


def test_models_too_large_to_send(spark, monkeypatch):
    rng = np.random.default_rng(10)
    data = table(spark, [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(50, 4)))])
    one, _ = found(w.whitened(data))
    monkeypatch.setattr(w, "SENT", 0)
    monkeypatch.setattr(w, "AT_ONCE", 20)
    two, _ = found(w.whitened(data))
    key = lambda r: (r["vec_id"], r["component"], r["deviation"])
    assert sorted(map(key, one)) == sorted(map(key, two))


def test_nothing(spark):
    assert w.whitened(table(spark, [])).count() == 0 and w.whitened(table(spark, [(1, [1.0, 2.0])])).count() == 0
