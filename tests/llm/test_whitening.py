import math
import random

import numpy as np
import pytest

from pulsewatch.llm import qdwh
from pulsewatch.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, VEC_ID string, n int, x string"


def spread(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    [5.0, 3.0, 1.0, 0.5], list(np.linspace(1, 2, 64)), [1e6] + [1.0] * 20 + [1e-9] * 5, list(2.0 ** -np.arange(40)), [3.0] * 6, [2.0, 2.0, 1.0, 1.0, 0.0, 0.0],
    [1.0], [4.0, -1.0, 0.0]])
def test_splitting_equals_a_direct_solution(values):
    a = spread(values)
    want = np.sort(values)[::-1]
    got, vectors = qdwh.components(a, len(values))
    assert np.allclose(got, want, atol=1e-13 * max(np.abs(values)), rtol=0)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * got) < 1e-13 * np.linalg.norm(a) * len(values)


def test_only_the_leading_subspaces_are_split():
    a = spread(list(np.linspace(1, 100, 80)))
    values, vectors = qdwh.components(a, 5)
    assert vectors.shape == (80, 5) and np.allclose(values, np.linspace(1, 100, 80)[::-1][:5], atol=1e-11)


def test_polar_factor_has_the_signs():
    a = spread([3.0, 1e-3, 1e-12, -1e-9, -2.0])
    u = qdwh.polar(a)
    assert np.abs(u @ u - np.eye(5)).max() < 1e-13 and round(np.trace(u)) == 1


def brute(rows, count=16):
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v, *_ in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(x) for _, x in good)
    good = [(i, x + [1_000_000] * (width - len(x))) for i, x in good]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(count, int((values > 1e-11 * values.sum()).sum()))
    out = []
    for i, x in good:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        y = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(np.maximum(values, 1e-300))
        out += [(i, c + 1, n, deviation, abs(y[c]), values[c] / values.sum()) for c in range(k)]
    return out


def vectors(width=20, n=300):
    r = np.random.default_rng(4)
    scale = 1.5 ** -np.arange(width)
    return [(i, [float(v) for v in np.float32(r.standard_normal(width) * scale)], "c", 1, "t") for i in range(n)]


def check(spark, rows, count=16):
    got = [tuple(r) for r in W.whitened(spark.createDataFrame(rows, SCHEMA), count).collect()]
    want = brute(rows, count)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], abs(r[4]))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:4] == w[:4]
        assert abs(g[4]) == pytest.approx(w[4], abs=1e-8) and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] < 1e-8
    return got


def test_equals_plain_whitening_with_odd_rows(spark):
    rows = vectors()
    rows += [(900, None, "c", 1, "t"), (901, [1.0, None], "c", 1, "t"), (902, [float("nan")] * 20, "c", 1, "t"), (903, [float("inf")] + [0.0] * 19, "c", 1, "t"),
             (904, [0.3, 0.2], "c", 1, "t"), (905, [], "c", 1, "t"), (None, rows[0][1], "c", 1, "t"), (5, rows[5][1], "c", 1, "t")] + [(906 + k, rows[7][1], "c", 1, "t") for k in range(100)]
    got = check(spark, rows)
    signs = {r[1]: np.sign(r[4]) for r in got if r[0] == 7}
    assert all(np.sign(r[4]) == signs[r[1]] for r in got if r[0] is not None and r[0] >= 906)
    check(spark, rows, count=3)


def test_narrow_vectors_and_rank(spark):
    check(spark, vectors(width=3))
    check(spark, vectors(width=20, n=5))       # four directions only


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(random.Random(i).randrange(1 << 20)), float(i)], "c", 1, "t") for i in range(50)]
    check(spark, rows)
    found = W.whitened(spark.createDataFrame([(1, [1e30, 0.0], "c", 1, "t"), (2, [0.0, 1.0], "c", 1, "t")], SCHEMA)).collect()
    assert {r["vec_id"] for r in found} == {1, 2} and all(r["deviation"] is None for r in found)


def test_nothing_to_whiten(spark):
    assert W.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert W.whitened(spark.createDataFrame(vectors(n=1) * 3, SCHEMA)).collect() == []
    df = W.whitened(spark.createDataFrame([(1, None, "c", 1, "t"), (2, [], "c", 1, "t")], SCHEMA))
    assert df.collect() == [] and df.columns[0] == "vec_id"
