import math
import random
from fractions import Fraction

import numpy as np
import pytest

from fogline.llm import queries
from fogline.llm.whitening import covariance, decode, encode, quantise, square_sums, whiten
from tests.conftest import SF

DDL = "vec_id long, embedding array<double>, n string, component string, label string"
INF, NAN = float("inf"), float("nan")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash", None) for i, v in rows], DDL)


def brute(rows, components=4, scale=256):
    """{length: (n, sums, covariance)} and per usable row (vec_id, x), in exact fractions."""
    kept = [(i, tuple(math.floor(Fraction(c) * scale) for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fits = {}
    for d in {len(x) for _, x in kept}:
        fit = sorted({x for _, x in kept if len(x) == d})
        n, sums = len(fit), [sum(x[i] for x in fit) for i in range(d)]
        mean = [Fraction(s, n) for s in sums]
        cov = np.array([[float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in fit) / n) for j in range(d)] for i in range(d)]).reshape(d, d)
        fits[d] = n, sums, cov
    return kept, fits


def check(got, rows, components=4):
    kept, fits = brute(rows, components)
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    want = {}
    for i, x in kept:
        if x:
            n, sums, _ = fits[len(x)]
            want.setdefault((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))), []).append(x)
    assert {(k, int(d)) for k, d in by} == set(want)
    for (i, deviation), xs in want.items():
        listed = by[i, deviation]
        d = len(xs[0])
        n, sums, cov = fits[d]
        values, axes = np.linalg.eigh(cov)
        values, axes = values[::-1], axes[:, ::-1]
        assert sorted(r["component"] for r in listed) == sorted(list(range(1, min(components, d) + 1)) * len(xs))
        assert {r["n"] for r in listed} == {n}
        for r in listed:
            k = r["component"] - 1
            assert r["explained"] == pytest.approx(values[k] / np.trace(cov) if np.trace(cov) else 0, rel=1e-9, abs=1e-12)
            if values[k] > 1e-9:
                mine = (np.array([float(a - Fraction(s, n)) for a, s in zip(xs[0], sums)]) @ axes[:, k]) / np.sqrt(values[k])
                assert abs(r["whitened"]) == pytest.approx(abs(mine), rel=1e-6, abs=1e-8)
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_matches_exact_fractions(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3 / (k + 1)) for k in range(6)]) for i in range(80)]
    rows += [(i, rows[0][1]) for i in range(100, 130)] + [(None, rows[1][1]), (3, rows[3][1])]
    rows += [(200, None), (201, [NAN] * 6), (202, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (203, [INF, 0.0, 0.0, 0.0, 0.0, 0.0]), (204, [-0.0] * 6)]
    check(whiten(frame(spark, rows)).collect(), rows)


def test_lengths_apart_and_degenerate_spaces(spark):
    rows = [(1, [0.5]), (2, [1.5]), (3, [2.0, 2.0]), (4, []), (5, [1.0, 0.0, 0.0]), (6, [0.0, 1.0, 0.0]), (7, [2.0, 2.0])]
    got = whiten(frame(spark, rows)).collect()
    check(got, rows)
    assert all(r["whitened"] == 0 and r["explained"] == 0 for r in got if r["vec_id"] in (3, 7))


def test_large_values_stay_exact(spark):
    rows = [(i, [2.0**40 * (i + 1), float(i % 3), -(2.0**52) * (i % 2), 1e30 if i == 5 else 1.0]) for i in range(12)]
    got = whiten(frame(spark, rows[:5] + rows[6:])).collect()
    check(got, rows[:5] + rows[6:])
    assert whiten(frame(spark, rows)).count() == 48


def test_empty(spark):
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [NAN])])).count() == 0


def test_codes_are_canonical():
    rng = np.random.default_rng(1)
    for bits in (3, 7, 8, 15, 16, 31, 32, 62):
        x = rng.integers(-(1 << bits), 1 << bits, (20, 5))
        codes = encode(x)
        assert sorted(map(tuple, np.concatenate(list(decode(codes))).tolist())) == sorted(map(tuple, x.tolist()))
        assert codes == encode(x.copy())
    assert quantise(np.array([[1e300, -1e300, -0.0, -0.001]]), 256).tolist() == [[2**63 - 1, -(2**63), 0, -1]]


def test_polarisation_is_the_covariance():
    rng = np.random.default_rng(2)
    x = rng.integers(-1000, 1000, (50, 7)) @ rng.integers(-3, 4, (7, 7))
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    flat = square_sums(x - np.array([s // n for s in sums]))
    squares = dict(zip([(i, j) for i in range(7) for j in range(i, 7)], [int(v) for v in flat]))
    assert np.allclose(covariance(n, sums, squares), np.cov(x.T, bias=True), rtol=1e-12, atol=1e-9)


def test_query(spark):
    df = queries.QUERIES["op11_whitening"](spark, SF)
    assert dict(df.dtypes)["deviation"] == "bigint"
    got = df.collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(got, rows)
