"""Densities against the plain sum of all kernels, within the stated error."""

import numpy as np
import pytest

from skygrid.operators import aggregates

CASES = {
    "normal": np.random.default_rng(1).normal(3, 2, 3000),
    "two humps and a far value": np.concatenate([np.random.default_rng(2).normal(0, 0.1, 1500), np.random.default_rng(3).normal(5, 0.1, 1500), [400.0]]),
    "few distinct": np.random.default_rng(4).integers(0, 5, 2000).astype(float),
    "two values": np.array([1.0, 2.0]),
    "large": np.random.default_rng(5).random(500) * 1e12,
}


def plain(x, points=200):
    h = x.std(ddof=1) * len(x) ** -0.2
    at = np.linspace(x.min(), x.max(), points)
    return h, at, np.exp(-0.5 * ((at[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))


@pytest.mark.parametrize("case", CASES)
def test_within_the_stated_error(spark, case):
    x = CASES[case]
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(3)
    rows = sorted(aggregates.density(df, ["v"]).collect(), key=lambda r: r.i)
    h, at, want = plain(x)
    assert np.allclose([r["at"] for r in rows], at)
    assert np.abs(np.array([r.density for r in rows]) - want).max() < 1.3e-9 / (h * np.sqrt(2 * np.pi))


def test_classes_and_empty_groups(spark):
    rows = [(1, 1.0, None), (1, 2.0, None), (1, 4.0, 3.0), (0, 5.0, float("nan")), (None, 1.0, 1.0), (None, 3.0, 1.0), (0, None, 2.0)]
    found = aggregates.density(spark.createDataFrame(rows, "c int, a double, b double"), ["a", "b"], ["c"], points=5).collect()
    assert {(r.c, r.feature) for r in found} == {(1, "a"), (None, "a")} and len(found) == 10
    _, _, want = plain(np.array([1.0, 2.0, 4.0]), 5)
    assert [r.density for r in sorted(found, key=lambda r: r.i) if r.c == 1] == pytest.approx(want.tolist(), rel=1e-8)
    assert aggregates.density(spark.createDataFrame([], "a double"), ["a"]).count() == 0


def test_no_python(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    plan = aggregates.density(df, ["v"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
