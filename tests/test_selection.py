"""Order statistics against sorting."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skygrid.operators import selection

PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75, "low": 0.0, "high": 1.0}


def sorted_quantiles(values):
    values = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    out = {"n": len(values)}
    for name, p in PROBS.items():
        at = p * (len(values) - 1)
        a, b = values[math.floor(at)], values[math.ceil(at)]
        out[name] = a if a == b or at == math.floor(at) else a + (b - a) * (at - math.floor(at))
    return out


def same(a, b):
    return a.keys() == b.keys() and all(x == y or (math.isnan(x) and math.isnan(y)) for x, y in zip(a.values(), (b[k] for k in a)))


CASES = {
    "even": np.random.default_rng(1).random(5000).tolist(),
    "one value holds a third": np.random.default_rng(2).choice([0.0, 1.5, *np.linspace(3, 9, 40)], 4000, p=[1 / 3, 0.1, *[(1 - 1 / 3 - 0.1) / 40] * 40]).tolist(),
    "far outliers": [*np.random.default_rng(3).normal(size=999).tolist(), 1e300, -1e300],
    "all magnitudes": np.exp(np.random.default_rng(4).uniform(-300, 300, 500)).tolist(),
    "widest range": [-1.7e308, 1.7e308, 0.0, 1.0, 2.0],
    "smallest steps": [0.0, 5e-324, 1e-323, 1.5e-323],
    "infinite": [float("-inf")] * 3 + [1.0, 2.0] + [float("inf")] * 3 + [float("nan")] * 2,
    "nulls": [None, 3.0, None, 1.0],
    "one": [7.0],
    "same": [2.0] * 100,
    "signed zeros": [0.0, -0.0, 0.0],
}


@pytest.mark.parametrize("case", CASES)
def test_quantiles_are_those_of_sorted_values(spark, case):
    df = spark.createDataFrame([(v,) for v in CASES[case]], "x double").repartition(3)
    assert same(selection.quantile_values(df, ["x"], PROBS)[("x",)], sorted_quantiles(CASES[case]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_subnormal=True), min_size=1, max_size=30))
def test_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    wanted = order = selection.order_statistics(df, ["x"], lambda n: range(n))[("x",)]
    want = sorted(values, key=lambda v: (math.isnan(v), v))
    assert order["n"] == len(values)
    assert all(wanted[i] == v or math.isnan(wanted[i]) and math.isnan(v) for i, v in enumerate(want))


def test_groups_and_features(spark):
    rng = np.random.default_rng(5)
    rows = [(int(c) if c < 2 else None, float(a), float(b) if b > 0.1 else None) for c, a, b in zip(rng.integers(0, 3, 900), rng.random(900), rng.random(900))]
    df = spark.createDataFrame(rows, "c int, a double, b double").repartition(4)
    found = selection.quantile_values(df, ["a", "b"], PROBS, ["c"])
    assert set(found) == {(c, f) for c in (0, 1, None) for f in "ab"}
    for (c, f), q in found.items():
        assert same(q, sorted_quantiles([r["ab".index(f) + 1] for r in rows if r[0] == c]))


def test_no_values(spark):
    assert selection.quantile_values(spark.createDataFrame([], "x double"), ["x"], PROBS) == {}
    assert selection.quantiles(spark.createDataFrame([(None,)], "x double"), ["x"], PROBS).count() == 0


def test_a_pass_shuffles_bins_and_not_values(spark):
    """At most BINS rows per open bin and task, for ten times the rows too."""
    for n in (20_000, 200_000):
        df = spark.range(0, n, 1, 4).select((F.rand(3) * 1e6).alias("x"))
        x, number = [F.col("x")], [F.lit(True)]
        open_bin = selection._Open((), 0, 0.0, 1e6, [n // 2], 0)
        assert len(selection._refined(df, [], x, number, [open_bin])) == 1
        plan = df.select(open_bin.bin(F.col("x")).alias("bin")).groupBy("bin").count()
        assert plan.count() <= selection.BINS
