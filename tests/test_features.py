from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skygrid.functions import constants as K
from skygrid.operators import features as M
from skygrid.plans.dataset import FIXED_SHAPING

RAW = """Forecast_Time string, Latitude double, Longitude double, Temperature double, Humidity double,
Wind_Speed double, Cloud_Cover double, Pressure double, Rain int"""
ROWS = [
    ("2026-05-28T07:00", -6.2427, 106.5173, 25.5, 80.0, 5.0, 10.0, 1008.2, 0),
    ("2026-05-28T08:00", -6.3407, 106.7371, 26.0, 78.0, 6.2, 20.0, 1007.9, 0),
    ("2026-05-28T09:00", -6.2226, 106.6533, 24.8, 85.0, 4.8, 95.0, 1008.5, 1),
]


def yj(x, p):
    x = np.asarray(x, dtype=float)
    up = np.log1p(np.maximum(x, 0)) if p == 0 else ((np.maximum(x, 0) + 1) ** p - 1) / p
    low = np.minimum(x, 0)
    down = -np.log1p(-low) if p == 2 else -(((1 - low) ** (2 - p)) - 1) / (2 - p)
    return np.where(x >= 0, up, down)


def loglik(x, p):
    return -len(x) / 2 * np.log(yj(x, p).var()) + (p - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))


def test_serving_features(spark):
    out = M.serving_features(spark.createDataFrame(ROWS, RAW), FIXED_SHAPING)
    assert out.columns == K.SERVING_COLUMNS and len(out.columns) == 16
    rows = out.orderBy("Timestamp").collect()
    assert [r.Hour for r in rows] == [0, 1, 2]
    assert [r.Month for r in rows] == [5, 5, 5]
    assert [r.Location_Encoded for r in rows] == [4, 7, 0]
    assert rows[0].hour_sin == pytest.approx(0) and rows[0].hour_cos == pytest.approx(1)


def test_serving_features_skip_absent_columns(spark):
    raw = spark.createDataFrame(ROWS, RAW).drop("Rain").withColumnRenamed("Forecast_Time", "time")
    assert "Rain" not in M.serving_features(raw, FIXED_SHAPING).columns


def test_features_need_no_shuffle_and_no_python(spark, small):
    from skygrid.plans.dataset import obs

    raw = obs(spark, small).withColumnRenamed("Fetch_Time", "Forecast_Time")
    plan = M.serving_features(raw, FIXED_SHAPING)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_training_features_keep_local_hours_when_asked(spark):
    raw = spark.createDataFrame(ROWS, RAW).withColumn("Fetch_Time", F.col("Forecast_Time").cast("timestamp"))
    out = M.training_features(raw, FIXED_SHAPING, offset_hours=0)
    assert out.columns == K.TRAINING_COLUMNS
    rows = out.orderBy("Timestamp").collect()
    assert [r.Hour for r in rows] == [7, 8, 9]
    assert rows[0].Timestamp == "2026-05-28 07:00:00" and rows[0].Location == "Cikupa"


def test_training_window_includes_its_edge(spark):
    raw = spark.createDataFrame(
        [(datetime(2026, 5, d, h), *ROWS[0][1:]) for d, h in ((28, 7), (21, 7), (21, 6))],
        RAW.replace("Forecast_Time string", "Fetch_Time timestamp"),
    )
    out = M.training_features(raw, FIXED_SHAPING).select("Timestamp").collect()
    assert sorted(r.Timestamp for r in out) == ["2026-05-21 07:00:00", "2026-05-28 07:00:00"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-50, 50), min_size=1, max_size=20), st.sampled_from([-1.5, 0.0, 0.5, 1.0, 2.0, 3.5]))
def test_power_matches_and_is_monotone(spark, values, power):
    values = sorted(values)
    df = spark.createDataFrame([(i, v, power) for i, v in enumerate(values)], "i int, x double, p double")
    rows = df.select("i", M.powered(F.col("x"), power).alias("a"), M.powered(F.col("x"), F.col("p")).alias("b")).orderBy("i").collect()
    assert [r.a for r in rows] == pytest.approx(list(yj(values, power)), rel=1e-9, abs=1e-9)
    assert [r.a for r in rows] == [r.b for r in rows]
    assert all(x.a <= y.a + 1e-12 for x, y in zip(rows, rows[1:]))


def test_power_fit_finds_the_likeliest(spark):
    rng = np.random.default_rng(3)
    columns = {"Temperature": rng.normal(25, 1, 3000), "Wind_Speed": rng.lognormal(1, 0.8, 3000), "Humidity": 100 - rng.lognormal(2, 0.6, 3000)}
    names = list(columns)
    rows = [tuple(map(float, r)) for r in np.column_stack([columns[n] for n in names])]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    fit = M.fit_shaping(df, names)
    for name, x in columns.items():
        s = fit[name]
        assert (s.mean, s.std) == pytest.approx((x.mean(), x.std()))
        z = (x - x.mean()) / x.std()
        best = max(np.arange(s.power - 0.05, s.power + 0.05, 0.0005), key=lambda p: loglik(z, p))
        assert s.power == pytest.approx(best, abs=1e-3)
        grid = max(np.arange(-4, 6, 0.05), key=lambda p: loglik(z, p))
        assert s.power == pytest.approx(grid, abs=0.06)
        t = yj(z, s.power)
        assert (s.out_mean, s.out_std) == pytest.approx((t.mean(), t.std()), abs=1e-6)
    again = M.load_shaping(M.shaping_table(spark, fit))
    assert again == fit


def test_constant_column_has_scale_one(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "Pressure double")
    row = M.fit_scale(df, ["Pressure"]).first()
    assert (row["mean"], row["std"]) == (3.0, 1.0)


def test_label_codes_follow_the_alphabet(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "name string")
    assert {r.name: r.code for r in M.label_codes(df, "name").collect()} == {"a": 0, "b": 1, "c": 2}
