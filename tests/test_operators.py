from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.functions import scalars as S
from skygrid.operators import aggregates, attribution, blending, dedup, filters, geo, joins, metrics, payload

T0 = datetime(2026, 5, 1)


def hours(n):
    return T0 + timedelta(hours=n)


# ---- filters ---------------------------------------------------------------
def test_window_edges_are_kept(spark):
    df = spark.createDataFrame([(hours(h),) for h in (0, 1, 48, 49)], "t timestamp")
    kept = filters.newest_window(df, "t", hours=48).collect()
    assert sorted(r.t for r in kept) == [hours(1), hours(48), hours(49)]


def test_window_is_a_subquery_not_a_window_function(spark):
    df = spark.createDataFrame([(hours(0),)], "t timestamp")
    plan = filters.newest_window(df, "t", hours=48)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "Window" not in plan and "CartesianProduct" not in plan


def test_drop_oldest_keeps_the_cut(spark):
    df = spark.createDataFrame([(T0 + timedelta(days=d),) for d in (0, 6, 7, 8)], "t timestamp")
    assert filters.drop_oldest(df, "t", days=7).count() == 2


@pytest.mark.parametrize(
    "now, past, coming",
    [
        (datetime(2026, 5, 1, 12, 30), [10, 11], [13, 14]),
        (datetime(2026, 5, 1, 12, 0), [10, 11], [12, 13, 14]),
        (datetime(2026, 5, 1, 12, 0, 5), [10, 11], [13, 14]),
    ],
)
def test_past_and_coming_hours(spark, now, past, coming):
    df = spark.createDataFrame([(hours(h),) for h in range(10, 15)], "t timestamp")
    assert sorted(r.t.hour for r in filters.past_hours(df, "t", now).collect()) == past
    assert sorted(r.t.hour for r in filters.coming_hours(df, "t", now).collect()) == coming


# ---- deduplication ---------------------------------------------------------
OBS = "Timestamp timestamp, Latitude double, Longitude double, Rain int, seq int"


def test_keep_last_prefers_new_then_late(spark):
    old = spark.createDataFrame([(hours(200), 1.0, 2.0, 0, 1), (hours(200), 1.0, 2.0, 1, 2), (hours(0), 1.0, 2.0, 0, 3)], OBS)
    new = spark.createDataFrame([(hours(200), 1.0, 2.0, 7, 0)], OBS)
    rows = dedup.sliding_window(old, new).collect()
    assert [(r.Timestamp, r.Rain) for r in rows] == [(hours(200), 7)]
    rows = dedup.sliding_window(old, None).collect()
    assert [(r.Timestamp, r.Rain) for r in rows] == [(hours(200), 1)]


def test_keep_last_twice_is_the_same(spark):
    df = spark.createDataFrame([(hours(h % 5), 1.0, float(h % 3), h % 2, h) for h in range(40)], OBS)
    once = dedup.keep_last(df, ["Timestamp", "Latitude", "Longitude"], ["seq"])
    twice = dedup.keep_last(once, ["Timestamp", "Latitude", "Longitude"], ["seq"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == 15


def test_keep_last_folds_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as seq", "id * 2 as v")
    plan = dedup.keep_last(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


# ---- joins -----------------------------------------------------------------
def test_match_counts_equal_the_joined_pairs(spark):
    f = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (2, 1)], "k int, predicted_rain int")
    o = spark.createDataFrame([(1, 1)] * 5 + [(2, 0), (3, 1)], "k int, Rain int")
    pairs = joins.match(f, o, ["k"])
    counted = joins.match_counts(f, o, ["predicted_rain"], ["Rain"], ["k"])
    assert metrics.confusion(pairs).first() == metrics.confusion(counted, weight="weight").first()
    assert counted.agg(F.sum("weight")).first()[0] == pairs.count() == 16


def test_empty_match_gives_zero_counts(spark):
    f = spark.createDataFrame([(1, 0)], "k int, predicted_rain int")
    o = spark.createDataFrame([(2, 1)], "k int, Rain int")
    row = metrics.scores(metrics.confusion(joins.match_counts(f, o, ["predicted_rain"], ["Rain"], ["k"]), weight="weight")).first()
    assert (row.tp, row.fp, row.fn, row.tn, row.f1) == (0, 0, 0, 0, 0.0)


def cycle(spark, n_forecasts, n_observed):
    """One cell, hourly observations; each forecast covers every hour and predicts its own number."""
    every = [hours(h) for h in range(n_observed)]
    f = spark.createDataFrame(
        [(f"2026050{i // 4 + 1}_{i % 4 * 6:02d}00", t, 1.0, 2.0, i) for i in range(n_forecasts) for t in every],
        "snapshot_id string, Forecast_Target_Time timestamp, Latitude double, Longitude double, predicted_rain int",
    )
    o = spark.createDataFrame(
        [(t.strftime("%Y%m%d_%H%M"), t + timedelta(minutes=7), 1.0, 2.0, 1) for t in every],
        "snapshot_id string, Fetch_Time timestamp, Latitude double, Longitude double, Rain int",
    )
    return joins.cycle_pairs(f, o)


def test_cycle_blocks(spark):
    f, o = cycle(spark, 6, 27)
    rows = joins.match(f, o, ["q", *joins.CELL_HOUR]).orderBy("dt").collect()
    assert [r.dt for r in rows] == [hours(h) for h in range(3, 27)]
    # Of 6 forecasts the newest 5 are 1..5; the newest is left out.
    assert [r.predicted_rain for r in rows] == [1] * 6 + [2] * 6 + [3] * 6 + [4] * 6


@pytest.mark.parametrize("forecasts, observed", [(4, 30), (6, 24)])
def test_cycle_needs_enough_snapshots(spark, forecasts, observed):
    f, o = cycle(spark, forecasts, observed)
    assert joins.match(f, o, ["q", *joins.CELL_HOUR]).isEmpty()


def test_as_of_over_pieces_and_ties(spark):
    right = spark.createDataFrame([("a", hours(1), 1), ("a", hours(30), 2), ("b", hours(5), 3), ("a", hours(30), 9)], "k string, issued timestamp, v int")
    left = spark.createDataFrame([(1, "a", hours(0)), (2, "a", hours(1)), (3, "a", hours(29)), (4, "a", hours(30)), (5, "a", hours(100)), (6, "b", hours(90)), (7, "c", hours(9)), (8, "a", hours(100))], "id int, k string, t timestamp")
    found = joins.as_of(left, right, ["k"], "t", "issued", ["v"])
    assert {r.id: r.v for r in found.collect()} == {2: 1, 3: 1, 4: 9, 5: 9, 6: 3, 8: 9}


# ---- aggregates ------------------------------------------------------------
def test_box_and_outliers(spark):
    values = [*range(1, 10), 100]
    df = spark.createDataFrame([(float(v), 0) for v in values], "v double, Rain int")
    box = aggregates.box_stats(df, ["v"]).first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert (box.q1, box.q3, box.whisker_low, box.whisker_high, box.outside) == (q1, q3, 1.0, 9.0, 1)
    row = aggregates.outliers(df, ["v"]).first()
    assert (row["count"], row["percentage"]) == (1, 10.0)


def test_band_encloses_the_mean_and_is_repeatable(spark):
    df = spark.createDataFrame([(h % 2, int(h % 3 == 0)) for h in range(300)], "h int, Rain int")
    one = aggregates.rate_with_band(df, F.col("h"), "hour").orderBy("hour").collect()
    assert one == aggregates.rate_with_band(df, F.col("h"), "hour").orderBy("hour").collect()
    for r in one:
        assert r.low <= r.mean <= r.high
        half = 1.96 * (r.mean * (1 - r.mean) / 150) ** 0.5
        assert r.high - r.low == pytest.approx(2 * half, rel=0.2)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,)] * 3, "v double")
    rows = aggregates.histogram(df, ["v"], bins=4).orderBy("bin").collect()
    assert [r.n for r in rows] == [3, 0, 0, 0]


def test_one_row_has_no_deviation(spark):
    row = aggregates.feature_stats(spark.createDataFrame([(1.25,)], "Temperature double"), ["Temperature"]).first()
    assert (row["mean"], row["std"], row["median"], row["unit"]) == (1.25, None, 1.25, "°C")


# ---- payload ---------------------------------------------------------------
def test_payload_points(spark):
    cell = geo.clip(geo.grid(spark)).first()
    fields = "Fetch_Time timestamp, Latitude double, Longitude double, Temperature double, Humidity double, Wind_Speed double, Cloud_Cover double, Pressure double, Rain int, seq int"
    at = (hours(1), cell.Latitude, cell.Longitude)
    rows = [
        (*at, 25.0, float("nan"), 1.0, 50.0, 1000.0, 0, 1),
        (*at, 26.0, None, 1.0, 50.0, 1000.0, None, 2),  # same place and time: both stay
        (hours(1), cell.Latitude + 0.001, cell.Longitude, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 3),  # off the grid
        (hours(1), -6.0, 106.33, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 4),  # outside the border
    ]
    flat = payload.map_points(spark.createDataFrame(rows, fields))
    found = payload.nested(flat).collect()
    assert len(found) == 1 and found[0].timestamp == "2026-05-01 01:00:00" and found[0].chunk == 0
    shown = sorted((p.temperature, p.humidity, p.rain_label) for p in found[0].points)
    assert shown == [(1.0, 1.0, 1), (25.0, None, 0), (26.0, None, None)]
    chunks = payload.nested(flat, 1).collect()
    assert sorted(p.temperature for c in chunks for p in c.points) == [1.0, 25.0, 26.0]
    assert len({c.chunk for c in chunks}) == 3 and all(len(c.points) == 1 for c in chunks)


def test_headline_of_nothing(spark):
    empty = spark.createDataFrame([], "l int, c double, t double, h double")
    assert tuple(geo.headline(empty, "l", "c", "t", "h").first()) == (0, 0, 0.0, 0.0)


# ---- blending and attribution ----------------------------------------------
def test_blend_search_is_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.random((200, 3))
    y = (x @ [0.5, 0.2, 0.3] + rng.normal(0, 0.1, 200) > 0.5).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], "a double, b double, c double, Rain int")
    best = blending.best_blend(blending.search_blend(df, ["a", "b", "c"], points=21)).first()
    top = 0.0
    grid = [(i / 20, (1 - i / 20) * j / 20) for i in range(21) for j in range(21)]
    for w in [(a, b, 1 - a - b) for a, b in grid]:
        said = (x[:, 0] * w[0] + x[:, 1] * w[1]) + x[:, 2] * w[2] >= 0.5
        tp = int((said & (y == 1)).sum())
        f1 = 2 * tp / (said.sum() + y.sum()) if tp else 0.0
        if f1 > top:
            top, at = f1, w
    assert best.f1 == pytest.approx(top)
    assert (best.w_0, best.w_1, best.w_2) == pytest.approx(tuple(at))


def test_attribution_of_a_linear_score(spark):
    names = ["a", "b", "c", "d", "e"]
    weights = [1.0, -2.0, 0.5, 0.0, 3.0]
    fields = ", ".join(f"{n} double" for n in names)
    rng = np.random.default_rng(7)
    x, centres, share = rng.random((4, 5)), rng.random((6, 5)), rng.random(6)
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], f"row_id int, {fields}")
    back = spark.createDataFrame([(float(s), *map(float, c)) for s, c in zip(share, centres)], f"weight double, {fields}")

    def score(df):
        return df.withColumn("prob", sum((F.col(n) * w for n, w in zip(names, weights)), F.lit(0.0)))

    found = attribution.attribute(rows, back, score, features=names, n=20).collect()
    middle = np.average(centres, axis=0, weights=share)
    for r in found:
        i = names.index(r.feature)
        assert r.phi == pytest.approx(weights[i] * (x[r.row_id, i] - middle[i]), abs=1e-9)
    for i in range(4):
        mine = [r for r in found if r.row_id == i]
        assert sum(r.phi for r in mine) == pytest.approx(mine[0].fx - mine[0].base)


def test_coalitions_fill_outer_sizes_first():
    pairs = attribution.coalitions(12, 500)
    sizes = [sum(mask) for mask, _ in pairs]
    assert sizes.count(1) == sizes.count(11) == 12
    assert sizes.count(2) == sizes.count(10) == 66
    assert len(pairs) <= 500 and all(w > 0 for _, w in pairs)


# ---- scalars ---------------------------------------------------------------
def test_scalar_edges(spark):
    df = spark.createDataFrame([(None, float("nan"), 0.125), (0.2, 1.5, 0.375)], "rain double, v double, t double")
    rows = df.select(S.rain_flag("rain").alias("r"), S.no_nan("v").alias("v"), S.half_even("t", 2).alias("t")).collect()
    assert [tuple(r) for r in rows] == [(0, None, 0.12), (1, 1.5, 0.38)]
    assert S.time_column(df) is None
    assert S.safe_ratio(F.lit(1), F.lit(0)) is not None


@pytest.mark.parametrize("points", [2, 11, 101])
def test_every_blend_is_a_plain_comparison(spark, points):
    """All combinations, with ties at the threshold, equal probabilities, nulls and NaN."""
    rng = np.random.default_rng(8)
    x = np.vstack([rng.random((60, 3)), rng.choice([0.0, 0.25, 0.5, 0.75, 1.0], (60, 3)), np.full((3, 3), 0.5), np.repeat(rng.random((20, 1)), 3, 1), [[0.7, 0.5 + 1e-9, 0.5 - 1e-9]]])
    y = rng.integers(0, 2, len(x))
    rows = [(*map(float, r), int(c)) for r, c in zip(x, y)]
    rows += [(None, 0.9, 0.9, 1), (float("nan"), 0.9, 0.9, 0), (0.9, 0.9, 0.9, None)]
    df = spark.createDataFrame(rows, "p double, q double, r double, Rain int")
    found = {r.idx: r for r in blending.search_blend(df, ["p", "q", "r"], points=points).collect()}
    assert len(found) == points * points
    for k, r in found.items():
        said = x[:, 0] * r.w_0 + x[:, 1] * r.w_1 + x[:, 2] * r.w_2 >= 0.5
        assert (r.tp, r.fp) == ((said & (y == 1)).sum(), (said & (y == 0)).sum()), k
    plan = blending.search_blend(df, ["p", "q", "r"], points=points)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_blends_of_nothing(spark):
    none = spark.createDataFrame([], "p double, q double, r double, Rain int")
    rows = blending.search_blend(none, ["p", "q", "r"], points=3).collect()
    assert len(rows) == 9 and all((r.tp, r.fp) == (0, 0) for r in rows)
