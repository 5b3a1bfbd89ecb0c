import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skygrid.operators import metrics, ranks, sampling


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


@settings(max_examples=10, deadline=None)
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_quantiles_are_exact(spark, values):
    row = ranks.quantiles(ranks.value_counts(frame(spark, values), ["v"]), {"a": 0.25, "b": 0.5, "c": 0.9}).first()
    assert row.n == len(values)
    assert [row.a, row.b, row.c] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])), abs=1e-6)


def test_quantiles_with_a_hot_value_and_many_buckets(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.lognormal(0, 3, 20_000), np.full(10_000, 1.0)])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        row = ranks.quantiles(ranks.value_counts(df, ["v"]), {"a": 0.01, "b": 0.5, "c": 0.999}).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [row.a, row.b, row.c] == pytest.approx(list(np.quantile(values, [0.01, 0.5, 0.999])))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 8)), min_size=2, max_size=40))
def test_auc_is_the_share_of_won_pairs(spark, rows):
    df = spark.createDataFrame([(y, s / 8) for y, s in rows], "Rain int, rain_probability double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    auc = metrics.roc_auc(df).first().roc_auc
    if not pos or not neg:
        assert auc is None
    else:
        won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert auc == pytest.approx(won / (len(pos) * len(neg)))


def test_auc_with_weights_equals_repeated_rows(spark):
    rows = [(1, 0.9, 3), (0, 0.9, 2), (0, 0.1, 5), (1, 0.4, 1)]
    counted = spark.createDataFrame(rows, "Rain int, rain_probability double, w bigint")
    plain = spark.createDataFrame([r[:2] for r in rows for _ in range(r[2])], "Rain int, rain_probability double")
    assert metrics.roc_auc(counted, weight="w").first() == metrics.roc_auc(plain).first()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 100)), min_size=1, max_size=40))
def test_best_threshold_is_the_brute_force_one(spark, rows):
    df = spark.createDataFrame([(y, s / 100) for y, s in rows], "Rain int, rain_probability double")
    best, at = 0.0, 0.5
    for t in np.linspace(0.3, 0.7, 41):
        tp = sum(y == 1 and s / 100 >= t for y, s in rows)
        wrong = sum((y == 1) != (s / 100 >= t) for y, s in rows)
        f1 = 2 * tp / (2 * tp + wrong) if tp else 0.0
        if f1 > best:
            best, at = f1, t
    got = metrics.best_threshold(metrics.threshold_curve(df)).first()
    assert (got.threshold, got.f1) == pytest.approx((at, best))


def test_split_and_folds(spark):
    df = spark.range(1000).withColumn("Rain", (F.col("id") % 3 == 0).cast("int"))
    split = {(r.Rain, r.split): r["count"] for r in sampling.stratified_split(df, "Rain", "id").groupBy("Rain", "split").count().collect()}
    assert split == {(0, "train"): 532, (0, "valid"): 134, (1, "train"): 267, (1, "valid"): 67}
    folds = sampling.stratified_folds(df, "Rain", "id", 3).groupBy("Rain", "fold").count().collect()
    assert sorted((r.Rain, r.fold, r["count"]) for r in folds) == [
        (0, 0, 222), (0, 1, 222), (0, 2, 222), (1, 0, 112), (1, 1, 111), (1, 2, 111),
    ]


def test_sample_is_repeatable(spark):
    df = spark.range(500)
    one, two = (sorted(r.id for r in sampling.sample_rows(df, 50, "id").collect()) for _ in range(2))
    assert one == two and len(set(one)) == 50


def test_scores_without_positives(spark):
    df = spark.createDataFrame([(0, 0)], "Rain int, predicted_rain int")
    row = metrics.scores(metrics.confusion(df)).first()
    assert (row.tn, row.accuracy, row.precision, row.recall, row.f1) == (1, 1.0, 0.0, 0.0, 0.0)
