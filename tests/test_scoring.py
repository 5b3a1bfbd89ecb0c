import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from onnx_bytes import logistic

from skygrid.functions import constants as K
from skygrid.operators import boosting, models, sampling, scoring
from skygrid.plans import model_queries


def sigmoid(v):
    return 1 / (1 + np.exp(-v))


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *map(float, r)) for i, r in enumerate(rng.normal(size=(300, 12)))]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{f} double" for f in K.FEATURE_ORDER))


@pytest.mark.parametrize("dicts", [True, False])
def test_real_sessions_in_both_layouts(table, dicts):
    rng = np.random.default_rng(4)
    w = {name: rng.normal(size=12) for name in scoring.BASE_ORDER}
    bodies = {name: logistic(list(v), 0.1, dicts) for name, v in w.items()}
    bodies["meta"] = logistic([2.0, -1.0, 0.5], -0.3, dicts)
    rows = scoring.score(table, bodies, ["id"]).orderBy("id").collect()
    x = np.array([[r[f] for f in K.FEATURE_ORDER] for r in table.orderBy("id").collect()])
    base = np.column_stack([sigmoid(x @ w[n] + 0.1) for n in scoring.BASE_ORDER])
    expected = sigmoid(base @ [2.0, -1.0, 0.5] - 0.3)
    assert [r.p_xgb for r in rows] == pytest.approx(list(base[:, 0]), abs=1e-5)
    assert [r.prob for r in rows] == pytest.approx(list(expected), abs=1e-5)


def test_forecast_columns_from_a_stub(table):
    class Half:
        def __init__(self, body):
            pass

        def get_inputs(self):
            return [type("I", (), {"name": "x"})()]

        def run(self, _, feed):
            n = len(feed["x"])
            assert feed["x"].dtype == np.float32
            return [np.zeros(n), np.full((n, 2), 0.5)]

    raw = table.selectExpr("*", "timestamp'2026-05-28 00:00:00' as Timestamp", "-6.2D as Latitude", "106.5D as Longitude")
    scored = scoring.score(raw, dict.fromkeys([*scoring.BASE_ORDER, "meta"], b""), ["Timestamp", "Latitude", "Longitude"], open_session=Half)
    out = scoring.to_forecast(scored)
    assert out.columns == K.FORECAST_COLUMNS
    assert out.where("rain_probability = 0.5 and predicted_rain = 1").count() == 300


# ---- training --------------------------------------------------------------
@pytest.fixture(scope="module")
def rain(spark):
    """Rows whose class depends on the measures, split and folded."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.3, 600) > 0.6).astype(int)
    rows = [(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, Rain int")
    df = sampling.stratified_folds(sampling.stratified_split(df, "Rain", "id"), "Rain", "id", 2)
    return models.assemble(models.with_weights(df), ["a", "b", "c"]).persist()


@pytest.fixture(scope="module")
def stack(rain):
    return models.fit_stack(rain.where("split = 'train'"), model_queries.quick_learners(), folds=2)


def test_stack_beats_the_prior(rain, stack):
    from skygrid.operators.metrics import roc_auc

    valid = rain.where("split = 'valid'")
    scored = stack.score(valid, ["id", "Rain"])
    assert scored.where("prob < 0 or prob > 1 or prob is null").isEmpty()
    assert roc_auc(scored, prob="prob").first().roc_auc > 0.85
    assert 0.3 <= models.choose_threshold(stack, valid) <= 0.7


def test_out_of_fold_rows_are_whole_and_once(rain):
    train = rain.where("split = 'train'")
    cat = model_queries.quick_learners()["cat"]
    apart = {(k, "cat"): m for k, m in enumerate(boosting.fit_side_by_side(train, [(cat, 0), (cat, 1)]))}
    found = models.out_of_fold(train, apart, ["id", "Rain"])
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in train.select("id").collect())


def test_saved_stack_scores_alike(spark, rain, stack, tmp_path):
    stack.threshold = 0.45
    stack.save(spark, str(tmp_path / "stack"))
    again = models.Stack.load(spark, str(tmp_path / "stack"))
    assert again.threshold == 0.45 and list(again.bases) == list(stack.bases)
    one, two = (sorted(tuple(r) for r in s.forecast(rain, ["id"]).collect()) for s in (stack, again))
    assert one == two


def test_search_draws_and_picks(rain):
    settings = models.draw_params(K.SEARCH_SPACES["xgb"], 30)
    assert len(settings) == 30 and len({tuple(s.items()) for s in settings}) == 30
    assert models.draw_params({"a": [1, 2]}, 30) in ([{"a": 1}, {"a": 2}], [{"a": 2}, {"a": 1}])
    space = {"iterations": [1, 2], "depth": [2]}
    train = rain.where("split = 'train'").select("Rain", "features", "weight", "fold")
    _, setting, f1 = models.search(train, models.base_learners()["cat"], space, draws=2, folds=2)
    assert setting["iterations"] in (1, 2) and 0 < f1 <= 1


def test_background_takes_real_values(spark, rain):
    centres = models.background(rain, 5, features=["a", "b", "c"])
    rows = centres.collect()
    assert len(rows) == 5 and sum(r.weight for r in rows) == pytest.approx(1)
    real = {r.a for r in rain.select("a").collect()}
    assert all(r.a in real for r in rows)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "Rain int")
    weighted = models.with_weights(df).groupBy("Rain").agg(F.first("weight").alias("w")).collect()
    assert {r.Rain: r.w for r in weighted} == {0: 1.0, 1: 3.0}


def test_a_stack_of_more_rows_than_a_task_holds_is_of_all_rows(rain, stack):
    again = models.fit_stack(rain.where("split = 'train'"), model_queries.quick_learners(), folds=2, rows=50)
    assert [[vars(t) for t in m.trees] for m in again.bases.values()] == [[vars(t) for t in m.trees] for m in stack.bases.values()]
    assert again.meta.coefficients.toArray() == pytest.approx(stack.meta.coefficients.toArray(), rel=1e-6)
