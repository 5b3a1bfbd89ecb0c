"""Training, scoring, blending, attribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.constants import BLEND_WEIGHTS, FEATURE_ORDER
from skygrid.operators import attribution, blending, boosting, features, metrics, models, sampling
from skygrid.plans.aggregate_queries import _auc_sql
from skygrid.plans.dataset import FIXED_SHAPING, OBS, SCORED, obs, r6, s6, scored
from skygrid.plans.registry import query
from skygrid.session import scratch_path

def training_frame(spark, sf, folds: int = 2) -> DataFrame:
    """Features, label, split and folds of all observations, written once to the shared folder.

    Every fit reads the rows many times; a written table serves them all and outlives executors.
    """
    raw = obs(spark, sf).withColumnRenamed("Fetch_Time", "Forecast_Time")
    table = features.serving_features(raw, FIXED_SHAPING, extra=["event_id"])
    table = sampling.stratified_split(table, "Rain", "event_id")
    table = sampling.stratified_folds(table, "Rain", "event_id", folds)
    path = scratch_path(spark, "training")
    models.with_weights(table, counted=table.where("split = 'train'")).write.parquet(path)
    return models.assemble(spark.read.parquet(path))


def quick_learners() -> dict:
    learners = models.base_learners()
    return {
        "xgb": learners["xgb"].with_params({"n_estimators": 3, "max_depth": 3}),
        "lgb": learners["lgb"].with_params({"n_estimators": 3, "num_leaves": 6}),
        "cat": learners["cat"].with_params({"iterations": 3, "depth": 3}),
    }


def full_stack(spark, sf) -> tuple[models.Stack, DataFrame, DataFrame]:
    """The stack at the library's settings, three folds, with its threshold; training and held-back rows."""
    return _stack(training_frame(spark, sf, 3), models.base_learners(), 3)


def quick_stack(spark, sf) -> tuple[models.Stack, DataFrame, DataFrame]:
    """A small stack, for queries that check scoring and not the fit."""
    return _stack(training_frame(spark, sf), quick_learners(), 2)


def _stack(whole: DataFrame, learners: dict, folds: int) -> tuple[models.Stack, DataFrame, DataFrame]:
    train, valid = whole.where("split = 'train'"), whole.where("split = 'valid'")
    stack = models.fit_stack(train, learners, folds=folds)
    stack.threshold = models.choose_threshold(stack, valid)
    return stack, train, valid


# ---- training --------------------------------------------------------------
@query("m09_baselines")
def _(spark, sf):
    whole = training_frame(spark, sf)
    fitted = models.fit_all(whole.where("split = 'train'"), models.baselines())
    path = scratch_path(spark, "baseline-probabilities")  # the comparison reads them several times
    models.probabilities(whole.where("split = 'valid'"), fitted, ["event_id", "Rain"]).write.parquet(path)
    found = spark.read.parquet(path)
    return metrics.compare_models(found, {m: F.col(f"p_{m}") for m in fitted}, "Rain")


@query("m10_base_learners")
def _(spark, sf):
    whole = training_frame(spark, sf)
    fitted = models.fit_all(whole.where("split = 'train'"), models.base_learners())
    found = models.probabilities(whole.where("split = 'valid'"), fitted, ["event_id", "Rain"])
    return metrics.compare_models(found, {m: F.col(f"p_{m}") for m in fitted}, "Rain")


@query(
    "m10_leaf_sums",
    f"""with {OBS}, c as (select *, case when Rain = 1 then (select count(*) filter (where Rain = 0)*1e0/count(*) filter (where Rain = 1) from obs) else 1e0 end as w,
      case when coalesce(Humidity, 0e0) > 50e0 then 4 when Cloud_Cover <= 40e0 then 2 else 3 end as leaf from obs)
    select cast(leaf as integer) as leaf, count(*) as n, round(sum(w*(0.5e0 - Rain)), 2) as g, round(sum(w*0.25e0), 2) as h,
      round(-0.3e0*sum(w*(0.5e0 - Rain))/(sum(w*0.25e0) + 1e0), 5) as value from c group by 1""",
)
def _(spark, sf):
    """Gradient and Hessian sums, with class weights, in the leaves of a given tree, and their Newton steps."""
    rows = models.assemble(models.with_weights(obs(spark, sf)).fillna({"Humidity": 0.0}), ["Humidity", "Cloud_Cover"])
    tree = boosting.Tree(feature=[0, 1, -1, -1, -1], cut=[0, 0, 0, 0, 0], left=[1, 2, -1, -1, -1], right=[4, 3, -1, -1, -1], value=[0.0] * 5)
    found = boosting.leaf_sums(rows, models.base_learners()["xgb"], tree, [[50.0], [40.0]])
    return found.withColumns({"g": F.round("g", 2), "h": F.round("h", 2), "value": F.round("value", 5)})


@query("m11_random_search")
def _(spark, sf):
    """30 draws on 3 folds of each learner's space."""
    train = training_frame(spark, sf, 3).where("split = 'train'").select("Rain", "features", "weight", "fold")
    found = models.tune_bases(train)
    rows = [(m, k, str(v), float(f1)) for m, (setting, f1) in found.items() for k, v in setting.items()]
    return spark.createDataFrame(rows, "model string, param string, value string, f1 double")


@query("m12_stacking")
def _(spark, sf):
    stack, _, valid = full_stack(spark, sf)
    found = stack.score(valid, ["event_id", "Rain"])
    said = found.withColumn("said", (F.col("prob") >= stack.threshold).cast("int"))
    return metrics.scores(metrics.confusion(said, "Rain", "said")).withColumn("threshold", F.lit(stack.threshold))


@query("m16_stack_forecast")
def _(spark, sf):
    stack, _, valid = quick_stack(spark, sf)
    return stack.forecast(valid, ["event_id", "Timestamp", "Latitude", "Longitude"])


# ---- scoring with stored models --------------------------------------------
def stored_stack(spark, sf) -> models.Stack:
    """The fitted stack, written to the shared folder and loaded as a serving job would."""
    path = scratch_path(spark, "stack")
    quick_stack(spark, sf)[0].save(spark, path)
    return models.Stack.load(spark, path)


def serving_rows(raw: DataFrame, keep: list[str]) -> DataFrame:
    table = features.serving_features(raw.withColumnRenamed("Fetch_Time", "Forecast_Time"), FIXED_SHAPING, extra=keep)
    return models.assemble(table)


def through_meta(stack: models.Stack) -> Column:
    """The stacked probability from the base probabilities and the stored coefficients."""
    meta = stack.meta.stages[0]
    z = F.lit(float(meta.intercept))
    for name, weight in zip(stack.bases, meta.coefficients):
        z = z + F.lit(float(weight)) * F.col(f"p_{name}")
    return 1 / (1 + F.exp(-z))


@query("m16_exported_models", f"with {OBS} select event_id, true as as_stored, true as in_range from obs")
def _(spark, sf):
    """Every observation scored by the stored stack; the meta model's formula gives the same."""
    stack = stored_stack(spark, sf)
    found = stack.score(serving_rows(obs(spark, sf), ["event_id"]), ["event_id"])
    parts = [F.col(f"p_{m}").between(0, 1) for m in stack.bases]
    return found.select(
        "event_id", (F.abs(F.col("prob") - through_meta(stack)) < 1e-9).alias("as_stored"), (parts[0] & parts[1] & parts[2]).alias("in_range")
    )


# ---- blending --------------------------------------------------------------
_PROBS = ["p_xgb", "p_lgb", "p_cat"]


def _blend_sql(w) -> str:
    return f"({w[0]}e0*p_xgb + {w[1]}e0*p_lgb + {w[2]}e0*p_cat)"


def _model_scores_sql(name: str, prob: str) -> str:
    return f"""select '{name}' as model, tp, fp, fn, tn, {s6('(tp+tn)/(tp+fp+fn+tn)')} as accuracy, {s6('coalesce(tp/nullif(tp+fp,0),0e0)')} as precision,
      {s6('coalesce(tp/nullif(tp+fn,0),0e0)')} as recall, {s6('coalesce(2*tp/nullif(2*tp+fp+fn,0),0e0)')} as f1, {s6(_auc_sql('scored', prob))} as roc_auc
    from (select count(*) filter (where Rain=1 and {prob}>=0.5e0) as tp, count(*) filter (where Rain=0 and {prob}>=0.5e0) as fp,
      count(*) filter (where Rain=1 and not {prob}>=0.5e0) as fn, count(*) filter (where Rain=0 and not {prob}>=0.5e0) as tn from scored)"""


def _score_columns(df):
    return df.withColumns({c: r6(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")})


@query("m14_weighted_blends", f"with {SCORED} " + " union all ".join(_model_scores_sql(f"blend_{i + 1}", _blend_sql(w)) for i, w in enumerate(BLEND_WEIGHTS)))
def _(spark, sf):
    return _score_columns(blending.compare_blends(scored(spark, sf), _PROBS))


def _grid_sql(points: int) -> str:
    last, step = points - 1, 1 / (points - 1)
    return f"""a as (select case when i = {last} then 1e0 else i*{step!r}e0 end as w_0, i from (select unnest(range({points})) as i)),
b as (select w_0, i*{points} + j as idx, case when j = {last} then 1e0 - w_0 else j*((1e0 - w_0)/{last}) end as w_1 from a cross join (select unnest(range({points})) as j)),
g as (select cast(idx as integer) as idx, w_0, w_1, 1e0 - w_0 - w_1 as w_2 from b),
k as (select idx, any_value(w_0) as w_0, any_value(w_1) as w_1, any_value(w_2) as w_2,
  count(*) filter (where Rain=1 and w_0*p_xgb + w_1*p_lgb + w_2*p_cat >= 0.5e0) as tp,
  count(*) filter (where Rain=0 and w_0*p_xgb + w_1*p_lgb + w_2*p_cat >= 0.5e0) as fp,
  count(*) filter (where Rain=1) as pos from scored cross join g group by idx)"""


@query("m15_blend_grid", f"with {SCORED}, {_grid_sql(11)} select idx, {s6('w_0')} as w_0, {s6('w_1')} as w_1, {s6('w_2')} as w_2, tp, fp, {s6('coalesce(2*tp/nullif(tp+fp+pos,0),0e0)')} as f1 from k")
def _(spark, sf):
    found = blending.search_blend(scored(spark, sf), _PROBS, points=11)
    return found.withColumns({c: r6(c) for c in ("w_0", "w_1", "w_2", "f1")})


@query(
    "m15_best_blend",
    f"with {SCORED}, {_grid_sql(101)}, f as (select *, coalesce(2*tp/nullif(tp+fp+pos,0),0e0) as f1 from k) select {s6('w_0')} as w_0, {s6('w_1')} as w_1, {s6('w_2')} as w_2, {s6('f1')} as f1 from f where f1 > 0 order by f.f1 desc, idx limit 1",
)
def _(spark, sf):
    found = blending.best_blend(blending.search_blend(scored(spark, sf), _PROBS))
    return found.withColumns({c: r6(c) for c in found.columns})


@query("m17_model_comparison", f"with {SCORED} " + " union all ".join(_model_scores_sql(p[2:], p) for p in _PROBS))
def _(spark, sf):
    return _score_columns(metrics.compare_models(scored(spark, sf), {p[2:]: F.col(p) for p in _PROBS}, "Rain"))


# ---- background and attribution --------------------------------------------
@query("m18_background")
def _(spark, sf):
    return models.background(training_frame(spark, sf), k=50)


def _attributions(spark, sf) -> DataFrame:
    """Attributions of 100 hash-drawn rows against 50 centres, both of the whole table, as a written table."""
    stack, train, valid = quick_stack(spark, sf)
    whole = train.unionByName(valid)
    centres = models.background(whole, k=50)
    rows = sampling.sample_rows(whole, 100, "event_id").select("event_id", *FEATURE_ORDER)

    def score(df):
        return stack.score(models.assemble(df), [c for c in df.columns if c in ("event_id", "mask_id", "centre_weight")])

    path = scratch_path(spark, "attributions")
    attribution.attribute(rows, centres, score, key="event_id", n=500).write.parquet(path)
    return spark.read.parquet(path)


@query("m19_attributions")
def _(spark, sf):
    return _attributions(spark, sf)


@query(
    "m19_additive",
    f"with {OBS} select event_id, true as adds_up, cast({len(FEATURE_ORDER)} as bigint) as features from obs order by md5('42:' || cast(event_id as varchar)) limit 100",
)
def _(spark, sf):
    """The contributions of a row sum to its score minus the base."""
    sums = F.abs(F.sum("phi") - (F.max("fx") - F.max("base"))) < 1e-6
    return _attributions(spark, sf).groupBy("event_id").agg(sums.alias("adds_up"), F.count("*").alias("features"))


@query("m20_importance")
def _(spark, sf):
    return attribution.importance(_attributions(spark, sf))


@query(
    "m20_importance_of_given",
    f"with {OBS} select tier as feature, {s6('avg(abs(Temperature - 25e0))')} as importance from obs group by 1 order by 2 desc, 1",
)
def _(spark, sf):
    given = obs(spark, sf).select(F.col("tier").alias("feature"), (F.col("Temperature") - 25.0).alias("phi"))
    return attribution.importance(given).withColumn("importance", r6("importance"))
