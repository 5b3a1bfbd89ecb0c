"""Dashboard and exploration summaries, and forecast scores."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from skygrid.functions import scalars as S
from skygrid.functions.constants import DASHBOARD_FEATURES, EDA_FEATURES, MEASURES
from skygrid.operators import aggregates as A
from skygrid.operators import joins, metrics
from skygrid.operators.filters import newest_window
from skygrid.plans.dataset import FC, NUMBERS, OBS, SCORED, fc, obs, odd_obs, r6, s6, scored, table
from skygrid.plans.registry import query
from skygrid.sources.sinks import metric_rows

_TS = "%Y-%m-%d %H:%M:%S"
_SHOWN = ["Temperature", "Humidity", "Wind_Speed", "Cloud_Cover", "Pressure"]
_LAST = OBS + ", win as (select * from obs where Fetch_Time >= (select max(Fetch_Time) - interval 48 hour from obs))"


def _win(spark, sf):
    return newest_window(obs(spark, sf), "Fetch_Time", hours=48)


def _each(features, template: str, source: str) -> str:
    """One SQL line per feature, with {f} replaced."""
    return " union all ".join(f"select '{f}' as feature, {template.replace('{f}', f)} from {source}" for f in features)


def _holed(spark, sf):
    return obs(spark, sf).withColumns(
        {"Humidity": F.expr("nullif(Humidity, 50D)"), "Wind_Speed": F.when(F.col("event_id") % 7 != 0, F.col("Wind_Speed"))}
    )


_HOLED = OBS + """, holed as (select event_id, tier, Latitude, Longitude, Temperature, nullif(Humidity, 50e0) as Humidity,
  case when event_id % 7 <> 0 then Wind_Speed end as Wind_Speed, Cloud_Cover, Pressure, Rain from obs)"""


def _rounded(df, *columns):
    return df.withColumns({c: r6(c) for c in columns})


# ---- dashboard -------------------------------------------------------------
@query(
    "a01_headline_means",
    f"with {_LAST} select {', '.join(f'{s6(f'avg({m})')} as {m}' for m in _SHOWN[:4])}, round_even(avg(Rain)*100, 1) as rain_rate from win",
)
def _(spark, sf):
    return _rounded(A.headline_means(_win(spark, sf), _SHOWN[:4]), *_SHOWN[:4])


@query(
    "a02_mean_by_time",
    f"""with {OBS} select strftime(date_trunc('hour', Fetch_Time), '%b %d %H:%M') as Time,
      {', '.join(f'round(avg({m}), 9) as {m}' for m in _SHOWN)} from obs group by date_trunc('hour', Fetch_Time)""",
)
def _(spark, sf):
    o = obs(spark, sf).withColumn("_time", S.floor_hour("Fetch_Time"))
    out = A.mean_by_time(o, "_time", _SHOWN)
    return out.withColumns({m: F.round(m, 9) for m in _SHOWN}).select(S.axis_label("_time").alias("Time"), *_SHOWN)


@query(
    "a03_rain_counts",
    f"with {OBS} select case when Rain = 0 then 'No Rain' else 'Rain' end as condition, count(*) as n from obs group by 1 order by 1",
)
def _(spark, sf):
    counts = A.counts_of(obs(spark, sf), "Rain").orderBy("Rain")
    return counts.select(S.condition_text("Rain").alias("condition"), "n")


@query(
    "a04_rain_by_hour",
    f"""with {_LAST}, g as (select hour(Fetch_Time) as h, round_even(avg(Rain)*100, 1) as p from win group by 1)
    select cast(r.h as integer) as hour, coalesce(p, 0e0) as rain_percent from (select unnest(range(24)) as h) r left join g using (h)""",
)
def _(spark, sf):
    return A.rate_by_hour(_win(spark, sf), "Fetch_Time")


@query(
    "a05_forecast_rollup",
    f"""with {FC} select strftime(dt, '{_TS}') as hour, {s6('avg(predicted_rain)')} as rain_rate, sum(predicted_rain)::bigint as rainy_points,
      count(predicted_rain) as total_points, round_even(avg(predicted_rain)*100, 1) as rain_percent from fc group by 1""",
)
def _(spark, sf):
    return A.forecast_rollup(fc(spark, sf), "dt").withColumns({"hour": S.stamp("hour"), "rain_rate": r6("rain_rate")})


_UNITS = "case feature when 'Temperature' then '°C' when 'Humidity' then '%' when 'Wind_Speed' then 'km/h' when 'Cloud_Cover' then '%' when 'Pressure' then 'hPa' else '' end"


@query(
    "a06_feature_stats",
    f"with {_HOLED}, t as (" + _each(_SHOWN, "round_even(avg({f}),2) as mean, round_even(stddev_samp({f}),2) as std, round_even(min({f}),2) as min, round_even(quantile_cont({f},0.5),2) as median, round_even(max({f}),2) as max", "holed") + f") select *, {_UNITS} as unit from t",
)
def _(spark, sf):
    return A.feature_stats(_holed(spark, sf), _SHOWN)


@query(
    "a06_lineitem_stats",
    "with t as (" + _each(NUMBERS, "round_even(avg({f}),2) as mean, round_even(stddev_samp({f}),2) as std, round_even(min({f}),2) as min, round_even(quantile_cont({f},0.5),2) as median, round_even(max({f}),2) as max", "lineitem") + ") select *, '' as unit from t",
)
def _(spark, sf):
    return A.feature_stats(table(spark, sf, "lineitem"), NUMBERS)


def _corr_sql(features, source):
    return " union all ".join(f"select '{a}' as a, '{b}' as b, {s6(f'corr({a}, {b})')} as r from {source}" for a in features for b in features)


@query("a07_correlations", f"with {_HOLED} " + _corr_sql(DASHBOARD_FEATURES, "holed"))
def _(spark, sf):
    return _rounded(A.correlations(_holed(spark, sf), DASHBOARD_FEATURES), "r")


@query("a07_lineitem_correlations", _corr_sql(NUMBERS, "lineitem"))
def _(spark, sf):
    return _rounded(A.correlations(table(spark, sf, "lineitem"), NUMBERS), "r")


# ---- exploration -----------------------------------------------------------
@query("a08_rain_by_place", f"with {OBS} select tier, {s6('avg(Rain)*100')} as rain_percent from obs group by 1 order by 2 desc, 1")
def _(spark, sf):
    return _rounded(A.rate_by(obs(spark, sf), "tier").orderBy(F.desc("rain_percent"), "tier"), "rain_percent")


@query("a09_counts_by_place", f"with {OBS} select cell, Rain, count(*) as n from obs group by 1, 2")
def _(spark, sf):
    return A.counts_of(obs(spark, sf), "cell", "Rain")


@query("a10_rain_by_hour_mean", f"with {OBS} select cast(hour(Fetch_Time) as integer) as hour, {s6('avg(Rain)')} as mean, true as in_band from obs group by 1")
def _(spark, sf):
    out = A.rate_with_band(obs(spark, sf), F.hour("Fetch_Time"), "hour")
    within = (F.col("low") <= F.col("mean")) & (F.col("mean") <= F.col("high")) & (F.col("low") >= 0) & (F.col("high") <= 1)
    return out.select("hour", r6("mean").alias("mean"), within.alias("in_band"))


@query("a10_rain_by_month_band")
def _(spark, sf):
    return A.rate_with_band(obs(spark, sf), F.month("Fetch_Time"), "month")


@query("a11_null_counts", f"with {_HOLED} " + _each(["Humidity", "Wind_Speed", "Rain"], "count(*) filter (where {f} is null) as nulls", "holed"))
def _(spark, sf):
    return A.null_counts(_holed(spark, sf), ["Humidity", "Wind_Speed", "Rain"])


@query(
    "a12_duplicate_rows",
    f"""with {OBS} select coalesce(sum(c - 1), 0)::bigint as duplicates from (select count(*) as c from obs
    group by date_trunc('day', Fetch_Time), Latitude, Longitude, Rain)""",
)
def _(spark, sf):
    o = obs(spark, sf).withColumn("day", F.date_trunc("day", "Fetch_Time"))
    return A.duplicate_rows(o, ["day", "Latitude", "Longitude", "Rain"])


@query(
    "a13_describe_numbers",
    f"with {_HOLED}, t as ("
    + _each(_SHOWN, "count({f}) as count, count(distinct {f}) as unique, avg({f}) as mean, stddev_samp({f}) as std, min({f}) as min, quantile_cont({f},0.25) as q25, quantile_cont({f},0.5) as q50, quantile_cont({f},0.75) as q75, max({f}) as max", "holed")
    + "), m as ("
    + " union all ".join(f"select '{f}' as feature, (select {f} from holed where {f} is not null group by 1 order by count(*) desc, 1 limit 1) as top, (select count(*) from holed where {f} is not null group by {f} order by 1 desc limit 1) as freq" for f in _SHOWN)
    + f") select feature, count, \"unique\", top, freq, {', '.join(f'{s6(c)} as {c}' for c in ('mean', 'std', 'min', 'q25', 'q50', 'q75', 'max'))} from t join m using (feature)",
)
def _(spark, sf):
    return _rounded(A.describe_numbers(_holed(spark, sf), _SHOWN), "mean", "std", "min", "q25", "q50", "q75", "max")


@query(
    "a13_describe_text",
    f"with {OBS}, v as (select 'tier' as feature, tier as v, count(*) as n from obs group by 2) "
    "select feature, sum(n)::bigint as count, count(*) as unique, arg_min(v, (-n, v)) as top, max(n) as freq from v group by 1",
)
def _(spark, sf):
    return A.describe_text(obs(spark, sf), ["tier"])


@query(
    "a14_distinct_counts",
    f"with {OBS}, t as (" + _each(["Temperature", "Humidity", "Rain"], "count(distinct {f}) as d", "obs") + ") select feature, d as \"distinct\", case when d > 20 then 'box' else 'violin' end as plot from t",
)
def _(spark, sf):
    return A.distinct_counts(obs(spark, sf), ["Temperature", "Humidity", "Rain"])


def _hist_sql(features, source):
    parts = []
    for f in features:
        parts.append(
            f"select '{f}' as feature, cast(b as integer) as bin, {s6('any_value(lo) + b*any_value(w)')} as start, count({f}) as n from "
            f"(select unnest(range(20)) as b) r cross join (select min({f}) as lo, (max({f})-min({f}))/20e0 as w from {source}) "
            f"left join {source} on least(floor(({f}-lo)/w), 19) = b group by b"
        )
    return " union all ".join(parts)


@query("a15_histogram", f"with {_HOLED} " + _hist_sql(_SHOWN, "holed"))
def _(spark, sf):
    return _rounded(A.histogram(_holed(spark, sf), _SHOWN), "start")


@query("a15_lineitem_histogram", _hist_sql(NUMBERS, "lineitem"))
def _(spark, sf):
    return _rounded(A.histogram(table(spark, sf, "lineitem"), NUMBERS), "start")


def _kde_sql(f, source, by=None, points=200):
    key = f"{by}, " if by else ""
    join = f"using ({by})" if by else "on true"
    group = f"group by {by}" if by else ""
    return (
        f"select {key}'{f}' as feature, cast(i as integer) as i, {s6('lo + i*step')} as at, "
        f"{s6('sum(exp(-0.5e0*power((lo + i*step - x)/h, 2)))/(n*h*sqrt(2e0*pi()))')} as density from "
        f"(select {key}{f} as x from {source} where {f} is not null) join (select {key}count({f}) as n, min({f}) as lo, "
        f"(max({f})-min({f}))/{points - 1}e0 as step, stddev_samp({f})*power(count({f}), -0.2e0) as h from {source} {group}) {join} "
        f"cross join (select unnest(range({points})) as i) group by {key}i, lo, step, n, h"
    )


@query("a16_density", f"with {_HOLED} " + " union all ".join(_kde_sql(f, "holed") for f in _SHOWN))
def _(spark, sf):
    return _rounded(A.density(_holed(spark, sf), _SHOWN), "at", "density")


@query("a16_density_by_class", f"with {_HOLED} " + " union all ".join(_kde_sql(f, "holed", "Rain") for f in _SHOWN))
def _(spark, sf):
    return _rounded(A.density(_holed(spark, sf), _SHOWN, ["Rain"]), "at", "density")


def _box_sql(f, source):
    return f"""select Rain, '{f}' as feature, any_value(n) as n, {s6('any_value(q1)')} as q1, {s6('any_value(med)')} as median, {s6('any_value(q3)')} as q3,
      {s6(f'min({f}) filter (where {f} between q1-1.5e0*(q3-q1) and q3+1.5e0*(q3-q1))')} as whisker_low,
      {s6(f'max({f}) filter (where {f} between q1-1.5e0*(q3-q1) and q3+1.5e0*(q3-q1))')} as whisker_high,
      count({f}) filter (where not ({f} between q1-1.5e0*(q3-q1) and q3+1.5e0*(q3-q1))) as outside
    from {source} join (select Rain, count({f}) as n, quantile_cont({f},0.25) as q1, quantile_cont({f},0.5) as med, quantile_cont({f},0.75) as q3
      from {source} group by 1) using (Rain) group by Rain"""


@query("a17_box_by_class", f"with {_HOLED} " + " union all ".join(_box_sql(f, "holed") for f in _SHOWN))
def _(spark, sf):
    return _rounded(A.box_stats(_holed(spark, sf), _SHOWN), "q1", "median", "q3", "whisker_low", "whisker_high")


def _outlier_sql(f, source):
    bad = f"{f} < q1-1.5e0*(q3-q1) or {f} > q3+1.5e0*(q3-q1)"
    return f"""select '{f}' as feature, count(*) filter (where {bad}) as count, {s6(f'100e0 * count(*) filter (where {bad}) / count(*)')} as percentage
    from {source} cross join (select quantile_cont({f},0.25) as q1, quantile_cont({f},0.75) as q3 from {source})"""


@query("a18_outliers", f"with {_HOLED} " + " union all ".join(_outlier_sql(f, "holed") for f in _SHOWN))
def _(spark, sf):
    return _rounded(A.outliers(_holed(spark, sf), _SHOWN), "percentage")


@query("a18_lineitem_outliers", " union all ".join(_outlier_sql(f, "lineitem") for f in NUMBERS))
def _(spark, sf):
    return _rounded(A.outliers(table(spark, sf, "lineitem"), NUMBERS), "percentage")


@query(
    "a19_shape",
    f"with {OBS}, timed as (select *, hour(Fetch_Time) as Hour, dayofyear(Fetch_Time) as Month from obs) "
    + _each(EDA_FEATURES, f"{s6('skewness({f})')} as skewness, {s6('kurtosis({f})')} as kurtosis", "timed"),
)
def _(spark, sf):
    # All events lie in one month, which has no shape: the day of the year stands for it.
    timed = obs(spark, sf).withColumns({"Hour": F.hour("Fetch_Time"), "Month": F.dayofyear("Fetch_Time")})
    return _rounded(A.shape_stats(timed, EDA_FEATURES), "skewness", "kurtosis")


@query(
    "a20_transform_check",
    f"with {OBS}, p as (select " + ", ".join(f"({m}-(select avg({m}) from obs))/(select stddev_pop({m}) from obs) as {m}" for m in MEASURES)
    + " from obs) " + _each(MEASURES, ", ".join(f"{s6(e)} as {n}" for n, e in (("mean", "avg({f})"), ("std", "stddev_samp({f})"), ("skewness", "skewness({f})"), ("min", "min({f})"), ("max", "max({f})"))), "p"),
)
def _(spark, sf):
    from skygrid.operators.features import fit_scale, scaled

    o = obs(spark, sf)
    params = {r.feature: r for r in fit_scale(o).collect()}
    z = o.withColumns({m: scaled(m, params[m].mean, params[m].std) for m in MEASURES})
    return _rounded(A.transform_check(z, MEASURES), "mean", "std", "skewness", "min", "max")


# ---- forecast scores -------------------------------------------------------
_COUNTS = """c as (select count(*) filter (where Rain=1 and predicted_rain=1) as tp, count(*) filter (where Rain=0 and predicted_rain=1) as fp,
  count(*) filter (where Rain=1 and predicted_rain=0) as fn, count(*) filter (where Rain=0 and predicted_rain=0) as tn from matched)"""


def _counted(spark, sf, *forecast_values):
    return joins.match_counts(fc(spark, sf), odd_obs(spark, sf), forecast_values or ["predicted_rain"], ["Rain"])


@query("a21_confusion", f"with {FC}, {_COUNTS} select * from c")
def _(spark, sf):
    return metrics.confusion(_counted(spark, sf), weight="weight")


@query(
    "a22_forecast_scores",
    f"""with {FC}, {_COUNTS} select *, {s6('(tp+tn)/nullif(tp+fp+fn+tn, 0)')} as accuracy, {s6('coalesce(tp/nullif(tp+fp,0),0e0)')} as precision,
      {s6('coalesce(tp/nullif(tp+fn,0),0e0)')} as recall, {s6('coalesce(2*tp/nullif(2*tp+fp+fn,0),0e0)')} as f1 from c""",
)
def _(spark, sf):
    return _rounded(metrics.scores(metrics.confusion(_counted(spark, sf), weight="weight")), "accuracy", "precision", "recall", "f1")


def _auc_sql(source, prob, label="Rain"):
    return f"""(select sum(pos*(before + neg/2e0)) / (sum(pos)*sum(neg)) from (select pos, neg, coalesce(sum(neg) over (order by x rows between unbounded preceding and 1 preceding), 0) as before
      from (select {prob} as x, count(*) filter (where {label}=1) as pos, count(*) filter (where {label}=0) as neg from {source} group by 1)))"""


@query("a23_roc_auc", f"with {FC} select {s6(_auc_sql('matched', 'rain_probability'))} as roc_auc")
def _(spark, sf):
    return _rounded(metrics.roc_auc(_counted(spark, sf, "rain_probability"), weight="weight"), "roc_auc")


@query("a23_roc_auc_fine", f"with {OBS} select {s6(_auc_sql('obs', 'Temperature'))} as roc_auc")
def _(spark, sf):
    return _rounded(metrics.roc_auc(obs(spark, sf), prob="Temperature"), "roc_auc")


def _div(a, b):
    return f"coalesce(({a})/nullif({b}, 0), 0e0)"


@query(
    "a24_class_report",
    f"""with {FC}, {_COUNTS}, k as (
      select '0' as class, {_div('tn', 'tn+fn')} as precision, {_div('tn', 'tn+fp')} as recall, {_div('2*tn', '2*tn+fn+fp')} as f1, tn+fp as support from c
      union all select '1', {_div('tp', 'tp+fp')}, {_div('tp', 'tp+fn')}, {_div('2*tp', '2*tp+fp+fn')}, tp+fn from c),
    every as (select * from k union all
      select 'accuracy', {_div('tp+tn', 'tp+fp+fn+tn')}, {_div('tp+tn', 'tp+fp+fn+tn')}, {_div('tp+tn', 'tp+fp+fn+tn')}, tp+fp+fn+tn from c union all
      select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint from k union all
      select 'weighted avg', sum(precision*support)/sum(support), sum(recall*support)/sum(support), sum(f1*support)/sum(support), sum(support)::bigint from k)
    select class, {s6('precision')} as precision, {s6('recall')} as recall, {s6('f1')} as f1, support from every""",
)
def _(spark, sf):
    return _rounded(metrics.report(_counted(spark, sf), weight="weight"), "precision", "recall", "f1")


@query(
    "a25_prevalence",
    f"""with {FC}, {_COUNTS} select {s6('(tp+fn)/(tp+fp+fn+tn)')} as rain_prevalence_true, {s6('(tp+fp)/(tp+fp+fn+tn)')} as rain_prevalence_pred,
      {s6('abs((tp+fn)/(tp+fp+fn+tn) - (tp+fp)/(tp+fp+fn+tn))')} as prevalence_drift, tp+fp+fn+tn as total_points from c""",
)
def _(spark, sf):
    out = metrics.prevalence(metrics.confusion(_counted(spark, sf), weight="weight"))
    return _rounded(out, "rain_prevalence_true", "rain_prevalence_pred", "prevalence_drift")


@query(
    "a26_class_weights",
    f"""with {OBS}, n as (select count(*) filter (where Rain=0) as n_neg, count(*) filter (where Rain=1) as n_pos from obs)
    select n_neg, n_pos, {s6('n_neg/greatest(n_pos,1)')} as scale_pos_weight, {s6('(n_neg+n_pos)/(2*n_neg)')} as weight_0, {s6('(n_neg+n_pos)/(2*n_pos)')} as weight_1 from n""",
)
def _(spark, sf):
    return _rounded(metrics.class_weights(obs(spark, sf)), "scale_pos_weight", "weight_0", "weight_1")


@query(
    "s14_metric_rows",
    f"""with {FC}, {_COUNTS} select 'daily' as run_id, 'metric' as kind, name, cast(value as double) as value from
      (unpivot (select tp, fp, fn, tn from c) on tp, fp, fn, tn into name name value value)""",
)
def _(spark, sf):
    wide = metrics.confusion(_counted(spark, sf), weight="weight")
    return metric_rows(wide, "daily", datetime(2024, 2, 1)).drop("run_ts")


# ---- thresholds ------------------------------------------------------------
_CURVE = """t as (select case when i = 40 then 0.7e0 else 0.3e0 + i*((0.7e0-0.3e0)/40e0) end as threshold from (select unnest(range(41)) as i)),
curve as (select threshold, count(*) filter (where Rain=1 and p_xgb>=threshold) as tp, count(*) filter (where Rain=0 and p_xgb>=threshold) as fp,
  count(*) filter (where Rain=1 and not p_xgb>=threshold) as fn from scored cross join t group by 1)"""


@query("m13_threshold_curve", f"with {SCORED}, {_CURVE} select {s6('threshold')} as threshold, tp, fp, fn, {s6('coalesce(2*tp/nullif(2*tp+fp+fn,0),0e0)')} as f1 from curve")
def _(spark, sf):
    return _rounded(metrics.threshold_curve(scored(spark, sf), "Rain", "p_xgb"), "threshold", "f1")


@query(
    "m13_best_threshold",
    f"""with {SCORED}, {_CURVE}, f as (select threshold, coalesce(2*tp/nullif(2*tp+fp+fn,0),0e0) as f1 from curve)
    select {s6('threshold')} as threshold, {s6('f1')} as f1 from f order by f.f1 desc, f.threshold limit 1""",
)
def _(spark, sf):
    curve = metrics.threshold_curve(scored(spark, sf), "Rain", "p_xgb")
    return _rounded(metrics.best_threshold(curve), "threshold", "f1")
