"""Scaling, power transform, feature tables, encoding, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygrid.functions import scalars as S
from skygrid.functions.constants import MEASURES
from skygrid.operators import features as M
from skygrid.operators import sampling
from skygrid.operators.ranks import value_counts
from skygrid.plans.dataset import FIXED_SHAPING, NUMBERS, OBS, obs, r6, s6, shaped_sql, table
from skygrid.plans.registry import query
from skygrid.plans.space_queries import _NEAREST

_TS = "%Y-%m-%d %H:%M:%S"


@query(
    "m01_scale_fit",
    " union all ".join(f"select '{f}' as feature, {s6(f'avg({f})')} as mean, {s6(f'stddev_pop({f})')} as std from lineitem" for f in NUMBERS),
)
def _(spark, sf):
    fit = M.fit_scale(table(spark, sf, "lineitem"), NUMBERS)
    return fit.select("feature", r6("mean").alias("mean"), r6("std").alias("std"))


@query(
    "m01_scale_apply",
    f"with {OBS} select event_id, "
    + ", ".join(s6(f"({m} - (select avg({m}) from obs)) / (select stddev_pop({m}) from obs)") + f" as {m}" for m in MEASURES)
    + " from obs",
)
def _(spark, sf):
    o = obs(spark, sf)
    params = {r.feature: r for r in M.fit_scale(o).collect()}  # one row per measure
    return o.select("event_id", *[r6(M.scaled(m, params[m].mean, params[m].std)).alias(m) for m in MEASURES])


_POWERS = [-1.5, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 2.75]


def _likelihood_sql() -> str:
    parts = []
    for f in NUMBERS:
        z = f"(select ({f} - (select avg({f}) from lineitem)) / (select stddev_pop({f}) from lineitem) as z from lineitem)"
        up = "case when abs(p) < 1e-12 then ln(1e0 + z) else (power(z + 1e0, p) - 1e0)/p end"
        down = "case when abs(2e0 - p) < 1e-12 then -ln(1e0 - z) else (1e0 - power(1e0 - z, 2e0 - p))/(2e0 - p) end"
        parts.append(
            f"select '{f}' as feature, p as power, {s6('-0.5e0*ln(var_pop(t)) + (p - 1e0)*avg(sign(z)*ln(1e0 + abs(z)))')} as loglik from "
            f"(select z, p, case when z >= 0 then {up} else {down} end as t from {z} cross join (select unnest([{', '.join(f'{p}e0' for p in _POWERS)}]) as p)) group by p"
        )
    return " union all ".join(parts)


@query("m02_power_likelihoods", _likelihood_sql())
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    params = {r.feature: r for r in M.fit_scale(li, NUMBERS).collect()}  # one row per column
    cases = F.create_map(*[v for f, r in params.items() for v in (F.lit(f), F.array(F.lit(r.mean), F.lit(r.std)))])
    p = cases[F.col("feature")]
    values = value_counts(li, NUMBERS).withColumn("x", (F.col("x") - p[0]) / p[1])
    powers = spark.createDataFrame([(f, _POWERS) for f in NUMBERS], "feature string, power_list array<double>")
    found = M.likelihoods(values, powers)
    n = li.agg(F.count("*").alias("n")).scalar()
    return found.select("feature", "power", r6(F.col("loglik") / n).alias("loglik"))


@query("m02_power_fit")
def _(spark, sf):
    return M.shaping_table(spark, M.fit_shaping(obs(spark, sf)))


@query("m03_power_apply", f"with {OBS} select event_id, " + ", ".join(f"{s6(shaped_sql(m))} as {m}" for m in MEASURES) + " from obs")
def _(spark, sf):
    return obs(spark, sf).select("event_id", *[r6(M.shaped(m, s)).alias(m) for m, s in FIXED_SHAPING.items()])


@query("m04_label_codes", f"with {OBS} select tier, cast(dense_rank() over (order by tier) - 1 as integer) as code from (select distinct tier from obs)")
def _(spark, sf):
    return M.label_codes(obs(spark, sf), "tier")


def _feature_sql(shift: str, where: str, time: str, names: str) -> str:
    turn, year = "2e0*pi()*Hour/24e0", "2e0*pi()*(Month - 1)/12e0"
    return f"""with {OBS}, {_NEAREST}, t as (select obs.*, code, name, cast(hour(Fetch_Time{shift}) as integer) as Hour, cast(month(Fetch_Time{shift}) as integer) as Month
      from obs join nearest using (Latitude, Longitude) {where})
    select event_id, {time} as Timestamp, {', '.join(f'{s6(shaped_sql(m))} as {m}' for m in MEASURES)}, {names} Latitude, Longitude, Rain, Hour, Month,
      cast(code as integer) as Location_Encoded, {s6(f'sin({turn})')} as hour_sin, {s6(f'cos({turn})')} as hour_cos,
      {s6(f'sin({year})')} as month_sin, {s6(f'cos({year})')} as month_cos from t"""


_ROUNDED = [*MEASURES, "hour_sin", "hour_cos", "month_sin", "month_cos"]


@query("m05_serving_features", _feature_sql(" - interval 7 hour", "", f"strftime(Fetch_Time, '{_TS}')", ""))
def _(spark, sf):
    raw = obs(spark, sf).withColumnRenamed("Fetch_Time", "Forecast_Time")
    out = M.serving_features(raw, FIXED_SHAPING, extra=["event_id"])
    return out.withColumns({"Timestamp": S.stamp("Timestamp"), **{c: r6(c) for c in _ROUNDED}})


_LAST_WEEK = "where Fetch_Time >= (select max(Fetch_Time) - interval 7 day from obs)"


@query("m06_training_features", _feature_sql("", _LAST_WEEK, f"strftime(Fetch_Time, '{_TS}')", "name as Location,"))
def _(spark, sf):
    out = M.training_features(obs(spark, sf), FIXED_SHAPING, offset_hours=0, extra=["event_id"])
    return out.withColumns({c: r6(c) for c in _ROUNDED})


_RANKED = "r as (select event_id, Rain, row_number() over (partition by Rain order by md5(cast(event_id as varchar))) as rn, count(*) over (partition by Rain) as n from obs)"


@query("m07_stratified_split", f"with {OBS}, {_RANKED} select event_id, Rain, case when rn <= n*8//10 then 'train' else 'valid' end as split from r")
def _(spark, sf):
    return sampling.stratified_split(obs(spark, sf), "Rain", "event_id").select("event_id", "Rain", "split")


@query("m08_stratified_folds", f"with {OBS}, {_RANKED} select event_id, Rain, cast(((rn - 1)*3)//n as integer) as fold from r")
def _(spark, sf):
    return sampling.stratified_folds(obs(spark, sf), "Rain", "event_id", 3).select("event_id", "Rain", "fold")
