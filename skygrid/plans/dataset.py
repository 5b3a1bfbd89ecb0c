"""The given tables seen as weather data, for Spark and as text for the SQL side.

``events`` plays the observations: a user is a grid cell, a value gives the measures, and errors
and sign-ups are rain. Every constant is a double on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.scalars import floor_hour, normalise, snapshot_id, with_cell_keys
from skygrid.operators.features import Shaping

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return normalise(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def s6(x: str) -> str:
    """SQL twin of ``r6`` without negative zeros."""
    return f"(case when abs({x}) < 5e-7 then 0e0 else round({x}, 6) end)"


# ---- observations ----------------------------------------------------------
def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_obs(table(spark, sf_dir, "events"))


def as_obs(e: DataFrame) -> DataFrame:
    """Events, standing or streamed, as observations."""
    cell = (F.col("user_id") * 37) % 400
    rain = F.when(F.col("event_type").isin("error", "signup"), 1).otherwise(0)
    return e.select(
        "event_id",
        F.col("event_type").alias("tier"),
        cell.alias("cell"),
        F.col("ts").alias("Fetch_Time"),
        F.round(F.lit(-6.36) + F.floor(cell / 20) * F.lit(0.36 / 19), 5).alias("Latitude"),
        F.round(F.lit(106.33) + (cell % 20) * F.lit(0.44 / 19), 5).alias("Longitude"),
        (F.lit(24.0) + F.col("value") / F.lit(50.0)).alias("Temperature"),
        F.get_json_object("props", "$.k").try_cast("double").alias("Humidity"),
        (F.col("value") / F.lit(10.0)).alias("Wind_Speed"),
        ((F.col("event_id") * 13) % 101).cast("double").alias("Cloud_Cover"),
        (F.lit(1000.0) + ((F.col("event_id") * 7) % 200).cast("double") / F.lit(10.0)).alias("Pressure"),
        rain.alias("Rain"),
    )


OBS = """obs as (
  select event_id, event_type as tier, cell, ts as Fetch_Time,
    round(-6.36e0 + cast(cell // 20 as double) * (36.0e-2/19e0), 5) as Latitude,
    round(106.33e0 + cast(cell % 20 as double) * (44.0e-2/19e0), 5) as Longitude,
    24e0 + value/50e0 as Temperature,
    cast(props->>'$.k' as double) as Humidity,
    value/10e0 as Wind_Speed,
    cast((event_id*13)%101 as double) as Cloud_Cover,
    1000e0 + cast((event_id*7)%200 as double)/10e0 as Pressure,
    cast(case when event_type in ('error','signup') then 1 else 0 end as integer) as Rain
  from (select *, (user_id*37)%400 as cell from events))"""


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with the hour as snapshot."""
    return obs(spark, sf_dir).withColumn("snapshot_id", snapshot_id(floor_hour("Fetch_Time")))


CURRENT = OBS + """,
current_rows as (select *, strftime(Fetch_Time, '%Y%m%d_%H00') as snapshot_id from obs)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with the day as snapshot; for queries that write files."""
    return obs(spark, sf_dir).withColumn("snapshot_id", snapshot_id(F.date_trunc("day", "Fetch_Time")))


DAILY = OBS + """,
daily as (select *, strftime(Fetch_Time, '%Y%m%d_0000') as snapshot_id from obs)"""


def strewn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of which two thirds lie off the grid and every seventh is there twice."""
    o = obs(spark, sf_dir)
    off = (F.col("event_id") % 3).cast("double")
    o = o.withColumns({"Latitude": F.col("Latitude") + off / F.lit(1024.0), "Longitude": F.col("Longitude") - off / F.lit(512.0)})
    return o.unionByName(o.where("event_id % 7 = 0"))


STREWN = OBS.replace("obs as (", "on_grid as (", 1) + """,
once as (select * replace (Latitude + cast(event_id % 3 as double)/1024e0 as Latitude, Longitude - cast(event_id % 3 as double)/512e0 as Longitude)
  from on_grid),
obs as (select * from once union all select * from once where event_id % 7 = 0)"""


# ---- forecasts -------------------------------------------------------------
def fc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast per hour and cell, from all events."""
    p = ((F.col("event_id") * 31) % 1000).cast("double") / F.lit(1000.0)
    grouped = obs(spark, sf_dir).groupBy(floor_hour("Fetch_Time").alias("dt"), "Latitude", "Longitude").agg(
        F.max((p >= 0.4).cast("int")).alias("predicted_rain"), F.max(p).alias("rain_probability")
    )
    return with_cell_keys(grouped)


def odd_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The odd events as the observations to compare with."""
    odd = obs(spark, sf_dir).where("event_id % 2 = 1")
    return with_cell_keys(odd.withColumn("dt", floor_hour("Fetch_Time")))


FC = OBS + """,
fc as (
  select date_trunc('hour', Fetch_Time) as dt, Latitude, Longitude,
    max(case when ((event_id*31)%1000)/1000e0 >= 0.4e0 then 1 else 0 end) as predicted_rain,
    max(((event_id*31)%1000)/1000e0) as rain_probability
  from obs group by 1, 2, 3),
odd as (select *, date_trunc('hour', Fetch_Time) as dt from obs where event_id % 2 = 1),
matched as (
  select o.*, f.predicted_rain, f.rain_probability from odd o
  join fc f on o.dt = f.dt and o.Latitude = f.Latitude and o.Longitude = f.Longitude)"""


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hourly forecasts of the following six hours: the even events speak for their cell."""
    o = obs(spark, sf_dir).where("event_id % 2 = 0")
    six = F.date_trunc("day", "Fetch_Time") + F.make_dt_interval(
        F.lit(0), (F.floor(F.hour("Fetch_Time") / 6) * 6).cast("int")
    )
    o = o.withColumn("six", six).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(5))))
    p = ((F.col("event_id") * 31 + F.col("h") * 97) % 1000).cast("double") / F.lit(1000.0)
    return (
        o.withColumn("p", p)
        .groupBy(
            snapshot_id("six").alias("snapshot_id"),
            (F.col("six") + F.make_dt_interval(F.lit(0), F.col("h") + 6)).alias("Forecast_Target_Time"),
            "Latitude",
            "Longitude",
        )
        .agg(
            F.max("p").alias("rain_probability"),
            (F.max("p") >= 0.4).cast("int").alias("predicted_rain"),
        )
    )


ISSUES = CURRENT + """,
issues as (
  select strftime(six, '%Y%m%d_%H00') as snapshot_id, six + to_hours(cast(h + 6 as integer)) as Forecast_Target_Time,
    Latitude, Longitude, max(p) as rain_probability, max(case when p >= 0.4e0 then 1 else 0 end) as predicted_rain
  from (select *, ((event_id*31 + h*97)%1000)/1000e0 as p from (
    select o.*, r.h, date_trunc('day', Fetch_Time) + to_hours(cast(6*(hour(Fetch_Time)//6) as integer)) as six
    from obs o cross join (select unnest(range(6)) as h) r where event_id % 2 = 0))
  group by 1, 2, 3, 4)"""


# ---- scored rows -----------------------------------------------------------
def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with three made-up base probabilities, for the model queries."""
    e = F.col("event_id")
    return obs(spark, sf_dir).withColumns(
        {
            "p_xgb": ((e * 31) % 1000).cast("double") / F.lit(1000.0),
            "p_lgb": ((e * 17 + 3) % 1000).cast("double") / F.lit(1000.0),
            "p_cat": ((e * 53 + 7) % 997).cast("double") / F.lit(997.0),
        }
    )


SCORED = OBS + """,
scored as (select *, ((event_id*31)%1000)/1000e0 as p_xgb, ((event_id*17+3)%1000)/1000e0 as p_lgb,
  ((event_id*53+7)%997)/997e0 as p_cat from obs)"""

#: Parameters for the feature queries that are checked against SQL; the powers cover every branch.
FIXED_SHAPING = {
    "Temperature": Shaping(25.0, 1.25, 0.5, 0.125, 1.5),
    "Humidity": Shaping(50.0, 28.0, 1.25, 0.0625, 1.25),
    "Cloud_Cover": Shaping(50.0, 29.0, 0.0, -0.5, 0.75),
    "Pressure": Shaping(1010.0, 5.75, 2.0, 0.25, 1.0),
    "Wind_Speed": Shaping(5.0, 5.5, -0.5, 0.5, 0.5),
}


def yj_sql(x: str, power: float) -> str:
    up = f"ln(1e0 + {x})" if power == 0 else f"(power({x} + 1e0, {power}e0) - 1e0) / {power}e0"
    rest = 2 - power
    down = f"-ln(1e0 - {x})" if rest == 0 else f"(1e0 - power(1e0 - {x}, {rest}e0)) / {rest}e0"
    return f"(case when {x} >= 0 then {up} else {down} end)"


def shaped_sql(measure: str) -> str:
    s = FIXED_SHAPING[measure]
    z = f"(({measure} - {s.mean}e0) / {s.std}e0)"
    return f"(({yj_sql(z, s.power)} - ({s.out_mean}e0)) / {s.out_std}e0)"
