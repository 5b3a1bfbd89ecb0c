"""Streaming jobs run over the landed files, compared with their batch results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.functions import scalars as S
from skygrid.operators import metrics
from skygrid.plans.aggregate_queries import _COUNTS
from skygrid.plans.dataset import FC, FIXED_SHAPING, OBS, as_obs, fc, obs, r6, s6
from skygrid.plans.model_queries import serving_rows, stored_stack, through_meta
from skygrid.plans.registry import query
from skygrid.session import scratch_path
from skygrid.streaming import streams

_TS = "%Y-%m-%d %H:%M:%S"


def _events(spark, sf) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return streams.landed(spark, sf, schema, glob="events.parquet")


def _obs_stream(spark, sf) -> DataFrame:
    return as_obs(_events(spark, sf))


@query("t01_ingest", f"with {OBS} select event_id, tier, Latitude, Longitude, Temperature, Rain, strftime(Fetch_Time, '{_TS}') as fetch from obs")
def _(spark, sf):
    out = streams.run_once(_obs_stream(spark, sf), scratch_path(spark, "ingest"))
    return out.select("event_id", "tier", "Latitude", "Longitude", "Temperature", "Rain", S.stamp("Fetch_Time").alias("fetch"))


@query("t02_stream_scoring", f"with {OBS} select event_id, true as as_in_batch, true as as_stored from obs")
def _(spark, sf):
    """Streamed observations through features and the stored stack, beside the batch's scores."""
    stack = stored_stack(spark, sf)
    scored = stack.score(serving_rows(_obs_stream(spark, sf), ["event_id"]), ["event_id"])
    out = streams.run_once(scored, scratch_path(spark, "scoring"))
    batch = stack.score(serving_rows(obs(spark, sf), ["event_id"]), ["event_id"]).select("event_id", F.col("prob").alias("in_batch"))
    return out.join(batch, "event_id", "full").select(
        "event_id",
        F.coalesce(F.col("prob") == F.col("in_batch"), F.lit(False)).alias("as_in_batch"),
        F.coalesce(F.abs(F.col("prob") - through_meta(stack)) < 1e-9, F.lit(False)).alias("as_stored"),
    )


_DAY_CELL = "select strftime(date_trunc('day', Fetch_Time), '%Y%m%d_0000') as snapshot_id, cell"


@query("t03_first_of_key", f"with {OBS} select distinct strftime(date_trunc('hour', Fetch_Time), '{_TS}') as hour, cell from obs")
def _(spark, sf):
    rows = _obs_stream(spark, sf).select(S.floor_hour("Fetch_Time").alias("hour"), "cell", "event_id")
    out = streams.run_once(streams.first_only(rows, "hour", ["hour", "cell"]), scratch_path(spark, "first"))
    return out.select(S.stamp("hour").alias("hour"), "cell")


@query("t03_last_of_key", f"with {OBS} {_DAY_CELL}, max(event_id) as event_id, arg_max(Rain, event_id) as Rain from obs group by 1, 2")
def _(spark, sf):
    rows = _obs_stream(spark, sf).select(
        S.snapshot_id(F.date_trunc("day", "Fetch_Time")).alias("snapshot_id"), "cell", "event_id", "Rain"
    )
    path = scratch_path(spark, "last")
    merge = streams.upsert_last(f"{path}/data", ["cell"], ["event_id"])
    for run in ("first", "replay"):  # the second run meets every row again
        job = rows.writeStream.foreachBatch(merge).option("checkpointLocation", f"{path}/{run}")
        job.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/data")


_CLOSED = "(select max(Fetch_Time) - interval 1 hour from obs)"


@query(
    "t04_hourly_rollup",
    f"""with {OBS} select strftime(date_trunc('hour', Fetch_Time), '{_TS}') as hour, {s6('avg(Rain)')} as rain_rate, sum(Rain)::bigint as rainy_points, count(Rain) as total_points
    from obs where date_trunc('hour', Fetch_Time) + interval 1 hour <= {_CLOSED} group by 1""",
)
def _(spark, sf):
    out = streams.run_once(streams.hourly_rollup(_obs_stream(spark, sf), "Fetch_Time", "Rain"), scratch_path(spark, "hourly"))
    return out.select(S.stamp("window.start").alias("hour"), r6("rain_rate").alias("rain_rate"), "rainy_points", "total_points")


_SLIDING = f"""select strftime(h - to_hours(cast(i as integer)), '{_TS}') as start, round(sum(t)/sum(n), 9) as Temperature, round(sum(r)/sum(n), 9) as Rain
  from (select date_trunc('hour', Fetch_Time) as h, sum(Temperature) as t, sum(Rain) as r, count(*) as n from obs group by 1)
  cross join (select unnest(range(48)) as i)"""


@query("t05_sliding_means", f"with {OBS} {_SLIDING} group by 1")
def _(spark, sf):
    out = streams.sliding_means(obs(spark, sf), "Fetch_Time", ["Temperature", "Rain"])
    return out.select(S.stamp("window.start").alias("start"), *[F.round(m, 9).alias(m) for m in ("Temperature", "Rain")])


@query(
    "t05_sliding_means_stream",
    f"with {OBS} {_SLIDING} where h - to_hours(cast(i as integer)) + interval 48 hour <= {_CLOSED} group by 1",
)
def _(spark, sf):
    slid = streams.sliding_means(_obs_stream(spark, sf), "Fetch_Time", ["Temperature", "Rain"])
    out = streams.run_once(slid, scratch_path(spark, "sliding"))
    return out.select(S.stamp("window.start").alias("start"), *[F.round(m, 9).alias(m) for m in ("Temperature", "Rain")])


@query("t06_continuous_evaluation", f"with {FC}, {_COUNTS} select * from c")
def _(spark, sf):
    path = scratch_path(spark, "evaluation")
    fc(spark, sf).select("dt", "lat_e5", "lon_e5", "predicted_rain").write.parquet(f"{path}/forecast")
    schema = spark.read.parquet(f"{path}/forecast").schema
    forecast = streams.landed(spark, f"{path}/forecast", schema)
    observed = S.with_cell_keys(_obs_stream(spark, sf).where("event_id % 2 = 1"))
    observed = observed.select(S.floor_hour("Fetch_Time").alias("dt"), "lat_e5", "lon_e5", "Rain")
    matched = streams.match_streams(forecast, observed, ["lat_e5", "lon_e5"])
    out = streams.run_once(matched, f"{path}/matched")
    return metrics.confusion(out)


@query(
    "t07_late_rows",
    f"""with {OBS}, cut as (select min(Fetch_Time) + (max(Fetch_Time) - min(Fetch_Time))/2 as mid from obs),
    s as (select date_trunc('hour', Fetch_Time) as h, count(*) filter (where Fetch_Time >= (select mid from cut)) as fresh, count(*) as n from obs group by 1)
    select strftime(h, '{_TS}') as hour, case when h + interval 1 hour <= {_CLOSED} then fresh else 0 end as streamed, n as repaired from s""",
)
def _(spark, sf):
    path = scratch_path(spark, "late")
    rows = obs(spark, sf).select("event_id", "Fetch_Time", "Rain")
    span = rows.agg(F.min("Fetch_Time").alias("a"), F.max("Fetch_Time").alias("b"))
    middle = span.select(F.col("a") + (F.col("b") - F.col("a")) / 2).scalar()
    # The newer half lands first; the older half comes in a later file.
    rows.where(F.col("Fetch_Time") >= middle).write.parquet(f"{path}/in/1")
    schema = spark.read.parquet(f"{path}/in/1").schema
    stream = streams.hourly_rollup(streams.landed(spark, f"{path}/in/*", schema), "Fetch_Time", "Rain")
    streams.append_to(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    rows.where(F.col("Fetch_Time") < middle).write.parquet(f"{path}/in/2")
    stream = streams.hourly_rollup(streams.landed(spark, f"{path}/in/*", schema), "Fetch_Time", "Rain")
    streams.append_to(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    streamed = spark.read.schema(stream.schema).parquet(f"{path}/out")
    repaired = streams.hourly_rollup(rows, "Fetch_Time", "Rain")
    return repaired.alias("r").join(streamed.alias("s"), "window", "left").select(
        S.stamp("window.start").alias("hour"),
        F.coalesce("s.total_points", F.lit(0)).alias("streamed"),
        F.col("r.total_points").alias("repaired"),
    )


_SPELLS = """wet as (select cell, date_trunc('hour', Fetch_Time) as h, count(*) as n from obs where Rain = 1 group by 1, 2),
marked as (select *, case when h - lag(h) over (partition by cell order by h) <= interval 6 hour then 0 else 1 end as fresh from wet),
numbered as (select *, sum(fresh) over (partition by cell order by h) as spell from marked)"""


@query(
    "t08_rain_spells",
    f"with {OBS}, {_SPELLS} select cell, strftime(min(h), '{_TS}') as start, sum(n)::bigint as readings, count(*) as hours from numbered group by cell, spell",
)
def _(spark, sf):
    out = streams.rain_spells(obs(spark, sf), "Fetch_Time", ["cell"])
    return out.select("cell", S.stamp(F.date_trunc("hour", "spell.start")).alias("start"), "readings", "hours")
