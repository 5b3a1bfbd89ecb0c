"""Projections, filters, deduplication, order."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygrid.functions import scalars as S
from skygrid.functions.constants import PAYLOAD_NAMES
from skygrid.operators import dedup, filters, sampling
from skygrid.operators.joins import densify, with_measures
from skygrid.plans.dataset import CURRENT, FC, OBS, SCORED, current, fc, obs, odd_obs, r6, s6, scored
from skygrid.plans.registry import query
from skygrid.sources import snapshots

_TS = "%Y-%m-%d %H:%M:%S"


# ---- projections -----------------------------------------------------------
@query("p01_rename", f"with {OBS} select event_id, Latitude as latitude, Longitude as longitude, Rain as rain_label from obs")
def _(spark, sf):
    named = snapshots.renamed(obs(spark, sf), PAYLOAD_NAMES)
    return named.select("event_id", "latitude", "longitude", "rain_label")


@query("p12_float32", f"with {OBS} select event_id, cast(cast(Temperature as float) as double) as narrow from obs")
def _(spark, sf):
    return obs(spark, sf).select("event_id", F.col("Temperature").cast("float").cast("double").alias("narrow"))


@query(
    "p16_null_filled",
    f"with {FC} select strftime(dt, '{_TS}') as dt, Latitude, Longitude, cast(null as double) as Temperature, '2024-02-01 00:00:00' as fetched from fc",
)
def _(spark, sf):
    bare = with_measures(fc(spark, sf), None, ["Temperature"])
    return bare.select(S.stamp("dt").alias("dt"), "Latitude", "Longitude", "Temperature", F.lit("2024-02-01 00:00:00").alias("fetched"))


@query("p17_drop_columns", f"with {OBS} select event_id, tier, cell, Rain from obs")
def _(spark, sf):
    return obs(spark, sf).drop("Fetch_Time", "Latitude", "Longitude", "Temperature", "Humidity", "Wind_Speed", "Cloud_Cover", "Pressure", "absent")


@query(
    "p02_time_column",
    f"""with {OBS} select strftime(date_trunc('hour', Fetch_Time), '{_TS}') as hour, count(*) as n from obs
    where Fetch_Time >= (select max(Fetch_Time) - interval 48 hour from obs) group by 1""",
)
def _(spark, sf):
    tier = snapshots.load_tier("historic", obs(spark, sf).withColumnRenamed("Fetch_Time", "Timestamp"))
    return tier.groupBy(S.stamp(S.floor_hour("_time")).alias("hour")).agg(F.count("*").alias("n"))


@query(
    "p03_parse_time",
    f"""with {OBS} select event_id, case when event_id % 97 = 0 then null
      when event_id % 2 = 0 then strftime(date_trunc('minute', Fetch_Time), '{_TS}')
      else strftime(Fetch_Time, '{_TS}') end as parsed from obs""",
)
def _(spark, sf):
    text = (
        F.when(F.col("event_id") % 97 == 0, "n/a")
        .when(F.col("event_id") % 2 == 0, F.date_format("Fetch_Time", "yyyy-MM-dd'T'HH:mm"))
        .otherwise(S.stamp("Fetch_Time"))
    )
    return obs(spark, sf).select("event_id", S.stamp(S.parse_time(text)).alias("parsed"))


@query(
    "p04_ordered_columns",
    f"""with {OBS} select event_id, Temperature, Humidity, Latitude, Longitude, Rain from obs""",
)
def _(spark, sf):
    order = ["Timestamp", "event_id", "Temperature", "Humidity", "Latitude", "Longitude", "Rain", "Hour"]
    return S.in_order(obs(spark, sf), order)


@query(
    "p05_zone_shift",
    f"""with {OBS} select event_id, strftime(Fetch_Time - interval 7 hour, '{_TS}') as utc from obs""",
)
def _(spark, sf):
    return obs(spark, sf).select("event_id", S.stamp(S.to_utc("Fetch_Time")).alias("utc"))


@query(
    "p06_hour_month",
    f"""with {OBS} select cast(hour(Fetch_Time - interval 7 hour) as integer) as h,
      cast(month(Fetch_Time - interval 7 hour) as integer) as m, count(*) as n from obs group by 1, 2""",
)
def _(spark, sf):
    utc = S.to_utc("Fetch_Time")
    return obs(spark, sf).groupBy(F.hour(utc).alias("h"), F.month(utc).alias("m")).agg(F.count("*").alias("n"))


@query(
    "p07_floor_hour",
    f"""with {OBS} select strftime(date_trunc('hour', Fetch_Time), '{_TS}') as hour, count(*) as n
    from obs group by 1""",
)
def _(spark, sf):
    return obs(spark, sf).groupBy(S.stamp(S.floor_hour("Fetch_Time")).alias("hour")).agg(F.count("*").alias("n"))


@query(
    "p08_rain_flag",
    """select event_id, cast(case when amount > 0 then 1 else 0 end as integer) as rain from (
      select event_id, case when event_id % 5 = 0 then null else value - 10e0 end as amount from events)""",
)
def _(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    amount = F.when(F.col("event_id") % 5 != 0, F.col("value") - 10.0)
    return e.select("event_id", S.rain_flag(amount).alias("rain"))


_TURN = "2e0 * pi() * hour(Fetch_Time) / 24e0"
_YEAR = "2e0 * pi() * (month(Fetch_Time) - 1) / 12e0"


@query(
    "p09_cyclic",
    f"""with {OBS} select event_id, {s6(f'sin({_TURN})')} as hour_sin, {s6(f'cos({_TURN})')} as hour_cos,
      {s6(f'sin({_YEAR})')} as month_sin, {s6(f'cos({_YEAR})')} as month_cos from obs""",
)
def _(spark, sf):
    parts = S.cyclic(F.hour("Fetch_Time"), F.month("Fetch_Time"))
    return obs(spark, sf).select("event_id", *[r6(c).alias(name) for name, c in parts.items()])


@query(
    "p10_time_text",
    f"""with {OBS} select event_id, strftime(Fetch_Time, '{_TS}') as full_text,
      strftime(Fetch_Time, '%b %d %H:%M') as axis_text from obs""",
)
def _(spark, sf):
    return obs(spark, sf).select(
        "event_id", S.stamp("Fetch_Time").alias("full_text"), S.axis_label("Fetch_Time").alias("axis_text")
    )


@query(
    "p11_clean_values",
    f"""with {OBS} select event_id, case when Humidity = 50e0 then null else Humidity end as humidity,
      cast(case when event_id % 10 = 0 then null else Rain end as integer) as rain_label from obs""",
)
def _(spark, sf):
    holed = obs(spark, sf).select(
        "event_id",
        F.when(F.col("Humidity") == 50.0, F.lit(float("nan"))).otherwise(F.col("Humidity")).alias("humidity"),
        F.when(F.col("event_id") % 10 != 0, F.col("Rain").cast("double")).alias("rain_label"),
    )
    return holed.select("event_id", S.no_nan("humidity").alias("humidity"), F.col("rain_label").cast("int").alias("rain_label"))


@query(
    "p13_half_even",
    """select event_id, round_even(x, 4) as r4, round_even(x, 2) as r2, round_even(x, 1) as r1
    from (select event_id, cast(event_id % 4096 as double) / 16e0 as x from events)""",
)
def _(spark, sf):
    x = (F.col("event_id") % 4096).cast("double") / 16.0
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_id", *[S.half_even(x, n).alias(f"r{n}") for n in (4, 2, 1)])


@query(
    "p14_threshold",
    f"""with {SCORED} select event_id, cast(case when p_xgb >= 0.4e0 then 1 else 0 end as integer) as said from scored""",
)
def _(spark, sf):
    return scored(spark, sf).select("event_id", S.to_class("p_xgb").alias("said"))


_LABEL = "case when event_id % 3 = 0 then null else Rain end"
_TEXT = f"""case when {_LABEL} = 1 then 'Rain' when {_LABEL} = 0 then 'Clear'
  when Cloud_Cover > 60 then 'Possible rain' else 'Clear' end"""


@query("p15_rain_text", f"with {OBS} select event_id, {_TEXT} as status from obs")
def _(spark, sf):
    label = F.when(F.col("event_id") % 3 != 0, F.col("Rain"))
    return obs(spark, sf).select("event_id", S.rain_text(label, "Cloud_Cover").alias("status"))


@query(
    "p19_units_and_labels",
    f"""with {OBS}, long as (
      select 'Temperature' as feature, '°C' as unit, Rain, Temperature as x from obs union all
      select 'Humidity', '%', Rain, Humidity from obs union all
      select 'Pressure', 'hPa', Rain, Pressure from obs union all
      select 'Latitude', '', Rain, Latitude from obs)
    select feature, unit, case when Rain = 0 then 'No Rain' else 'Rain' end as condition, count(x) as n
    from long group by 1, 2, 3""",
)
def _(spark, sf):
    long = S.unpivot(obs(spark, sf), ["Temperature", "Humidity", "Pressure", "Latitude"], ["Rain"])
    return long.groupBy(
        "feature", S.unit_of("feature").alias("unit"), S.condition_text("Rain").alias("condition")
    ).agg(F.count("x").alias("n"))


@query(
    "p20_percent",
    f"with {OBS} select tier, round_even(avg(Rain) * 100, 1) as rain_percent from obs group by 1",
)
def _(spark, sf):
    return obs(spark, sf).groupBy("tier").agg(S.percent(F.avg("Rain")).alias("rain_percent"))


# ---- filters ---------------------------------------------------------------
@query(
    "f01_newest_window",
    f"""with {OBS} select event_id, Rain from obs
    where Fetch_Time >= (select max(Fetch_Time) - interval 48 hour from obs)""",
)
def _(spark, sf):
    return filters.newest_window(obs(spark, sf), "Fetch_Time", hours=48).select("event_id", "Rain")


@query(
    "f02_drop_oldest",
    f"""with {OBS} select count(*) as n, sum(event_id)::bigint as ids from obs
    where Fetch_Time >= (select min(Fetch_Time) + interval 7 day from obs)""",
)
def _(spark, sf):
    kept = filters.drop_oldest(obs(spark, sf), "Fetch_Time", days=7)
    return kept.agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


_MOMENTS = {"past_noon": "2024-01-16 12:34:56", "on_hour": "2024-01-16 12:00:00", "first_minute": "2024-01-16 12:00:07"}


def _hour_filter_sql() -> str:
    parts = []
    for name, at in _MOMENTS.items():
        t = f"timestamp '{at}'"
        bound = f"case when minute({t}) > 0 then date_trunc('hour', {t}) + interval 1 hour else {t} end"
        parts.append(f"select '{name}' as moment, 'past' as side, count(*) as n from o where h < date_trunc('hour', {t})")
        parts.append(f"select '{name}', 'coming', count(*) from o where h >= {bound}")
    return f"with {OBS}, o as (select date_trunc('hour', Fetch_Time) as h from obs) " + " union all ".join(parts)


@query("f04_past_and_coming_hours", _hour_filter_sql())
def _(spark, sf):
    hours = obs(spark, sf).select(S.floor_hour("Fetch_Time").alias("h"))
    parts = []
    for name, at in _MOMENTS.items():
        moment = F.to_timestamp(F.lit(at))
        for side, kept in (
            ("past", filters.past_hours(hours, "h", moment)),
            ("coming", filters.coming_hours(hours, "h", moment)),
        ):
            parts.append(kept.agg(F.lit(name).alias("moment"), F.lit(side).alias("side"), F.count("*").alias("n")))
    return snapshots.union_all(parts)


@query(
    "f05_empty_guards",
    f"""with {FC} select 'matched' as part, case when count(*) > 0 then 'ok' else 'empty' end as status from matched
    union all select 'hot', case when count(*) > 0 then 'ok' else 'empty' end from obs where Temperature > 100""",
)
def _(spark, sf):
    from skygrid.operators.joins import match

    found = match(fc(spark, sf), odd_obs(spark, sf))
    hot = obs(spark, sf).where("Temperature > 100")
    return filters.status_of(found).select(F.lit("matched").alias("part"), "status").unionByName(
        filters.status_of(hot).select(F.lit("hot").alias("part"), "status")
    )


@query(
    "f06_first_valid",
    f"""with {OBS} select arg_min(Humidity, event_id) as Humidity from obs where Humidity <> 50e0""",
)
def _(spark, sf):
    holed = obs(spark, sf).withColumn("Humidity", F.expr("nullif(Humidity, 50D)"))
    return filters.first_valid(holed, "Humidity", "event_id")


# ---- deduplication, window, set operations, order ---------------------------
_DUP = """, latest as (select * from obs where Fetch_Time >= (select max(Fetch_Time) - interval 1 day from obs)),
  both_parts as (
  select date_trunc('hour', Fetch_Time) as ts, Latitude, Longitude, Rain, 0 as source_rank, event_id as seq from obs
  union all
  select date_trunc('hour', Fetch_Time), Latitude, Longitude, 1 - Rain, 1, event_id from latest)"""


def _both(spark, sf):
    o = obs(spark, sf)
    old = o.select(S.floor_hour("Fetch_Time").alias("ts"), "Latitude", "Longitude", "Rain", F.lit(0).alias("source_rank"), F.col("event_id").alias("seq"))
    new = filters.newest_window(o, "Fetch_Time", days=1)
    new = new.select(S.floor_hour("Fetch_Time").alias("ts"), "Latitude", "Longitude", (1 - F.col("Rain")).alias("Rain"), F.lit(1).alias("source_rank"), F.col("event_id").alias("seq"))
    return old, new


@query(
    "d01_keep_last",
    f"""with {OBS}{_DUP} select strftime(ts, '{_TS}') as ts, Latitude, Longitude, Rain, seq from (
      select *, row_number() over (partition by ts, Latitude, Longitude order by source_rank desc, seq desc) as rn
      from both_parts) where rn = 1""",
)
def _(spark, sf):
    old, new = _both(spark, sf)
    kept = dedup.keep_last(old.unionByName(new), ["ts", "Latitude", "Longitude"], ["source_rank", "seq"])
    return kept.select(S.stamp("ts").alias("ts"), "Latitude", "Longitude", "Rain", "seq")


@query(
    "d02_union_by_name",
    f"""with {OBS}{_DUP} select source_rank, Rain, count(*) as n from both_parts group by 1, 2""",
)
def _(spark, sf):
    old, new = _both(spark, sf)
    whole = snapshots.union_all([old, new.select(*reversed(new.columns))])
    return whole.groupBy("source_rank", "Rain").agg(F.count("*").alias("n"))


@query(
    "d03_sliding_window",
    f"""with {OBS}{_DUP}, kept as (
      select * from both_parts where source_rank = 1 or ts >= (select min(ts) + interval 7 day from both_parts where source_rank = 0))
    select strftime(ts, '{_TS}') as ts, Latitude, Longitude, Rain, seq from (
      select *, row_number() over (partition by ts, Latitude, Longitude order by source_rank desc, seq desc) as rn
      from kept) where rn = 1""",
)
def _(spark, sf):
    old, new = (p.drop("source_rank") for p in _both(spark, sf))
    return dedup.sliding_window(old, new, "ts", order=["seq"]).select(S.stamp("ts").alias("ts"), "Latitude", "Longitude", "Rain", "seq")


@query(
    "d04_sorted_times",
    f"with {OBS} select distinct strftime(date_trunc('hour', Fetch_Time), '{_TS}') as hour from obs order by 1",
)
def _(spark, sf):
    hours = obs(spark, sf).select(S.floor_hour("Fetch_Time").alias("t")).distinct()
    return hours.orderBy("t").select(S.stamp("t").alias("hour"))


@query("d05_preview", f"with {OBS} select event_id, tier, Temperature, Rain from obs order by event_id limit 10")
def _(spark, sf):
    return obs(spark, sf).orderBy("event_id").limit(10).select("event_id", "tier", "Temperature", "Rain")


@query(
    "d06_sample_rows",
    f"with {OBS} select event_id, Rain from obs order by md5('42:' || cast(event_id as varchar)) limit 1000",
)
def _(spark, sf):
    return sampling.sample_rows(obs(spark, sf), 1000, "event_id").select("event_id", "Rain")


@query(
    "d07_neighbour_times",
    f"""with {OBS}, t as (select distinct date_trunc('hour', Fetch_Time) as h from obs)
    select strftime(h, '{_TS}') as h, strftime(coalesce(lag(h) over (order by h), h), '{_TS}') as previous,
      strftime(coalesce(lead(h) over (order by h), h), '{_TS}') as next from t""",
)
def _(spark, sf):
    hours = obs(spark, sf).select(S.floor_hour("Fetch_Time").alias("h"))
    return dedup.neighbours(hours, "h", "day").select(*[S.stamp(c).alias(c) for c in ("h", "previous", "next")])


# ---- snapshots of a table --------------------------------------------------
@query(
    "s03_latest_snapshot",
    f"with {CURRENT} select event_id, Temperature, Rain from current_rows where snapshot_id = (select max(snapshot_id) from current_rows)",
)
def _(spark, sf):
    return snapshots.latest_snapshot(current(spark, sf)).select("event_id", "Temperature", "Rain")


@query(
    "s04_last_snapshots",
    f"""with {CURRENT} select snapshot_id, count(*) as n from current_rows where snapshot_id in
      (select distinct snapshot_id from current_rows order by 1 desc limit 25) group by 1""",
)
def _(spark, sf):
    last = snapshots.last_snapshots(current(spark, sf), 25)
    return last.groupBy("snapshot_id").agg(F.count("*").alias("n"))


@query(
    "s11_retention_list",
    f"""with {CURRENT} select snapshot_id from (select distinct snapshot_id from current_rows) where snapshot_id not in
      (select distinct snapshot_id from current_rows order by 1 desc limit 100)""",
)
def _(spark, sf):
    return snapshots.expired_ids(current(spark, sf), 100)


_FILES = f"""with {CURRENT}, files as (select distinct tier, tier || '_' || snapshot_id || '.csv' as name from current_rows)"""


@query(
    "s13_newest_per_tier",
    _FILES + """ select tier, name, cast(rn as integer) as rn from (
      select *, row_number() over (partition by tier order by name desc) as rn from files) where rn <= 10""",
)
def _(spark, sf):
    named = current(spark, sf).select("tier", F.concat_ws("", "tier", F.lit("_"), "snapshot_id", F.lit(".csv")).alias("name"))
    return snapshots.newest_per_tier(named)


@query(
    "s15_availability",
    f"""with {CURRENT}, tiers as (select unnest(['click','view','error','signup','purchase','historic']) as tier)
    select t.tier, count(distinct c.snapshot_id) as snapshots, count(c.snapshot_id) = 0 as empty
    from tiers t left join current_rows c on c.tier = t.tier group by 1""",
)
def _(spark, sf):
    tiers = ["click", "view", "error", "signup", "purchase", "historic"]
    return snapshots.availability(current(spark, sf), tiers)


@query(
    "j04_all_hours",
    f"""with {OBS}, h as (select unnest(range(30)) as hour), g as (
      select hour(Fetch_Time) as hour, count(*) as n from obs group by 1)
    select cast(h.hour as integer) as hour, coalesce(n, 0) as n from h left join g on h.hour = g.hour""",
)
def _(spark, sf):
    counts = obs(spark, sf).groupBy(F.hour("Fetch_Time").alias("hour")).agg(F.count("*").alias("n"))
    return densify(counts, "hour", 0, 29, {"n": F.lit(0)})  # no row has hours from 24 on
