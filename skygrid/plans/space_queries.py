"""Grid, border, sites, and forecasts joined with observations."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from skygrid.functions import scalars as S
from skygrid.functions.constants import BORDER, SITES
from skygrid.operators import geo, joins, metrics, payload
from skygrid.plans.dataset import (
    CURRENT,
    FC,
    ISSUES,
    OBS,
    STREWN,
    current,
    fc,
    issues,
    obs,
    odd_obs,
    strewn,
    r6,
    s6,
)
from skygrid.plans.registry import query
from skygrid.session import scratch_path
from skygrid.sources.payloads import read_edges

_TS = "%Y-%m-%d %H:%M:%S"

_EDGES = "edges as (select * from (values " + ", ".join(
    f"({x1!r}::double, {y1!r}::double, {x2!r}::double, {y2!r}::double)" for x1, y1, x2, y2 in geo.ring_edges(BORDER)
) + ") t(x1, y1, x2, y2))"

_INSIDE = _EDGES + """,
cells as (select distinct Latitude, Longitude from obs),
inside as (select Latitude, Longitude from cells join edges on
  Latitude > least(y1, y2) and Latitude <= greatest(y1, y2) and Longitude <= greatest(x1, x2)
  and (x1 = x2 or Longitude <= (Latitude - y1) * (x2 - x1) / (y2 - y1) + x1)
  group by 1, 2 having count(*) % 2 = 1)"""

_SITES = "sites as (select * from (values " + ", ".join(
    f"('{n}', {la!r}::double, {lo!r}::double, {c})" for n, la, lo, c in SITES
) + ") t(name, lat, lon, code))"

_NEAREST = _SITES + """,
nearest as (select Latitude, Longitude, code, name from (
  select Latitude, Longitude, code, name, row_number() over (partition by Latitude, Longitude order by
    (Latitude - lat)*(Latitude - lat) + (Longitude - lon)*(Longitude - lon), code) as rn
  from (select distinct Latitude, Longitude from obs) cross join sites) where rn = 1)"""


# ---- grid and border -------------------------------------------------------
@query(
    "f03_inside_border",
    f"with {OBS}, {_INSIDE} select event_id, Latitude, Longitude from obs join inside using (Latitude, Longitude)",
)
def _(spark, sf):
    return geo.clip(obs(spark, sf)).select("event_id", "Latitude", "Longitude")


_GRID = """grid as (select i as cell, round(-6.36e0 + cast(i // 20 as double) * (36.0e-2/19e0), 5) as Latitude,
  round(106.33e0 + cast(i % 20 as double) * (44.0e-2/19e0), 5) as Longitude from (select unnest(range(400)) as i))"""


@query(
    "g01_grid_coverage",
    f"""with {OBS}, {_GRID} select g.cell, g.Latitude, g.Longitude, count(o.event_id) as n
    from grid g left join obs o on o.Latitude = g.Latitude and o.Longitude = g.Longitude group by 1, 2, 3""",
)
def _(spark, sf):
    seen = S.with_cell_keys(obs(spark, sf)).groupBy("lat_e5", "lon_e5").agg(F.count("*").alias("n"))
    points = S.with_cell_keys(geo.grid(spark))
    return points.join(seen, ["lat_e5", "lon_e5"], "left").select(
        "cell", "Latitude", "Longitude", F.coalesce("n", F.lit(0)).alias("n")
    )


@query(
    "g02_clipped_grid",
    f"""with {OBS}, {_INSIDE} select Latitude, Longitude, count(*) as n, sum(Rain)::bigint as rainy
    from obs join inside using (Latitude, Longitude) group by 1, 2""",
)
def _(spark, sf):
    inside = geo.clip(geo.grid(spark))
    seen = S.with_cell_keys(obs(spark, sf)).groupBy("lat_e5", "lon_e5").agg(
        F.count("*").alias("n"), F.sum("Rain").alias("rainy")
    )
    return S.with_cell_keys(inside).join(seen, ["lat_e5", "lon_e5"]).select("Latitude", "Longitude", "n", "rainy")


@query(
    "g03_nearest_site",
    f"""with {OBS}, {_NEAREST} select event_id, cast(case when event_id % 50 = 0 then 0 else code end as integer) as code,
      case when event_id % 50 = 0 then null else name end as name
    from obs join nearest using (Latitude, Longitude)""",
)
def _(spark, sf):
    lat = F.when(F.col("event_id") % 50 != 0, F.col("Latitude"))
    site = geo.nearest_site(lat, "Longitude")
    return obs(spark, sf).select("event_id", site["code"].alias("code"), site["name"].alias("name"))


@query(
    "g04_request_batches",
    f"""with {STREWN}, {_INSIDE}, numbered as (
      select *, row_number() over (order by Latitude, Longitude) - 1 as idx from inside)
    select idx // 50 as batch, count(*) as n, round(sum(Latitude), 6) as lat_sum, round(sum(Longitude), 6) as lon_sum,
      round(min_by(Longitude, idx), 5) as first_lon, round(max_by(Latitude, idx), 5) as last_lat
    from numbered group by 1""",
)
def _(spark, sf):
    places = geo.clip(strewn(spark, sf)).select("Latitude", "Longitude").distinct()
    batches = geo.request_batches(places, ["Latitude", "Longitude"])
    lats, lons = (F.transform(F.split(c, ","), lambda v: v.cast("double")) for c in ("lat_text", "lon_text"))

    def total(a):
        return F.round(F.aggregate(a, F.lit(0.0), lambda s, v: s + v), 6)

    return batches.select(
        "batch",
        "n",
        total(lats).alias("lat_sum"),
        total(lons).alias("lon_sum"),
        F.round(F.get(lons, F.lit(0)), 5).alias("first_lon"),
        F.round(F.element_at(lats, -1), 5).alias("last_lat"),
    )


_STATUS = """case when Rain is not null and event_id % 3 <> 0 then (case when Rain = 1 then 'Rain' else 'Clear' end)
  when Cloud_Cover > 60 then 'Possible rain' else 'Clear' end"""


@query(
    "g05_map_headline",
    f"""with {CURRENT}, {_INSIDE} select count(*) as points, count(*) filter (where {_STATUS} <> 'Clear') as rainy,
      {s6('avg(Temperature)')} as temperature, {s6('avg(coalesce(nullif(Humidity, 50e0), 0e0))')} as humidity
    from current_rows join inside using (Latitude, Longitude)""",
)
def _(spark, sf):
    points = geo.clip(current(spark, sf)).withColumns(
        {
            "label": F.when(F.col("event_id") % 3 != 0, F.col("Rain")),
            "Humidity": F.expr("nullif(Humidity, 50D)"),
        }
    )
    h = geo.headline(points, "label", "Cloud_Cover", "Temperature", "Humidity")
    return h.select("points", "rainy", r6("temperature").alias("temperature"), r6("humidity").alias("humidity"))


# ---- joins -----------------------------------------------------------------
@query(
    "j01_forecast_join",
    f"""with {FC} select event_id, strftime(dt, '{_TS}') as dt, Latitude, Longitude, Rain, predicted_rain, rain_probability
    from matched""",
)
def _(spark, sf):
    found = joins.match(fc(spark, sf), odd_obs(spark, sf))
    return found.select("event_id", S.stamp("dt").alias("dt"), "Latitude", "Longitude", "Rain", "predicted_rain", "rain_probability")


_CYCLE = ISSUES + """,
o_ids as (select snapshot_id, row_number() over (order by snapshot_id) as rn from
  (select distinct snapshot_id from current_rows order by 1 desc limit 25)),
f_ids as (select snapshot_id, row_number() over (order by snapshot_id) as rn from
  (select distinct snapshot_id from issues order by 1 desc limit 5)),
pairs as (select o.event_id, o.Rain, o.Latitude, o.Longitude, oi.rn, (oi.rn - 2)//6 + 1 as q, i.predicted_rain, i.rain_probability
  from current_rows o join o_ids oi using (snapshot_id)
  join f_ids fi on fi.rn = (oi.rn - 2)//6 + 1 and oi.rn > 1 and fi.rn < 5
  join issues i on i.snapshot_id = fi.snapshot_id and i.Latitude = o.Latitude and i.Longitude = o.Longitude
    and i.Forecast_Target_Time = date_trunc('hour', o.Fetch_Time)
  where (select count(*) from o_ids) = 25 and (select count(*) from f_ids) = 5)"""


@query(
    "j02_cycle_join",
    f"with {_CYCLE} select cast(q as integer) as q, event_id, Rain, predicted_rain, rain_probability from pairs",
)
def _(spark, sf):
    f, o = joins.cycle_pairs(issues(spark, sf), current(spark, sf))
    found = joins.match(f, o, ["q", *joins.CELL_HOUR])
    return found.select("q", "event_id", "Rain", "predicted_rain", "rain_probability")


@query(
    "j02_cycle_report",
    f"""with {_CYCLE}, c as (select sum(case when Rain=1 and predicted_rain=1 then 1 else 0 end) as tp,
        sum(case when Rain=0 and predicted_rain=1 then 1 else 0 end) as fp,
        sum(case when Rain=1 and predicted_rain=0 then 1 else 0 end) as fn,
        sum(case when Rain=0 and predicted_rain=0 then 1 else 0 end) as tn from pairs)
    select tp::bigint as tp, fp::bigint as fp, fn::bigint as fn, tn::bigint as tn, {s6('(tp+tn)/(tp+fp+fn+tn)')} as accuracy,
      {s6('coalesce(tp/nullif(tp+fp,0),0e0)')} as precision, {s6('coalesce(tp/nullif(tp+fn,0),0e0)')} as recall,
      {s6('coalesce(2*tp/nullif(2*tp+fp+fn,0),0e0)')} as f1 from c""",
)
def _(spark, sf):
    f, o = joins.cycle_pairs(issues(spark, sf), current(spark, sf))
    counted = joins.match_counts(f, o, ["predicted_rain"], ["Rain"], ["q", *joins.CELL_HOUR])
    out = metrics.scores(metrics.confusion(counted, weight="weight"))
    return out.select("tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query(
    "j03_nearest_join",
    f"""with {OBS}, {_NEAREST} select Latitude, Longitude, cast(code as integer) as code, name from nearest""",
)
def _(spark, sf):
    sites = spark.createDataFrame([(n, la, lo, c) for n, la, lo, c in SITES], "name string, lat double, lon double, code int")
    found = geo.join_nearest(obs(spark, sf), sites)
    return found.select("Latitude", "Longitude", F.col("site.code").alias("code"), F.col("site.name").alias("name"))


def _border_file(spark) -> str:
    """The border as a GeoJSON file in the shared folder."""
    shape = {
        "type": "FeatureCollection",
        "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [BORDER]}}],
    }
    path = scratch_path(spark, "border")
    spark.createDataFrame([(json.dumps(shape),)], "value string").coalesce(1).write.text(path)
    return path


@query(
    "j05_polygon_join",
    f"""with {STREWN}, {_INSIDE} select tier, count(*) as n, sum(event_id)::bigint as ids
    from obs join inside using (Latitude, Longitude) group by 1""",
)
def _(spark, sf):
    edges = read_edges(spark, _border_file(spark))
    seen = strewn(spark, sf)
    inside = geo.locate(seen, edges)
    return seen.join(inside, ["Latitude", "Longitude"]).groupBy("tier").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids")
    )


@query(
    "s08_border_zones",
    f"""with {OBS}, {_INSIDE} select 'whole' as zone, count(*) as n from obs join inside using (Latitude, Longitude)
    union all select 'south', count(*) from obs where Latitude > -6.4 and Latitude <= -6.2 and Longitude <= 106.5 and Longitude > 106.3""",
)
def _(spark, sf):
    zones = {0: ("whole", BORDER), 1: ("south", [(106.3, -6.4), (106.5, -6.4), (106.5, -6.2), (106.3, -6.2)])}
    shape = {"features": [{"geometry": {"coordinates": [ring]}} for _, ring in zones.values()]}
    path = scratch_path(spark, "zones")
    spark.createDataFrame([(json.dumps(shape),)], "value string").coalesce(1).write.text(path)
    seen = obs(spark, sf)
    where = geo.locate(seen, read_edges(spark, path))
    name = F.when(F.col("polygon") == 0, zones[0][0]).otherwise(zones[1][0])
    return seen.join(where, ["Latitude", "Longitude"]).groupBy(name.alias("zone")).agg(F.count("*").alias("n"))


@query(
    "j06_without_measures",
    f"""with {FC} select strftime(dt, '{_TS}') as dt, Latitude, Longitude, predicted_rain,
      cast(null as double) as Temperature, cast(null as double) as Humidity from fc""",
)
def _(spark, sf):
    bare = joins.with_measures(fc(spark, sf), None, ["Temperature", "Humidity"])
    return bare.select(S.stamp("dt").alias("dt"), "Latitude", "Longitude", "predicted_rain", "Temperature", "Humidity")


@query(
    "j07_forecast_as_of",
    f"""with {OBS}, f as (select Latitude, Longitude, Fetch_Time as issued, ((event_id*31)%1000)/1000e0 as p from obs where event_id % 2 = 0)
    select o.event_id, strftime(f.issued, '{_TS}') as issued, f.p from (select * from obs where event_id % 2 = 1) o
    asof join f on o.Latitude = f.Latitude and o.Longitude = f.Longitude and o.Fetch_Time >= f.issued""",
)
def _(spark, sf):
    o = S.with_cell_keys(obs(spark, sf))
    f = o.where("event_id % 2 = 0").select(
        "lat_e5", "lon_e5", F.col("Fetch_Time").alias("issued"), (((F.col("event_id") * 31) % 1000).cast("double") / 1000.0).alias("p")
    )
    left = o.where("event_id % 2 = 1").select("event_id", "lat_e5", "lon_e5", "Fetch_Time")
    found = joins.as_of(left, f, ["lat_e5", "lon_e5"], "Fetch_Time", "issued", ["p"])
    return found.select("event_id", S.stamp("issued").alias("issued"), "p")


# ---- map payloads ----------------------------------------------------------
_POINTS = """points as (select strftime(date_trunc('hour', Fetch_Time), '%Y-%m-%d %H:%M:%S') as timestamp, Latitude as latitude, Longitude as longitude,
    Rain as rain_label, Temperature as temperature, Humidity as humidity from obs join inside using (Latitude, Longitude))"""


def _hourly_points(spark, sf):
    o = strewn(spark, sf).withColumn("Fetch_Time", S.floor_hour("Fetch_Time"))
    return payload.map_points(o)


@query(
    "a27_map_payload",
    f"""with {STREWN}, {_INSIDE}, {_POINTS}
    select timestamp, latitude, longitude, rain_label, temperature, humidity from points""",
)
def _(spark, sf):
    nested = payload.nested(_hourly_points(spark, sf), 16)
    flat = nested.select(F.inline("points"))
    return flat.select("timestamp", "latitude", "longitude", "rain_label", "temperature", "humidity")


@query(
    "a27_payload_json",
    f"""with {STREWN}, {_INSIDE}, {_POINTS} select timestamp, count(*) as points, sum(rain_label)::bigint as rainy from points group by 1""",
)
def _(spark, sf):
    text = payload.as_json(payload.nested(_hourly_points(spark, sf), 16))
    schema = "points ARRAY<STRUCT<rain_label: INT>>"
    labels = F.from_json("payload", schema)["points"]["rain_label"]
    return text.groupBy("timestamp").agg(
        F.sum(F.size(labels)).alias("points"),
        F.sum(F.aggregate(labels, F.lit(0).cast("bigint"), lambda s, v: s + v)).alias("rainy"),
    )


@query(
    "a28_history_points",
    f"""with {STREWN}, {_INSIDE}, {_POINTS} select timestamp, count(*) as points, sum(rain_label)::bigint as rainy from points
    where timestamp >= (select strftime(max(date_trunc('hour', Fetch_Time)) - interval 48 hour, '{_TS}') from obs) group by 1""",
)
def _(spark, sf):
    o = strewn(spark, sf).withColumn("Fetch_Time", S.floor_hour("Fetch_Time"))
    points = payload.history_points(o)
    return points.groupBy("timestamp").agg(F.count("*").alias("points"), F.sum("rain_label").alias("rainy"))


@query(
    "p18_time_default",
    f"""with {STREWN}, {_INSIDE} select strftime(Fetch_Time, '{_TS}') as timestamp, strftime(Fetch_Time, '{_TS}') as fetch_time, count(*) as n
    from obs join inside using (Latitude, Longitude) group by 1, 2""",
)
def _(spark, sf):
    """Without a time column of their own, points bear their fetch time."""
    return payload.map_points(strewn(spark, sf)).groupBy("timestamp", "fetch_time").agg(F.count("*").alias("n"))


@query(
    "a27_forecast_payload",
    f"""with {FC}, {_INSIDE} select strftime(dt, '{_TS}') as timestamp, count(*) as points, sum(predicted_rain)::bigint as rainy,
      {s6('sum(rain_probability)')} as prob from fc join inside using (Latitude, Longitude) group by 1""",
)
def _(spark, sf):
    nested = payload.nested(payload.forecast_points(fc(spark, sf), None, _MEASURES), 16)
    probs = F.aggregate(F.col("points.rain_probability"), F.lit(0.0), lambda s, v: s + v)
    rainy = F.aggregate(F.col("points.rain_label"), F.lit(0).cast("bigint"), lambda s, v: s + v)
    return nested.groupBy("timestamp").agg(
        F.sum(F.size("points")).alias("points"), F.sum(rainy).alias("rainy"), r6(F.sum(probs)).alias("prob")
    )


_MEASURES = ["Temperature", "Humidity", "Wind_Speed", "Cloud_Cover", "Pressure"]


@query(
    "a27_forecast_map",
    f"""with {FC}, {_INSIDE}, raw as (select date_trunc('hour', Fetch_Time) as dt, Latitude, Longitude,
        {', '.join(f'max({m}) as {m}' for m in _MEASURES)}, min(Fetch_Time) as Fetch_Time from obs group by 1, 2, 3),
      first as (select arg_min(Fetch_Time, dt) as fetched from (select dt, min(Fetch_Time) as Fetch_Time from raw group by 1))
    select strftime(dt, '{_TS}') as timestamp, strftime(fetched, '{_TS}') as fetch_time, Latitude as latitude, Longitude as longitude, predicted_rain as rain_label,
      rain_probability, {', '.join(f'{m} as {m.lower()}' for m in _MEASURES)}
    from fc join raw using (dt, Latitude, Longitude) join inside using (Latitude, Longitude) cross join first""",
)
def _(spark, sf):
    hours = S.with_cell_keys(obs(spark, sf)).withColumn("dt", S.floor_hour("Fetch_Time"))
    raw = hours.groupBy("dt", "lat_e5", "lon_e5").agg(F.min("Fetch_Time").alias("Fetch_Time"), *[F.max(m).alias(m) for m in _MEASURES])
    header = raw.groupBy("dt").agg(F.min("Fetch_Time").alias("Fetch_Time"))
    raw = raw.drop("Fetch_Time").join(header, "dt")
    flat = payload.nested(payload.forecast_points(fc(spark, sf), raw, _MEASURES)).select(F.inline("points"))
    return flat.select(
        "timestamp", "fetch_time", "latitude", "longitude", "rain_label", "rain_probability", *[m.lower() for m in _MEASURES]
    )
