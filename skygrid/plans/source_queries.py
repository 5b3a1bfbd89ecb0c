"""Reading and writing: files, payloads, snapshots, versions, retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.functions import scalars as S
from skygrid.operators import geo, metrics
from skygrid.operators.dedup import keep_last
from skygrid.plans.aggregate_queries import _counted
from skygrid.plans.dataset import CURRENT, DAILY, FC, OBS, daily, obs
from skygrid.plans.registry import query
from skygrid.session import scratch_path
from skygrid.sources import payloads, sinks, snapshots

_TS = "%Y-%m-%d %H:%M:%S"
_RAW = ["Fetch_Time", "Latitude", "Longitude", "Temperature", "Humidity", "Wind_Speed", "Cloud_Cover", "Pressure", "Rain"]
_BY_CELL = f"""select Latitude, Longitude, count(*) as n, sum(Rain)::bigint as rainy, round(avg(Temperature), 9) as temperature,
  strftime(min(Fetch_Time), '{_TS}') as first_time from daily group by 1, 2"""


def _by_cell(df: DataFrame) -> DataFrame:
    return df.groupBy("Latitude", "Longitude").agg(
        F.count("*").alias("n"),
        F.sum("Rain").alias("rainy"),
        F.round(F.avg("Temperature"), 9).alias("temperature"),
        S.stamp(F.min("Fetch_Time")).alias("first_time"),
    )


@query("s01_csv_scan", f"with {DAILY} {_BY_CELL}")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_snapshots(daily(spark, sf).select(*_RAW, "snapshot_id"), path, "csv")
    return _by_cell(sinks.read_snapshots(spark, path, snapshots.SCHEMAS["raw_current"], "csv"))


@query(
    "s02_union_with_damage",
    f"""with {OBS} select case when tier = 'error' then 'damaged' when event_id % 2 = 0 then 'csv' else 'parquet' end as part,
      count(*) as n, coalesce(sum(case when tier <> 'error' then Rain end), 0)::bigint as rainy from obs group by 1""",
)
def _(spark, sf):
    o = obs(spark, sf)
    csv, text, parquet = (scratch_path(spark, n) for n in ("part-csv", "part-text", "part-parquet"))
    good = o.where("tier <> 'error'")
    good.where("event_id % 2 = 0").select(*_RAW).write.option("header", True).csv(csv)
    damaged = F.format_string("not-a-time,%d,damaged", F.col("event_id"))
    o.where("tier = 'error'").select(damaged.alias("value")).write.text(text)
    good.where("event_id % 2 = 1").select("Fetch_Time", "Latitude", "Longitude", "Rain").write.parquet(parquet)
    whole = snapshots.union_all(
        [
            snapshots.read_many_csv(spark, csv, snapshots.SCHEMAS["raw_current"]).withColumn("part", F.lit("csv")),
            # Every line here is damaged, the first one too.
            snapshots.read_many_csv(spark, text, snapshots.SCHEMAS["raw_current"], header=False).withColumn("part", F.lit("csv")),
            spark.read.parquet(parquet).withColumn("part", F.lit("parquet")),
        ]
    )
    part = F.when(F.col("_corrupt_record").isNotNull(), "damaged").otherwise(F.col("part"))
    return whole.groupBy(part.alias("part")).agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.when(F.col("_corrupt_record").isNull(), F.col("Rain"))), F.lit(0)).alias("rainy"),
    )


@query(
    "s05_id_from_name",
    f"""with {CURRENT} select snapshot_id, count(*) as n from current_rows group by 1""",
)
def _(spark, sf):
    named = obs(spark, sf).select(F.format_string("future_%s.csv", S.snapshot_id(S.floor_hour("Fetch_Time"))).alias("name"))
    return named.groupBy(snapshots.id_in(F.col("name"), "future").alias("snapshot_id")).agg(F.count("*").alias("n"))


# ---- payloads --------------------------------------------------------------
_CELL_HOURS = """cell_hours as (select *, date_trunc('hour', Fetch_Time) as h from obs
  qualify row_number() over (partition by date_trunc('hour', Fetch_Time), cell order by event_id desc) = 1)"""


def _cell_hours(spark, sf) -> DataFrame:
    o = obs(spark, sf).withColumn("h", S.floor_hour("Fetch_Time")).drop("Latitude", "Longitude")
    last = keep_last(o, ["h", "cell"], ["event_id"])
    return last.withColumns({"batch": F.floor(F.col("cell") / 50), "pos": (F.col("cell") % 50).cast("int")})


def _places(spark) -> DataFrame:
    """The request list: every grid place with its batch and position."""
    grid = geo.grid(spark)
    return grid.select(
        F.floor(F.col("cell") / 50).alias("batch"), (F.col("cell") % 50).cast("int").alias("pos"), "Latitude", "Longitude"
    )


def _reading(amount) -> list:
    return [
        F.col("Temperature").alias("temperature_2m"),
        F.col("Humidity").alias("relative_humidity_2m"),
        F.col("Cloud_Cover").alias("cloud_cover"),
        F.col("Pressure").alias("surface_pressure"),
        F.col("Wind_Speed").alias("wind_speed_10m"),
        amount.alias("rain"),
    ]


def _answers(rows: DataFrame, keys: list[str], field: str) -> DataFrame:
    """One JSON body per key with up to 50 answers in request order; places without one are {}."""
    packed = rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("pos", field))).alias("m"))
    places = F.transform(F.sequence(F.lit(0), F.lit(49)), lambda p: F.struct(F.try_element_at("m", p).alias(field)))
    return packed.select(*keys, F.to_json(places).alias("body"))


_PARSED = "Temperature as temperature, Humidity as humidity, Wind_Speed as wind_speed, Cloud_Cover as cloud_cover, Pressure as pressure, Rain as rain"


def _shown(df: DataFrame, *first: str) -> DataFrame:
    names = ["Temperature", "Humidity", "Wind_Speed", "Cloud_Cover", "Pressure", "Rain"]
    return df.select(*first, "Latitude", "Longitude", *[F.col(n).alias(n.lower()) for n in names])


def _current_bodies(spark, sf) -> DataFrame:
    """One answer per hour and batch; a dry place has no amount in half of the cells, and 0 in the others."""
    amount = F.when(F.col("Rain") == 1, 0.5).when(F.col("cell") % 2 == 0, 0.0)
    rows = _cell_hours(spark, sf).withColumn("current", F.struct(S.stamp("h").alias("time"), *_reading(amount)))
    return _answers(rows, ["h", "batch"], "current").withColumnRenamed("h", "Fetch_Time")


@query(
    "s06_current_payload",
    f"with {OBS}, {_CELL_HOURS} select strftime(h, '{_TS}') as fetch, Latitude, Longitude, {_PARSED} from cell_hours",
)
def _(spark, sf):
    found = payloads.parse_current(_current_bodies(spark, sf), _places(spark))
    return _shown(found.withColumn("fetch", S.stamp("Fetch_Time")), "fetch")


def _hourly_bodies(spark, sf) -> DataFrame:
    """One answer per day and batch: the hours of that day as parallel arrays."""
    amount = F.when(F.col("Rain") == 1, 1.25)
    rows = _cell_hours(spark, sf).withColumn("day", F.date_trunc("day", "h"))
    fields = ["time", "temperature_2m", "relative_humidity_2m", "cloud_cover", "surface_pressure", "wind_speed_10m", "rain"]
    # At most 24 hours of a day per cell.
    series = rows.groupBy("day", "batch", "pos").agg(
        F.array_sort(F.collect_list(F.struct(F.date_format("h", "yyyy-MM-dd'T'HH:mm").alias("time"), *_reading(amount)))).alias("hours")
    )
    # A missing amount stays as null inside its array.
    series = series.withColumn("hourly", F.struct(*[F.col(f"hours.{f}").alias(f) for f in fields]))
    return _answers(series, ["day", "batch"], "hourly").withColumnRenamed("day", "Fetch_Time")


@query(
    "s07_hourly_payload",
    f"""with {OBS}, {_CELL_HOURS} select strftime(date_trunc('day', h), '{_TS}') as fetch, strftime(h, '{_TS}') as forecast, Latitude, Longitude, {_PARSED}
    from cell_hours""",
)
def _(spark, sf):
    found = payloads.parse_hourly(_hourly_bodies(spark, sf), _places(spark))
    found = found.withColumns({"fetch": S.stamp("Fetch_Time"), "forecast": S.stamp("Forecast_Time")})
    return _shown(found, "fetch", "forecast")


# ---- sinks -----------------------------------------------------------------
@query(
    "s09_snapshot_overwrite",
    f"""with {DAILY}, last as (select distinct snapshot_id from daily order by 1 desc limit 3)
    select snapshot_id, count(*) as n, sum(case when snapshot_id in (from last) then 1 - Rain else Rain end)::bigint as rainy from daily group by 1""",
)
def _(spark, sf):
    path = scratch_path(spark, "snapshots")
    rows = daily(spark, sf).select(*_RAW, "snapshot_id")
    sinks.write_snapshots(rows, path)
    again = snapshots.last_snapshots(rows, 3).withColumn("Rain", 1 - F.col("Rain"))
    sinks.write_snapshots(again, path)
    back = sinks.read_snapshots(spark, path, snapshots.SCHEMAS["raw_current"])
    return back.groupBy("snapshot_id").agg(F.count("*").alias("n"), F.sum("Rain").alias("rainy"))


@query("s10_table_versions", f"with {OBS} select tier, count(*) as n from obs where Rain = 1 group by 1")
def _(spark, sf):
    root = scratch_path(spark, "versions")
    sinks.replace_table(obs(spark, sf), root)
    first = sinks.read_table(spark, root)
    sinks.replace_table(first.where("Rain = 1"), root)  # reads the old version while writing
    return sinks.read_table(spark, root).groupBy("tier").agg(F.count("*").alias("n"))


@query(
    "s11_retention_drop",
    f"with {DAILY} select snapshot_id, count(*) as n from daily where snapshot_id in (select distinct snapshot_id from daily order by 1 desc limit 20) group by 1",
)
def _(spark, sf):
    path = scratch_path(spark, "retained")
    sinks.write_snapshots(daily(spark, sf).select(*_RAW, "snapshot_id"), path)
    sinks.drop_expired(spark, path, 20)
    back = sinks.read_snapshots(spark, path, snapshots.SCHEMAS["raw_current"])
    return back.groupBy("snapshot_id").agg(F.count("*").alias("n"))


@query("s12_csv_export", f"with {DAILY} {_BY_CELL}")
def _(spark, sf):
    path = scratch_path(spark, "export")
    tier = obs(spark, sf).select(*_RAW).withColumn("_time", F.col("Fetch_Time"))
    sinks.export_csv(tier, path)
    return _by_cell(snapshots.read_csv(spark, path, snapshots.SCHEMAS["raw_current"]))


@query(
    "s14_metrics_table",
    f"""with {FC} select 'daily' as run_id, 'metric' as kind, 'tp' as name, cast(count(*) filter (where Rain = 1 and predicted_rain = 1) as double) as value from matched
    union all select 'daily', 'metric', 'fp', cast(count(*) filter (where Rain = 0 and predicted_rain = 1) as double) from matched
    union all select 'daily', 'metric', 'fn', cast(count(*) filter (where Rain = 1 and predicted_rain = 0) as double) from matched
    union all select 'daily', 'metric', 'tn', cast(count(*) filter (where Rain = 0 and predicted_rain = 0) as double) from matched""",
)
def _(spark, sf):
    path = scratch_path(spark, "metrics")
    rows = sinks.metric_rows(metrics.confusion(_counted(spark, sf), weight="weight"), "daily", datetime(2024, 2, 1))
    sinks.append_metrics(rows, path)
    return sinks.read_metrics(spark, path).drop("run_ts")
