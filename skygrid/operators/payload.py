"""Map payloads: the points of a time inside the border, flat or in arrays of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.functions.constants import BORDER, DASHBOARD_WINDOW_HOURS, PAYLOAD_NAMES
from skygrid.functions.scalars import no_nan, stamp
from skygrid.operators.filters import first_valid, newest_window
from skygrid.operators.geo import clip
from skygrid.operators.joins import with_measures

#: Points of one chunk at most.
CHUNK_POINTS = 2_000

_MEASURES = ["temperature", "humidity", "wind_speed", "cloud_cover", "pressure"]


def _point_fields(df: DataFrame) -> list[Column]:
    prob = "rain_probability"
    return [
        F.col("latitude"),
        F.col("longitude"),
        F.col("rain_label").cast("int").alias("rain_label"),
        (no_nan(prob) if prob in df.columns else F.lit(None).cast("double")).alias(prob),
        F.col("timestamp"),
        F.col("fetch_time"),
        *[no_nan(m).alias(m) for m in _MEASURES],
    ]


def map_points(df: DataFrame, time: str | None = None) -> DataFrame:
    """Flat payload points: every row inside the border with renamed columns and text times.

    ``time`` names the time column to group by; without it the fetch time serves. Places need not
    lie on the grid, and several rows of one time and place all stay.
    """
    df = clip(df, BORDER).withColumnsRenamed(PAYLOAD_NAMES)
    shown = F.col(time) if time and time not in PAYLOAD_NAMES else F.col("fetch_time")
    df = df.withColumn("timestamp", stamp(shown)).withColumn("fetch_time", stamp("fetch_time"))
    return df.select(*_point_fields(df))


def nested(points: DataFrame, size: int = CHUNK_POINTS) -> DataFrame:
    """(timestamp, chunk, fetch_time, points): the points of a time in arrays of at most ``size``.

    A time of more points is dealt into parts by a hash of the point, the parts are numbered each
    for itself, and every ``size`` points of a part are a chunk. No array and no window holds all
    points of a large time; chunks are numbered from 0 and may be less than full.
    """
    fields = points.columns
    counts = points.groupBy(F.col("timestamp").alias("at")).agg(F.ceil(F.count("*") / size).alias("parts"))
    dealt = points.join(counts, F.col("timestamp").eqNullSafe(F.col("at"))).withColumn("part", F.pmod(F.xxhash64(*fields), F.col("parts")))
    place = F.row_number().over(Window.partitionBy("timestamp", "part").orderBy(F.struct(*fields))) - 1
    chunk = F.col("part") + F.col("parts") * F.floor(place / size)
    return dealt.select(*fields, chunk.alias("chunk")).groupBy("timestamp", "chunk").agg(
        F.min("fetch_time").alias("fetch_time"),
        F.array_sort(F.collect_list(F.struct(*fields))).alias("points"),
    )


def forecast_points(forecast: DataFrame, raw: DataFrame | None, measures: Sequence[str]) -> DataFrame:
    """Points of a forecast (with cell keys and ``dt``) carrying the measures of the raw forecast.

    Without a raw side the measures are null. The fetch time of all points is the first valid one
    of the raw forecast, else the forecast hour.
    """
    said = with_measures(forecast, raw, measures)
    if raw is None:
        said = said.withColumn("Fetch_Time", F.col("dt"))
    else:
        fetched = first_valid(raw, "Fetch_Time", "dt").select("Fetch_Time").scalar()
        said = said.drop("Fetch_Time").withColumn("Fetch_Time", F.coalesce(fetched, "dt"))
    return map_points(said.withColumn("Rain", F.col("predicted_rain")), "dt")


def as_json(payload: DataFrame) -> DataFrame:
    return payload.select("timestamp", F.to_json(F.struct(*payload.columns)).alias("payload"))


def history_points(observed: DataFrame, time: str = "Fetch_Time") -> DataFrame:
    """Points of every snapshot of the newest 48 hours."""
    return map_points(newest_window(observed, time, hours=DASHBOARD_WINDOW_HOURS))
