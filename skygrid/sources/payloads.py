"""Landed weather-service answers: one JSON document per request of at most 50 places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.constants import API_NAMES
from skygrid.functions.scalars import parse_time, rain_flag

_READINGS = "temperature_2m {0}, relative_humidity_2m {0}, cloud_cover {0}, surface_pressure {0}, wind_speed_10m {0}, rain {0}"
_ONE = _READINGS.format("DOUBLE")
_MANY = _READINGS.format("ARRAY<DOUBLE>")

#: An array schema also reads a lone object, so a one-place answer is kept.
CURRENT_SCHEMA = f"ARRAY<STRUCT<current: STRUCT<time STRING, {_ONE}>>>"
HOURLY_SCHEMA = f"ARRAY<STRUCT<hourly: STRUCT<time ARRAY<STRING>, {_MANY}>>>"

_READING_NAMES = {k: v for k, v in API_NAMES.items() if k != "time"}


def _places(bodies: DataFrame, schema: str, body: str, field: str, places: DataFrame) -> DataFrame:
    """One row per place of each answer, with the coordinates it was asked for.

    ``places(batch, pos, Latitude, Longitude)`` is the request list.
    """
    keep = [c for c in bodies.columns if c != body]
    parsed = bodies.select(*keep, F.posexplode(F.from_json(body, schema)).alias("pos", "answer"))
    parsed = parsed.select(*keep, "pos", F.col(f"answer.{field}").alias("reading"))
    return parsed.where(F.col("reading").isNotNull()).join(places, ["batch", "pos"])


def _measures(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}.{api}").alias(name) for api, name in _READING_NAMES.items()]


def parse_current(bodies: DataFrame, places: DataFrame, body: str = "body") -> DataFrame:
    """``bodies(batch, Fetch_Time, body)`` to raw current rows."""
    rows = _places(bodies, CURRENT_SCHEMA, body, "current", places)
    return rows.select(
        "Fetch_Time",
        "Latitude",
        "Longitude",
        *_measures("reading"),
        rain_flag("reading.rain").alias("Rain"),
    )


def parse_hourly(bodies: DataFrame, places: DataFrame, body: str = "body") -> DataFrame:
    """``bodies(batch, Fetch_Time, body)`` to raw forecast rows: parallel arrays to rows."""
    rows = _places(bodies, HOURLY_SCHEMA, body, "hourly", places)
    fields = ["time", *_READING_NAMES, "rain"]
    zipped = F.arrays_zip(*[F.col(f"reading.{f}").alias(f) for f in fields])
    hours = rows.select("Fetch_Time", "Latitude", "Longitude", F.explode(zipped).alias("hour"))
    return hours.select(
        "Fetch_Time",
        parse_time("hour.time").alias("Forecast_Time"),
        "Latitude",
        "Longitude",
        *_measures("hour"),
        rain_flag("hour.rain").alias("Rain"),
    )


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files as text, with the folder's partition columns."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")


# ---- border ----------------------------------------------------------------
_GEOJSON = "features ARRAY<STRUCT<geometry: STRUCT<coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>>>>"


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Sides (polygon, e, x1, y1, x2, y2) of the outer ring of every feature in a GeoJSON file."""
    shape = spark.read.schema(_GEOJSON).json(path, multiLine=True)
    rings = shape.select(F.posexplode("features").alias("polygon", "f")).select(
        "polygon", F.col("f.geometry.coordinates")[0].alias("ring")
    )
    n = F.size("ring")

    def side(vertex: Column, i: Column) -> Column:
        nxt = F.get("ring", (i + 1) % n)
        return F.struct(
            i.alias("e"),
            vertex[0].alias("x1"),
            vertex[1].alias("y1"),
            nxt[0].alias("x2"),
            nxt[1].alias("y2"),
        )

    return rings.select("polygon", F.inline(F.transform("ring", side))).where(
        (F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))
    )
