"""Grid, border and reference sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.constants import (
    BORDER,
    GRID_SIDE,
    LAT_RANGE,
    LON_RANGE,
    REQUEST_BATCH,
    SITES,
)
from skygrid.functions.scalars import col, rain_text
from skygrid.operators.ranks import numbered
from skygrid.session import scratch_path

Ring = Sequence[tuple[float, float]]


# ---- grid ------------------------------------------------------------------
def _steps(bounds: tuple[float, float], side: int) -> float:
    return (bounds[1] - bounds[0]) / (side - 1)


def grid(
    spark: SparkSession,
    side: int = GRID_SIDE,
    lat: tuple[float, float] = LAT_RANGE,
    lon: tuple[float, float] = LON_RANGE,
) -> DataFrame:
    """Evenly spaced points, ends included, numbered row by row from the south-west."""
    cell = F.col("id")
    return spark.range(side * side).select(
        cell.alias("cell"),
        F.round(F.lit(lat[0]) + F.floor(cell / side) * F.lit(_steps(lat, side)), 5).alias("Latitude"),
        F.round(F.lit(lon[0]) + (cell % side) * F.lit(_steps(lon, side)), 5).alias("Longitude"),
    )


def request_batches(points: DataFrame, order: Sequence[str] = ("cell",), size: int = REQUEST_BATCH) -> DataFrame:
    """Points in chunks of ``size`` with their coordinates as comma-joined text.

    Points are numbered by ``order`` over all tasks (see ``ranks.numbered``).
    """
    packed = numbered(points, order).groupBy(F.floor(F.col("idx") / size).alias("batch")).agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_list(F.struct("idx", "Latitude", "Longitude"))).alias("pts"),
    )

    def joined(field: str) -> Column:
        return F.concat_ws(",", F.transform("pts", lambda p: p[field].cast("string")))

    return packed.select(
        "batch", "n", joined("Latitude").alias("lat_text"), joined("Longitude").alias("lon_text")
    )


# ---- border ----------------------------------------------------------------
def ring_edges(ring: Ring) -> list[tuple[float, float, float, float]]:
    """(x1, y1, x2, y2) for each side; the ring is closed if its last vertex is not its first."""
    closed = [*ring, ring[0]] if tuple(ring[0]) != tuple(ring[-1]) else list(ring)
    return [(*a, *b) for a, b in zip(closed, closed[1:])]


def _crosses(lat: Column, lon: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether the ray to the east of the point meets the edge: south end out, north end in."""
    at = (lat - y1) * (x2 - x1) / F.when(y1 != y2, y2 - y1) + x1
    reach = (lon <= F.greatest(x1, x2)) & ((x1 == x2) | (lon <= at))
    return (lat > F.least(y1, y2)) & (lat <= F.greatest(y1, y2)) & reach


def _banded(ring: Ring, bands: int) -> tuple[Column, float, float]:
    """Edges listed under each of ``bands`` latitude bands, as one constant; first band, width."""
    south, north = min(p[1] for p in ring), max(p[1] for p in ring)
    width = (north - south) / bands
    listed: list[list[str]] = [[] for _ in range(bands + 1)]
    for x1, y1, x2, y2 in ring_edges(ring):
        if y1 == y2:
            continue  # a level edge is never crossed
        low, high = sorted((y1, y2))
        edge = (
            f"named_struct('x1', {x1!r}D, 'y1', {y1!r}D, 'dx', {x2 - x1!r}D, 'dy', {y2 - y1!r}D, "
            f"'low', {low!r}D, 'high', {high!r}D, 'east', {max(x1, x2)!r}D)"
        )
        for band in range(int((low - south) / width), int((high - south) / width) + 1):
            listed[min(band, bands)].append(edge)
    text = ", ".join(f"array({', '.join(edges)})" for edges in listed if edges)
    if not all(listed):
        raise ValueError("a latitude band without edges: the ring is not closed")
    return F.expr(f"array({text})"), south, width


def _in_box(y: Column, x: Column, ring: Ring) -> Column:
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    return (y >= min(ys)) & (y <= max(ys)) & (x <= max(xs)) & (x >= min(xs))


def _odd_crossings(y: Column, x: Column, ring: Ring, bands: int = 64) -> Column:
    """Whether the ray to the east meets an odd number of edges.

    A point is compared with the few edges of its latitude band only. Spelling every edge out as
    its own term makes a method too long for the JVM to compile, which is several times slower.
    """
    edges, south, width = _banded(ring, bands)

    def hit(e: Column) -> Column:
        reach = (y > e["low"]) & (y <= e["high"]) & (x <= e["east"])
        return reach & ((e["dx"] == 0) | (x <= (y - e["y1"]) * e["dx"] / e["dy"] + e["x1"]))

    here = F.get(edges, F.floor((y - south) / width).cast("int"))
    return F.size(F.filter(here, hit)) % 2 == 1


def inside(lat: Column | str, lon: Column | str, ring: Ring = BORDER) -> Column:
    """Even-odd test against one ring as one expression; a missing coordinate is outside."""
    y, x = col(lat), col(lon)
    return F.coalesce(_in_box(y, x, ring) & _odd_crossings(y, x, ring), F.lit(False))


def clip(df: DataFrame, ring: Ring = BORDER, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """Rows inside the ring; its bounding box reaches the scan as pushed filters."""
    y, x = col(lat), col(lon)
    return df.where(_in_box(y, x, ring)).where(_odd_crossings(y, x, ring))


def locate(points: DataFrame, edges: DataFrame, band: float = 0.01, tile: float = 0.05) -> DataFrame:
    """(Latitude, Longitude, polygon) for every polygon each distinct place lies in.

    ``edges(polygon, x1, y1, x2, y2)`` may hold any number of polygons. Polygons are listed under
    the tiles their bounding boxes cover, so a place meets only polygons around it, and of those
    only the edges of its own latitude band. Places are decided by their exact coordinates.
    """
    places = points.select("Latitude", "Longitude").where("Latitude IS NOT NULL AND Longitude IS NOT NULL").distinct()
    places = places.withColumns(
        {"ty": F.floor(F.col("Latitude") / tile), "tx": F.floor(F.col("Longitude") / tile), "band": F.floor(F.col("Latitude") / band)}
    )
    boxes = edges.groupBy("polygon").agg(
        F.min(F.least("y1", "y2")).alias("south"),
        F.max(F.greatest("y1", "y2")).alias("north"),
        F.min(F.least("x1", "x2")).alias("west"),
        F.max(F.greatest("x1", "x2")).alias("east"),
    )

    def steps(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(low) / tile), F.floor(F.col(high) / tile)))

    tiled = boxes.withColumn("ty", steps("south", "north")).withColumn("tx", steps("west", "east"))
    in_box = F.col("Latitude").between(F.col("south"), F.col("north")) & F.col("Longitude").between(F.col("west"), F.col("east"))
    near = places.join(tiled, ["ty", "tx"]).where(in_box).select("Latitude", "Longitude", "band", "polygon")
    span = F.sequence(F.floor(F.least("y1", "y2") / band), F.floor(F.greatest("y1", "y2") / band))
    banded = edges.where("y1 <> y2").withColumn("band", F.explode(span))
    hit = _crosses(*[F.col(c) for c in ("Latitude", "Longitude", "x1", "y1", "x2", "y2")])
    return (
        near.join(banded, ["polygon", "band"])
        .where(hit)
        .groupBy("polygon", "Latitude", "Longitude")
        .agg(F.count("*").alias("hits"))
        .where(F.col("hits") % 2 == 1)
        .select("Latitude", "Longitude", "polygon")
    )


# ---- reference sites -------------------------------------------------------
def nearest_site(lat: Column | str, lon: Column | str, sites=SITES) -> Column:
    """struct(d, code, name) of the site at least squared-degree distance.

    Equal distances go to the lower code. Without coordinates the code is 0 and the name null.
    """
    y, x = col(lat), col(lon)

    def candidate(site) -> Column:
        name, s_lat, s_lon, code = site
        dy, dx = y - F.lit(s_lat), x - F.lit(s_lon)
        return F.struct(
            (dy * dy + dx * dx).alias("d"), F.lit(code).alias("code"), F.lit(name).alias("name")
        )

    best = F.least(*[candidate(s) for s in sites]) if len(sites) > 1 else candidate(sites[0])
    missing = F.struct(
        F.lit(None).cast("double").alias("d"),
        F.lit(0).alias("code"),
        F.lit(None).cast("string").alias("name"),
    )
    return F.when(y.isNotNull() & x.isNotNull(), best).otherwise(missing)


def join_nearest(points: DataFrame, sites: DataFrame) -> DataFrame:
    """Each distinct place with its nearest row of ``sites(name, lat, lon, code)``.

    Places meet the sites of their own and the eight tiles around it. A site found within one tile's
    width is the nearest; other places are tried again with tiles twice as wide. The first tiles
    hold about one site each, so a place meets few sites unless it is far from all of them.
    """
    spark = points.sparkSession
    places = points.select("Latitude", "Longitude").distinct()
    kind = "struct<d:double,code:int,name:string>"
    missing = F.struct(F.lit(None).cast("double").alias("d"), F.lit(0).alias("code"), F.lit(None).cast("string").alias("name")).cast(kind)
    extent = sites.where("lat IS NOT NULL AND lon IS NOT NULL").agg(
        F.count("*").alias("n"), F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")
    ).first()
    n, south, north, west, east = extent
    away = places.where("Latitude IS NULL OR Longitude IS NULL")
    found = (away if n else places).select("Latitude", "Longitude", missing.alias("site"))
    if not n:
        return found
    width = max((max(north - south, 1e-6) * max(east - west, 1e-6) / n) ** 0.5, 1e-6)
    left = places.where("Latitude IS NOT NULL AND Longitude IS NOT NULL")
    while True:

        def tile(c: str) -> Column:
            return F.floor(F.col(c) / width)

        around = F.array(F.lit(-1), F.lit(0), F.lit(1))
        asked = left.withColumn("ty", F.explode(F.transform(around, lambda k: tile("Latitude") + k)))
        asked = asked.withColumn("tx", F.explode(F.transform(around, lambda k: tile("Longitude") + k)))
        dy, dx = F.col("Latitude") - F.col("lat"), F.col("Longitude") - F.col("lon")
        site = F.struct((dy * dy + dx * dx).alias("d"), F.col("code").cast("int").alias("code"), F.col("name"))
        met = asked.join(sites.withColumn("ty", tile("lat")).withColumn("tx", tile("lon")), ["ty", "tx"])
        best = met.groupBy("Latitude", "Longitude").agg(F.min(site).alias("site"))
        path = scratch_path(spark, "nearest")
        left.join(best, ["Latitude", "Longitude"], "left").write.parquet(path)
        tried = spark.read.schema(f"Latitude double, Longitude double, site {kind}").parquet(path)
        near = F.coalesce(F.col("site.d") <= F.lit(width * width), F.lit(False))
        found = found.unionByName(tried.where(near))
        left = tried.where(~near).select("Latitude", "Longitude")
        if left.isEmpty():
            return found
        width *= 2


def headline(points: DataFrame, label: str, cloud: str, temperature: str, humidity: str) -> DataFrame:
    """Points, rainy points, mean temperature and humidity with missing readings as 0."""
    rainy = rain_text(label, cloud) != "Clear"
    return points.agg(
        F.count("*").alias("points"),
        F.count_if(rainy).alias("rainy"),
        F.coalesce(F.avg(F.coalesce(col(temperature), F.lit(0.0))), F.lit(0.0)).alias("temperature"),
        F.coalesce(F.avg(F.coalesce(col(humidity), F.lit(0.0))), F.lit(0.0)).alias("humidity"),
    )
