import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skygrid.functions.constants import BORDER, SITES
from skygrid.operators import geo


def ray_cast(lat, lon, ring):
    """Count the edges a ray to the east meets, one by one."""
    hits = 0
    for x1, y1, x2, y2 in geo.ring_edges(ring):
        if min(y1, y2) < lat <= max(y1, y2) and lon <= max(x1, x2):
            if x1 == x2 or lon <= (lat - y1) * (x2 - x1) / (y2 - y1) + x1:
                hits += 1
    return hits % 2 == 1


def points_of(spark, rows):
    return spark.createDataFrame(rows, "Latitude double, Longitude double")


def test_grid_and_clip(spark):
    grid = geo.grid(spark)
    assert grid.count() == 400
    ends = grid.agg(F.min("Latitude"), F.max("Latitude"), F.min("Longitude"), F.max("Longitude")).first()
    assert tuple(ends) == (-6.36, -6.0, 106.33, 106.77)
    assert geo.clip(grid).count() == 262


def test_clip_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "grid")
    geo.grid(spark).write.parquet(path)
    plan = geo.clip(spark.read.parquet(path)).select("cell")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(Latitude" in plan
    assert "Exchange" not in plan and "Python" not in plan


def test_missing_and_border_points(spark):
    rows = [(None, 106.5), (-6.2, None), *[(y, x) for x, y in BORDER], (-6.2, 106.6)]
    found = points_of(spark, rows).select(geo.inside("Latitude", "Longitude").alias("i")).collect()
    expected = [False, False, *[ray_cast(y, x, BORDER) for x, y in BORDER], True]
    assert [r.i for r in found] == expected


@settings(max_examples=15, deadline=None)
@given(
    ring=st.lists(
        st.tuples(st.floats(106.0, 107.0, width=32), st.floats(-7.0, -6.0, width=32)), min_size=3, max_size=9, unique=True
    ).filter(lambda r: max(p[1] for p in r) - min(p[1] for p in r) > 0.01),
    points=st.lists(st.tuples(st.floats(-7.0, -6.0, width=32), st.floats(106.0, 107.0, width=32)), min_size=1, max_size=20),
)
def test_inside_is_the_ray_cast(spark, ring, points):
    points = points + [(y, x) for x, y in ring]
    found = points_of(spark, points).select(geo.inside("Latitude", "Longitude", ring).alias("i")).collect()
    assert [r.i for r in found] == [ray_cast(y, x, ring) for y, x in points]


def test_locate_with_two_polygons(spark):
    square = [(106.4, -6.3), (106.6, -6.3), (106.6, -6.1), (106.4, -6.1)]
    rings = {0: BORDER, 1: square}
    edges = spark.createDataFrame(
        [(p, *e) for p, ring in rings.items() for e in geo.ring_edges(ring)],
        "polygon int, x1 double, y1 double, x2 double, y2 double",
    )
    grid = geo.grid(spark)
    found = {(r.polygon, r.Latitude, r.Longitude) for r in geo.locate(grid, edges).collect()}
    expected = {
        (p, r.Latitude, r.Longitude)
        for p, ring in rings.items()
        for r in grid.collect()
        if ray_cast(r.Latitude, r.Longitude, ring)
    }
    assert found == expected


def test_nearest_site(spark):
    rows = [(-6.2427, 106.5173), (-6.3407, 106.7371), (-6.2226, 106.6533), (None, 106.5)]
    found = points_of(spark, rows).select(geo.nearest_site("Latitude", "Longitude").alias("s")).collect()
    assert [r.s.code for r in found] == [4, 7, 0, 0]
    assert found[3].s.name is None


def test_equal_distance_takes_the_lower_code(spark):
    sites = [("b", 1.0, 0.0, 1), ("a", -1.0, 0.0, 0)]
    found = points_of(spark, [(0.0, 0.0)]).select(geo.nearest_site("Latitude", "Longitude", sites).alias("s"))
    assert found.first().s.code == 0


def test_join_nearest_agrees_with_the_expression(spark):
    sites = spark.createDataFrame([tuple(s) for s in SITES], "name string, lat double, lon double, code int")
    grid = geo.grid(spark)
    one = {(r.Latitude, r.Longitude, r.site.code) for r in geo.join_nearest(grid, sites).collect()}
    two = grid.select("Latitude", "Longitude", geo.nearest_site("Latitude", "Longitude")["code"].alias("c"))
    assert one == {tuple(r) for r in two.collect()}


def test_request_batches(spark):
    batches = geo.request_batches(geo.clip(geo.grid(spark))).orderBy("batch").collect()
    assert [b.n for b in batches] == [50] * 5 + [12]
    assert all(len(b.lat_text.split(",")) == b.n for b in batches)


def test_places_close_together_are_decided_one_by_one(spark):
    square = [(106.4, -6.3), (106.6, -6.3), (106.6, -6.1), (106.4, -6.1)]
    edges = spark.createDataFrame([(0, *e) for e in geo.ring_edges(square)], "polygon int, x1 double, y1 double, x2 double, y2 double")
    places = points_of(spark, [(-6.2, 106.599999), (-6.2, 106.600001), (-6.2, 106.400001), (None, 106.5)])
    assert {r.Longitude for r in geo.locate(places, edges).collect()} == {106.599999, 106.400001}


def test_join_nearest_with_many_sites_and_far_places(spark):
    rng = random.Random(3)
    sites = [(f"s{i}", rng.uniform(-7, -6), rng.uniform(106, 107), i) for i in range(6000)] + [("twin", 5.0, 5.0, 9001), ("twin", 5.0, 5.0, 9000)]
    rows = [(rng.uniform(-7, -6), rng.uniform(106, 107)) for _ in range(60)] + [(0.0, 0.0), (60.0, -170.0), (5.0, 5.0), (None, 1.0)]
    table = spark.createDataFrame(sites, "name string, lat double, lon double, code int")
    found = {(r.Latitude, r.Longitude): r.site.code for r in geo.join_nearest(points_of(spark, rows), table).collect()}
    for y, x in rows[:-1]:
        assert found[(y, x)] == min(((y - s[1]) ** 2 + (x - s[2]) ** 2, s[3]) for s in sites)[1]
    assert found[(None, 1.0)] == 0
    nothing = geo.join_nearest(points_of(spark, rows[:2]), table.limit(0)).collect()
    assert [r.site.code for r in nothing] == [0, 0]
