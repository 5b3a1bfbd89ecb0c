import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skygrid.functions.constants import BORDER
from skygrid.operators import geo
from skygrid.session import checkpoint_root, scratch_path
from skygrid.sources import payloads, sinks, snapshots
from skygrid.streaming import streams

PLACES = "batch int, pos int, Latitude double, Longitude double"
READING = {"temperature_2m": 25.0, "relative_humidity_2m": 80.0, "cloud_cover": 10.0, "surface_pressure": 1008.0, "wind_speed_10m": 5.0}


def bodies(spark, *texts):
    rows = [(i, datetime(2026, 5, 28), t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "batch int, Fetch_Time timestamp, body string")


def places(spark, batches=1):
    return spark.createDataFrame([(b, p, -6.0 - p / 10, 106.5) for b in range(batches) for p in range(3)], PLACES)


def test_current_with_missing_null_and_empty(spark):
    answer = [{"current": {**READING, "rain": 0.4}}, {}, {"current": {**READING, "rain": None}}]
    rows = payloads.parse_current(bodies(spark, answer), places(spark)).orderBy(F.desc("Latitude")).collect()
    assert [(r.Latitude, r.Rain) for r in rows] == [(-6.0, 1), (-6.2, 0)]
    assert rows[0].Wind_Speed == 5.0


def test_lone_answer_and_broken_text(spark):
    lone = {"current": {**READING}}
    found = payloads.parse_current(bodies(spark, lone, "{not json"), places(spark, 2)).collect()
    assert [(r.Latitude, r.Rain) for r in found] == [(-6.0, 0)]


def test_hourly_arrays(spark):
    hourly = {"time": ["2026-05-28T07:00", "2026-05-28T08:00"], "rain": [None, 0.2], **{k: [v, v + 1] for k, v in READING.items()}}
    rows = payloads.parse_hourly(bodies(spark, [{"hourly": hourly}]), places(spark)).orderBy("Forecast_Time").collect()
    assert [(r.Forecast_Time, r.Temperature, r.Rain) for r in rows] == [
        (datetime(2026, 5, 28, 7), 25.0, 0),
        (datetime(2026, 5, 28, 8), 26.0, 1),
    ]


def test_border_file(spark, tmp_path):
    path = tmp_path / "border.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [{"geometry": {"type": "Polygon", "coordinates": [BORDER]}}]}, indent=1))
    edges = payloads.read_edges(spark, str(path)).orderBy("e").collect()
    assert [(r.x1, r.y1, r.x2, r.y2) for r in edges] == geo.ring_edges(BORDER) and len(edges) == 30


HEADER = "Fetch_Time,Latitude,Longitude,Temperature,Humidity,Wind_Speed,Cloud_Cover,Pressure,Rain\n"
LINE = "2026-05-28 07:00:00,-6.2,106.5,25.5,80,5,10,1008.2,{}\n"


def test_files_with_names_and_damage(spark, tmp_path):
    for i, body in enumerate([HEADER + LINE.format(0), HEADER + LINE.format(1) + "oops,1\n"]):
        (tmp_path / f"current_20260528_100{i}.csv").write_text(body)
        os.utime(tmp_path / f"current_20260528_100{i}.csv", (1_000_000 + i, 1_000_000 + i))
    df = snapshots.read_many_csv(spark, str(tmp_path), snapshots.SCHEMAS["raw_current"])
    named = snapshots.with_file_id(df, "current")
    good = named.where("_corrupt_record is null").orderBy("snapshot_id").collect()
    assert [(r.snapshot_id, r.Rain, r.Humidity) for r in good] == [("20260528_1000", 0, 80.0), ("20260528_1001", 1, 80.0)]
    assert len(named.where("_corrupt_record is not null").collect()) == 1
    plain = spark.read.schema(snapshots.SCHEMAS["raw_current"]).option("header", True).csv(str(tmp_path))
    assert snapshots.newest_file(plain).where("Rain is not null").count() == 1


def test_retention_keeps_the_newest(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.createDataFrame([(f"20260528_100{i}", i) for i in range(5)], "snapshot_id string, v int")
    sinks.write_snapshots(df, path)
    assert sinks.drop_expired(spark, path, 3) == ["20260528_1000", "20260528_1001"]
    left = sinks.read_snapshots(spark, path, "v INT").select("snapshot_id").distinct().collect()
    assert sorted(r.snapshot_id for r in left) == ["20260528_1002", "20260528_1003", "20260528_1004"]
    assert sinks.drop_expired(spark, path, 3) == []


def test_overwrite_replaces_one_snapshot(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "snapshot_id string, v int")
    sinks.write_snapshots(first, path)
    sinks.write_snapshots(first.where("snapshot_id = 'b'").withColumn("v", F.lit(9)), path)
    rows = sinks.read_snapshots(spark, path, "v INT").collect()
    assert sorted((r.snapshot_id, r.v) for r in rows) == [("a", 1), ("b", 9)]


def test_tier_loading(spark):
    rows = [("20260528_1000", datetime(2026, 5, 28, 10), 1), ("20260525_1000", datetime(2026, 5, 25, 10), 2)]
    df = spark.createDataFrame(rows, "snapshot_id string, Fetch_Time timestamp, v int")
    assert [r.v for r in snapshots.load_tier("current", df).collect()] == [1]
    assert [r.v for r in snapshots.load_tier("future", df).collect()] == [1]
    assert snapshots.load_tier("historic", df.drop("Fetch_Time")).count() == 2


def test_union_fills_missing_columns(spark):
    whole = snapshots.union_all([spark.range(1).selectExpr("id as a", "1 as b"), spark.range(1).selectExpr("id as a")])
    assert sorted(r.b or 0 for r in whole.collect()) == [0, 1]


def test_shared_folder_is_the_named_one(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


# ---- streaming -------------------------------------------------------------
def test_ingest_reads_each_file_once(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    for i in range(2):
        (landing / f"current_20260528_100{i}.csv").write_text(HEADER + LINE.format(i))
        stream = streams.landed(spark, str(landing), snapshots.SCHEMAS["raw_current"], "csv", files=1)
        found = streams.run_once(stream, out)
        assert found.count() == i + 1


def test_upsert_keeps_the_last_over_batches(spark, tmp_path):
    merge = streams.upsert_last(str(tmp_path / "t"), ["k"], ["seq"])
    fields = "snapshot_id string, k int, seq int, v int"
    first = spark.createDataFrame([("a", 1, 1, 10), ("a", 2, 2, 20), ("b", 1, 3, 30)], fields)
    second = spark.createDataFrame([("a", 1, 0, 5), ("a", 2, 9, 99)], fields)
    for batch in (first, second, second):
        merge(batch, 0)
    rows = spark.read.schema(fields).parquet(str(tmp_path / "t")).collect()
    assert sorted((r.snapshot_id, r.k, r.v) for r in rows) == [("a", 1, 10), ("a", 2, 99), ("b", 1, 30)]


@pytest.mark.parametrize("width", ["48 hours"])
def test_sliding_equals_rowwise_windows(spark, small, width):
    from skygrid.plans.dataset import obs

    o = obs(spark, small).select("Fetch_Time", "Temperature")
    two = o.groupBy(F.window("Fetch_Time", width, "1 hour")).agg(F.avg("Temperature").alias("Temperature"))
    one = streams.sliding_means(o, "Fetch_Time", ["Temperature"], width)
    a = {r.window.start: r.Temperature for r in one.collect()}
    b = {r.window.start: r.Temperature for r in two.collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
