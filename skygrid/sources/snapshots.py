"""Which snapshots a table holds, and reading some of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from skygrid.functions.constants import DASHBOARD_WINDOW_HOURS, EXPORT_PER_TIER
from skygrid.functions.scalars import normalise, time_column
from skygrid.operators.filters import newest_window

_MEASURES = "Temperature DOUBLE, Humidity DOUBLE, Wind_Speed DOUBLE, Cloud_Cover DOUBLE, Pressure DOUBLE"

#: Fixed table schemas; nothing is inferred from files.
SCHEMAS = {
    "raw_current": f"Fetch_Time TIMESTAMP, Latitude DOUBLE, Longitude DOUBLE, {_MEASURES}, Rain INT",
    "raw_future": (
        "Fetch_Time TIMESTAMP, Forecast_Time TIMESTAMP, Latitude DOUBLE, Longitude DOUBLE, "
        f"{_MEASURES}, Rain INT"
    ),
    "raw_historic": (
        "Timestamp TIMESTAMP, Temperature DOUBLE, Humidity DOUBLE, Cloud_Cover DOUBLE, "
        "Pressure DOUBLE, Wind_Speed DOUBLE, Location STRING, Latitude DOUBLE, Longitude DOUBLE, "
        "Rain INT"
    ),
    "forecast": (
        "Forecast_Target_Time TIMESTAMP, Latitude DOUBLE, Longitude DOUBLE, "
        "rain_probability DOUBLE, predicted_rain INT"
    ),
    "metrics": "run_id STRING, run_ts TIMESTAMP, kind STRING, name STRING, value DOUBLE",
}


# ---- files -----------------------------------------------------------------
def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """CSV with a header under a fixed schema."""
    return normalise(spark.read.schema(schema).option("header", True).csv(path))


def read_many_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: str, header: bool = True
) -> DataFrame:
    """All files together, kept readable when some are not.

    Damaged files are skipped; a line that does not fit the schema keeps its text in
    ``_corrupt_record`` so that it can be counted instead of vanishing. Lines are read whole, since
    a pruned column would hide its own damage.
    """
    wide = T.StructType(list(T.StructType.fromDDL(schema).fields)).add("_corrupt_record", "string")
    reader = (
        spark.read.schema(wide)
        .option("header", header)
        .option("columnPruning", False)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
    )
    return normalise(reader.csv(paths))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; columns missing from one are null there."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def id_in(name: Column, prefix: str) -> Column:
    """Snapshot id out of a file name, e.g. future_20260528_1000.csv."""
    return F.regexp_extract(name, prefix + r"_(\d{8}_\d{4})", 1)


def with_file_id(files: DataFrame, prefix: str) -> DataFrame:
    """Rows read from files with the ``snapshot_id`` their file's name carries."""
    return files.withColumn("snapshot_id", id_in(F.col("_metadata.file_name"), prefix))


def newest_file(files: DataFrame) -> DataFrame:
    """Rows of the most recently changed file of a landing folder."""
    df = files.withColumn("_changed", F.col("_metadata.file_modification_time"))
    newest = files.agg(F.max(F.col("_metadata.file_modification_time")).alias("t")).scalar()
    return df.where(F.col("_changed") == newest).drop("_changed")


# ---- snapshots of a table --------------------------------------------------
def newest_ids(df: DataFrame, n: int) -> DataFrame:
    """The last n distinct snapshot ids: a top-n, not a sort."""
    return df.select("snapshot_id").distinct().orderBy(F.desc("snapshot_id")).limit(n)


def latest_snapshot(df: DataFrame) -> DataFrame:
    newest = df.agg(F.max("snapshot_id").alias("s")).scalar()
    return df.where(F.col("snapshot_id") == newest)


def last_snapshots(df: DataFrame, n: int) -> DataFrame:
    """Rows of the last n snapshots.

    The n-th newest id is found first, so the rows are kept by a comparison on the partition value.
    """
    oldest_kept = newest_ids(df, n).agg(F.min("snapshot_id").alias("s")).scalar()
    return df.where(F.col("snapshot_id") >= oldest_kept)


def expired_ids(df: DataFrame, keep: int) -> DataFrame:
    """Distinct snapshot ids older than the newest ``keep``."""
    oldest_kept = newest_ids(df, keep).agg(F.min("snapshot_id").alias("s")).scalar()
    return df.select("snapshot_id").distinct().where(F.col("snapshot_id") < oldest_kept)


def newest_per_tier(files: DataFrame, k: int = EXPORT_PER_TIER) -> DataFrame:
    """Of (tier, name) rows the k last names of each tier; Spark trims each partition first."""
    rank = F.row_number().over(Window.partitionBy("tier").orderBy(F.desc("name")))
    named = files.select("tier", "name").distinct()
    return named.withColumn("rn", rank).where(F.col("rn") <= k)


def availability(files: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """Snapshots per tier, with tiers that have none."""
    spark = files.sparkSession
    counted = files.groupBy("tier").agg(F.countDistinct("snapshot_id").alias("snapshots"))
    named = spark.createDataFrame([(t,) for t in tiers], "tier string")
    found = F.coalesce("snapshots", F.lit(0))
    return named.join(counted, "tier", "left").select(
        "tier", found.alias("snapshots"), (found == 0).alias("empty")
    )


def load_tier(tier: str, df: DataFrame) -> DataFrame:
    """What the dashboard shows of a tier: the newest forecast, or the last 48 hours."""
    if tier in ("future", "processed_forecast"):
        df = latest_snapshot(df)
    name = time_column(df)
    if name is None:
        return df
    df = df.withColumn("_time", F.col(name).try_cast("timestamp"))
    if tier in ("historic", "current"):
        df = newest_window(df, "_time", hours=DASHBOARD_WINDOW_HOURS)
    return df


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
