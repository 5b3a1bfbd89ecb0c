"""The hourly cycle as Structured Streaming jobs over landed files.

Every job stops when it has read what is there (``availableNow``); run with a processing-time
trigger it goes on. The checkpoint folder makes a restart carry on where the last run stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.scalars import normalise
from skygrid.operators.dedup import keep_last
from skygrid.sources.sinks import write_snapshots


def landed(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None, files: int | None = None
) -> DataFrame:
    """New files of a folder; ``files`` bounds how many one micro-batch takes."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    if fmt == "csv":
        reader = reader.option("header", True)
    return normalise(reader.load(path))


def append_to(stream: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """Append results as Parquet; with ``every`` such as '1 hour' the job keeps running."""
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_once(stream: DataFrame, path: str) -> DataFrame:
    """Run to the end of what has landed and read the result table."""
    append_to(stream, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    spark = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


# ---- duplicates ------------------------------------------------------------
def first_only(stream: DataFrame, time: str, keys: Sequence[str], delay: str = "2 hours") -> DataFrame:
    """The first row of each key; state of a key is dropped once the watermark has passed it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def upsert_last(path: str, keys: Sequence[str], order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` step keeping the last row per key in a table by ``snapshot_id``.

    Only the snapshots present in the batch are read and replaced. A batch that is run again after
    a failure finds its own rows and leaves the same table.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(folder):
            touched = batch.select("snapshot_id").distinct()
            old = spark.read.schema(batch.schema).parquet(path).join(touched, "snapshot_id", "left_semi")
            batch = old.unionByName(batch)
        kept = keep_last(batch, ["snapshot_id", *keys], order)
        write_snapshots(kept, path)

    return merge


# ---- windows ---------------------------------------------------------------
def hourly_rollup(df: DataFrame, time: str, label: str, delay: str = "1 hour") -> DataFrame:
    """Rain per hour; on a stream an hour is given out once the watermark has passed its end."""
    if df.isStreaming:
        df = df.withWatermark(time, delay)
    return df.groupBy(F.window(time, "1 hour")).agg(
        F.avg(label).alias("rain_rate"), F.sum(label).alias("rainy_points"), F.count(label).alias("total_points")
    )


def sliding_means(
    df: DataFrame, time: str, measures: Sequence[str], width: str = "48 hours", delay: str = "1 hour"
) -> DataFrame:
    """Means over the last 48 hours, every hour.

    Rows are summed per hour first, so that what is copied into the 48 windows an hour belongs to
    is one row per hour and not every row.
    """
    if df.isStreaming:
        df = df.withWatermark(time, delay)
    hours = df.groupBy(F.window(time, "1 hour").alias("hour")).agg(
        *[F.sum(m).alias(f"{m}_s") for m in measures], *[F.count(m).alias(f"{m}_n") for m in measures]
    )
    slid = hours.groupBy(F.window(F.window_time("hour"), width, "1 hour")).agg(
        *[F.sum(f"{m}_s").alias(f"{m}_s") for m in measures], *[F.sum(f"{m}_n").alias(f"{m}_n") for m in measures]
    )
    means = [F.try_divide(F.col(f"{m}_s").cast("double"), F.col(f"{m}_n")).alias(m) for m in measures]
    return slid.select("window", *means)


def rain_spells(df: DataFrame, time: str, keys: Sequence[str], label: str = "Rain", gap: str = "6 hours") -> DataFrame:
    """Rainy readings of a place joined into spells while the next comes within the gap.

    Readings of one hour are folded first; a spell's rows are then hours, however many readings.
    """
    if df.isStreaming:
        df = df.withWatermark(time, gap)
    wet = df.where(F.col(label) == 1)
    hours = wet.groupBy(*keys, F.window(time, "1 hour").alias("hour")).agg(F.count("*").alias("n"))
    at = F.window_time("hour").alias("at")
    return (
        hours.select(*keys, "n", at)
        .groupBy(*keys, F.session_window("at", gap).alias("spell"))
        .agg(F.sum("n").alias("readings"), F.count("*").alias("hours"))
    )


# ---- evaluation ------------------------------------------------------------
def match_streams(
    forecast: DataFrame, observed: DataFrame, keys: Sequence[str], time: str = "dt", delay: str = "12 hours"
) -> DataFrame:
    """Forecasts and observations of the same hour and cell as both arrive."""
    f, o = forecast.withWatermark(time, delay), observed.withWatermark(time, delay)
    return o.join(f, [time, *keys])
