"""Forecasts against observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skygrid.functions.constants import CYCLE
from skygrid.functions.scalars import floor_hour, with_cell_keys
from skygrid.sources.snapshots import newest_ids

CELL = ["lat_e5", "lon_e5"]
CELL_HOUR = ["dt", *CELL]


def match(forecast: DataFrame, observed: DataFrame, keys: Sequence[str] = CELL_HOUR) -> DataFrame:
    """Every forecast row with every observation of the same hour and cell."""
    dropped = [c for c in forecast.columns if c in observed.columns and c not in keys]
    return observed.join(forecast.drop(*dropped), list(keys))


def match_counts(
    forecast: DataFrame,
    observed: DataFrame,
    forecast_values: Sequence[str],
    observed_values: Sequence[str],
    keys: Sequence[str] = CELL_HOUR,
) -> DataFrame:
    """The matched pairs as distinct values with the number of pairs, ``weight``.

    Each side is first counted by key and value. A key that holds a third of all rows thus meets
    its partner as a few counted rows, where the plain join would emit every pair.
    """
    f = forecast.groupBy(*keys, *forecast_values).agg(F.count("*").alias("nf"))
    o = observed.groupBy(*keys, *observed_values).agg(F.count("*").alias("no"))
    return (
        o.join(f, list(keys))
        .groupBy(*observed_values, *forecast_values)
        .agg(F.sum(F.col("nf") * F.col("no")).alias("weight"))
    )


def cycle_pairs(forecast: DataFrame, observed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of the 24-hour evaluation, each with its block number ``q``.

    Of the newest 25 observation snapshots the first is left out and the rest form four blocks of
    six; of the newest 5 forecasts the last is left out and the others serve one block each. All
    rows of an observation snapshot take the hour of its earliest fetch. Too few snapshots on
    either side give no rows. Snapshot ids are ranked among at most 25 and 5 distinct values.
    """
    n_f, n_o, size = CYCLE["forecasts"], CYCLE["observations"], CYCLE["block"]

    def ranked(df: DataFrame, n: int) -> DataFrame:
        ids = newest_ids(df, n).withColumn("rn", F.row_number().over(Window.orderBy("snapshot_id")))
        return ids.withColumn("found", F.count("*").over(Window.partitionBy()))

    f_ids = (
        ranked(forecast, n_f)
        .where((F.col("found") == n_f) & (F.col("rn") < n_f))
        .select("snapshot_id", F.col("rn").alias("q"))
    )
    o_ids = (
        ranked(observed, n_o)
        .where((F.col("found") == n_o) & (F.col("rn") > 1))
        .select("snapshot_id", (F.floor((F.col("rn") - 2) / size) + 1).cast("int").alias("q"))
    )
    chosen = observed.join(F.broadcast(o_ids), "snapshot_id")
    hours = chosen.groupBy("snapshot_id").agg(floor_hour(F.min("Fetch_Time")).alias("dt"))
    chosen = chosen.join(F.broadcast(hours), "snapshot_id")
    issued = forecast.join(F.broadcast(f_ids), "snapshot_id")
    issued = issued.withColumn("dt", F.col("Forecast_Target_Time"))
    return with_cell_keys(issued), with_cell_keys(chosen)


def with_measures(
    forecast: DataFrame, raw: DataFrame | None, measures: Sequence[str], keys: Sequence[str] = CELL_HOUR
) -> DataFrame:
    """Forecast rows with the raw measures; null measures where there is no raw side."""
    if raw is None:
        return forecast.withColumns({m: F.lit(None).cast("double") for m in measures})
    return match(forecast, raw.select(*keys, *measures), keys)


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    grain: str = "day",
) -> DataFrame:
    """Each left row with the newest right row of its key at or before its time.

    Times of a key are cut into ``grain`` long pieces. Inside a piece the last right value is
    carried forward; a piece that starts without one takes the last value of an earlier piece. So a
    key holding a third of all rows is spread over its pieces, rows of equal key and time are
    folded to one first, and no pair of rows that is not part of the result is made. Rows at the
    same right time are settled by the largest values.
    """
    keys = list(keys)
    carried = F.struct(F.col(right_time).alias("at"), *values)
    facts = right.groupBy(*keys, F.col(right_time).alias("t")).agg(F.max(carried).alias("fact"))
    asks = left.select(*keys, F.col(left_time).alias("t")).distinct().withColumn("ask", F.lit(True))
    line = facts.withColumn("ask", F.lit(False)).unionByName(
        asks.withColumn("fact", F.lit(None).cast(facts.schema["fact"].dataType))
    )
    line = line.withColumn("piece", F.date_trunc(grain, "t"))
    within = (
        Window.partitionBy(*keys, "piece")
        .orderBy("t", F.col("ask").cast("int"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    line = line.withColumn("seen", F.last("fact", ignorenulls=True).over(within))
    pieces = line.groupBy(*keys, "piece").agg(F.max("fact").alias("last"))
    earlier = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before", F.last("last", ignorenulls=True).over(earlier)).drop("last")
    answers = (
        line.where("ask")
        .join(pieces, [*keys, "piece"])
        .select(*keys, F.col("t").alias(left_time), F.coalesce("seen", "before").alias("fact"))
        .where(F.col("fact").isNotNull())
    )
    found = left.join(answers, [*keys, left_time])
    return found.select(
        *[F.col(c) for c in left.columns],
        F.col("fact.at").alias(right_time),
        *[F.col(f"fact.{v}").alias(v) for v in values],
    )


def densify(df: DataFrame, key: str, first: int, last: int, fill: dict[str, Column]) -> DataFrame:
    """One row per whole number of the range; values of absent ones are filled."""
    spark = df.sparkSession
    every = spark.range(first, last + 1).select(F.col("id").cast(df.schema[key].dataType).alias(key))
    return every.join(df, key, "left").select(
        key, *[F.coalesce(c, fill[c]).alias(c) if c in fill else c for c in df.columns if c != key]
    )
