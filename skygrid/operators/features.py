"""Scaling, power transform and the feature tables for serving and training."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.constants import (
    MEASURES,
    SERVING_COLUMNS,
    TRAIN_WINDOW_DAYS,
    TRAINING_COLUMNS,
    UTC_OFFSET_HOURS,
)
from skygrid.functions.scalars import col, cyclic, in_order, parse_time, stamp, time_column, to_utc
from skygrid.functions.scalars import wide_to_rows
from skygrid.operators.filters import newest_window
from skygrid.operators.geo import nearest_site
from skygrid.operators.ranks import numbered, value_counts


@dataclass(frozen=True)
class Shaping:
    """Frozen parameters of one measure: scale, power, and scale of the powered values."""

    mean: float
    std: float
    power: float
    out_mean: float
    out_std: float


# ---- standard scaling ------------------------------------------------------
def fit_scale(df: DataFrame, features: Sequence[str] = MEASURES) -> DataFrame:
    """(feature, mean, std): population deviation, 1 where a feature is constant."""
    wide = df.agg(
        *[F.avg(F.col(f).cast("double")).alias(f"{f}__m") for f in features],
        *[F.stddev_pop(F.col(f).cast("double")).alias(f"{f}__s") for f in features],
    )
    rows = wide_to_rows(
        wide, {"mean": [f"{f}__m" for f in features], "std": [f"{f}__s" for f in features]}, features
    )
    return rows.withColumn("std", F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))


def scaled(c: Column | str, mean: float, std: float) -> Column:
    return (col(c) - F.lit(float(mean))) / F.lit(float(std))


# ---- Yeo-Johnson -----------------------------------------------------------
def powered(x: Column, power: Column | float) -> Column:
    """Yeo-Johnson of x. The logarithmic cases are powers 0 (x >= 0) and 2 (x < 0)."""
    if isinstance(power, Column):
        up = F.when(F.abs(power) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, power) - 1) / power)
        rest = F.lit(2.0) - power
        down = F.when(F.abs(rest) < 1e-12, -F.log1p(-x)).otherwise((1 - F.pow(1 - x, rest)) / rest)
    else:
        rest = 2.0 - power
        up = F.log1p(x) if abs(power) < 1e-12 else (F.pow(x + 1, F.lit(power)) - 1) / F.lit(power)
        down = -F.log1p(-x) if abs(rest) < 1e-12 else (1 - F.pow(1 - x, F.lit(rest))) / F.lit(rest)
    return F.when(x >= 0, up).otherwise(down)


def likelihoods(values: DataFrame, powers: DataFrame) -> DataFrame:
    """(feature, power, loglik) for every candidate in ``powers(feature, power_list)``.

    ``values(feature, x, c)`` are distinct scaled values with counts. Candidates are spread per
    distinct value and summed in the task that made them, so one row per candidate is shuffled.
    """
    x, c = F.col("x"), F.col("c")
    spread = values.join(F.broadcast(powers), "feature")  # one row per feature
    spread = spread.withColumn("power", F.explode("power_list"))
    spread = spread.withColumn("t", powered(x, F.col("power")))
    sums = spread.groupBy("feature", "power").agg(
        F.sum("c").alias("n"),
        F.sum(c * F.col("t")).alias("s1"),
        F.sum(c * F.col("t") * F.col("t")).alias("s2"),
        F.sum(c * F.signum(x) * F.log1p(F.abs(x))).alias("jac"),
    )
    mean = F.col("s1") / F.col("n")
    var = F.col("s2") / F.col("n") - mean * mean
    fit = F.when(var > 0, F.col("n") * F.lit(-0.5) * F.log(var) + (F.col("power") - 1) * F.col("jac"))
    return sums.select("feature", "power", fit.alias("loglik"))


def _fit_powers(values: DataFrame, features: Sequence[str], points: int = 33) -> dict[str, float]:
    """The likeliest power of each feature.

    Each round reads all features at once on a grid, then shifts or narrows each feature's range;
    the last step is the vertex of the parabola through the best three points. What reaches the
    driver per round is one number per feature and grid point.
    """
    spark = values.sparkSession
    span = {f: (-3.0, 5.0) for f in features}
    best: dict[str, float] = {}
    for _ in range(12):
        open_ = [f for f in features if f not in best]
        if not open_:
            break
        grids = {f: [span[f][0] + (span[f][1] - span[f][0]) * i / (points - 1) for i in range(points)] for f in open_}
        table = spark.createDataFrame(list(grids.items()), "feature string, power_list array<double>")
        found = {(r.feature, r.power): r.loglik for r in likelihoods(values, table).collect()}
        for f in open_:
            grid = grids[f]
            fit = [found.get((f, p)) for p in grid]
            known = [i for i, v in enumerate(fit) if v is not None]
            if not known:
                best[f] = 1.0  # constant feature: leave it as it is
                continue
            at = max(known, key=lambda i: fit[i])
            step = grid[1] - grid[0]
            if at in (0, points - 1):
                width = grid[-1] - grid[0]
                span[f] = (grid[at] - width / 2, grid[at] + width / 2)
            elif step > 0.02:
                span[f] = (grid[at - 1], grid[at + 1])
            else:
                a, b, c = fit[at - 1], fit[at], fit[at + 1]
                bend = a - 2 * b + c
                best[f] = grid[at] + (0.5 * step * (a - c) / bend if bend else 0.0)
    return {f: best.get(f, sum(span[f]) / 2) for f in features}


def fit_shaping(df: DataFrame, features: Sequence[str] = MEASURES) -> dict[str, Shaping]:
    """Fit scale and power on the raw historic table; a handful of numbers per measure."""
    scale = {r.feature: (r.mean, r.std) for r in fit_scale(df, features).collect()}
    raw = value_counts(df, features)
    per_feature = F.create_map(
        *[v for f, (m, s) in scale.items() for v in (F.lit(f), F.array(F.lit(m), F.lit(s)))]
    )
    params = per_feature[F.col("feature")]
    values = raw.withColumn("x", (F.col("x") - params[0]) / params[1])
    values = values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        powers = _fit_powers(values, features)
        cases = F.create_map(*[v for f, p in powers.items() for v in (F.lit(f), F.lit(p))])
        t, c = powered(F.col("x"), cases[F.col("feature")]), F.col("c")
        out = values.groupBy("feature").agg(
            (F.sum(c * t) / F.sum(c)).alias("m"), (F.sum(c * t * t) / F.sum(c)).alias("q")
        )
        after = {r.feature: (r.m, max(r.q - r.m * r.m, 0.0) ** 0.5) for r in out.collect()}
    finally:
        values.unpersist()
    return {
        f: Shaping(*scale[f], powers[f], after[f][0], after[f][1] or 1.0) for f in features
    }


def shaped(c: Column | str, s: Shaping) -> Column:
    """Scale, power, scale again, with the frozen numbers as literals."""
    return scaled(powered(scaled(c, s.mean, s.std), s.power), s.out_mean, s.out_std)


def shaping_table(spark, params: Mapping[str, Shaping]) -> DataFrame:
    rows = [(f, s.mean, s.std, s.power, s.out_mean, s.out_std) for f, s in params.items()]
    return spark.createDataFrame(
        rows, "feature string, mean double, std double, power double, out_mean double, out_std double"
    )


def load_shaping(df: DataFrame) -> dict[str, Shaping]:
    """Parameters back from a stored ``shaping_table`` (one row per measure)."""
    return {r.feature: Shaping(r.mean, r.std, r.power, r.out_mean, r.out_std) for r in df.collect()}


# ---- label encoding --------------------------------------------------------
def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(column, code): codes 0, 1, 2... in alphabetical order of the distinct names."""
    names = df.select(column).where(F.col(column).isNotNull()).distinct()
    return numbered(names, [column], "code").withColumn("code", F.col("code").cast("int"))


# ---- feature tables --------------------------------------------------------
def _with_features(df: DataFrame, params: Mapping[str, Shaping], offset_hours: int) -> DataFrame:
    """Time parts, site, cyclic parts and shaped measures; only projections."""
    utc = to_utc("Timestamp", offset_hours)
    site = nearest_site("Latitude", "Longitude")
    df = df.withColumns({"Hour": F.hour(utc), "Month": F.month(utc), "_site": site})
    return df.withColumns(
        {
            "Location_Encoded": F.col("_site.code"),
            "Location": F.col("_site.name"),
            **cyclic("Hour", "Month"),
            **{m: shaped(m, s) for m, s in params.items() if m in df.columns},
        }
    )


def serving_features(
    df: DataFrame, params: Mapping[str, Shaping], offset_hours: int = UTC_OFFSET_HOURS, extra: Sequence[str] = ()
) -> DataFrame:
    """Raw forecast rows to the 16 columns the model is served with (and ``extra`` ones)."""
    name = "Forecast_Time" if "Forecast_Time" in df.columns else "time" if "time" in df.columns else time_column(df)
    df = df.withColumn("Timestamp", parse_time(name))
    return in_order(_with_features(df, params, offset_hours), [*SERVING_COLUMNS, *extra])


def training_features(
    df: DataFrame,
    params: Mapping[str, Shaping],
    days: int = TRAIN_WINDOW_DAYS,
    offset_hours: int = UTC_OFFSET_HOURS,
    extra: Sequence[str] = (),
) -> DataFrame:
    """The newest days of observations as training rows, with the site's name and text times.

    ``offset_hours=0`` takes hour and month from the local fetch time.
    """
    df = df.withColumn("Timestamp", parse_time("Fetch_Time"))
    df = newest_window(df, "Timestamp", days=days)
    out = _with_features(df, params, offset_hours).withColumn("Timestamp", stamp("Timestamp"))
    return in_order(out, [*TRAINING_COLUMNS, *extra])
