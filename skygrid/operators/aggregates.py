"""Summaries behind the dashboard and the data exploration."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.scalars import floor_hour, percent, unit_of, unpivot, wide_to_rows
from skygrid.operators import selection
from skygrid.operators.joins import densify
from skygrid.operators.ranks import quantiles, value_counts


# ---- dashboard -------------------------------------------------------------
def headline_means(df: DataFrame, measures: Sequence[str], label: str = "Rain") -> DataFrame:
    return df.agg(
        *[F.avg(m).alias(m) for m in measures], percent(F.avg(label)).alias("rain_rate")
    )


def mean_by_time(df: DataFrame, time: str, measures: Sequence[str]) -> DataFrame:
    return df.where(F.col(time).isNotNull()).groupBy(time).agg(*[F.avg(m).alias(m) for m in measures])


def counts_of(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def rate_by_hour(df: DataFrame, time: str, label: str = "Rain") -> DataFrame:
    """Percent of rainy rows for each of the 24 hours, 0 where an hour has none."""
    rates = df.groupBy(F.hour(time).alias("hour")).agg(percent(F.avg(label)).alias("rain_percent"))
    return densify(rates, "hour", 0, 23, {"rain_percent": F.lit(0.0)})


def forecast_rollup(df: DataFrame, time: str) -> DataFrame:
    """Per forecast hour: mean, sum and count of the predicted class (or of Rain without one)."""
    label = "predicted_rain" if "predicted_rain" in df.columns else "Rain"
    rate = F.avg(label)
    return df.groupBy(floor_hour(time).alias("hour")).agg(
        rate.alias("rain_rate"),
        F.sum(label).alias("rainy_points"),
        F.count(label).alias("total_points"),
        percent(rate).alias("rain_percent"),
    )


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature: mean, sample deviation, min, median, max, to two places, and unit."""
    moments = _moments(df, features, {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    medians = selection.quantiles(df, features, {"median": 0.5}).drop("n")
    both = moments.join(F.broadcast(medians), "feature", "left")  # one row per feature
    return both.select(
        "feature",
        unit_of("feature").alias("unit"),
        *[F.bround(c, 2).alias(c) for c in ("mean", "std", "min", "median", "max")],
    )


def _moments(df: DataFrame, features: Sequence[str], functions: dict) -> DataFrame:
    """All functions of all features in one pass, then one row per feature."""
    wide = df.agg(
        *[fn(F.col(f).cast("double")).alias(f"{f}__{name}") for f in features for name, fn in functions.items()]
    )
    return wide_to_rows(wide, {name: [f"{f}__{name}" for f in features] for name in functions}, features)


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Every pair (a, b) with its Pearson coefficient over rows where both are present."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    wide = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs]
    )

    def entry(a: str, b: str) -> Column:
        name = f"{a}__{b}" if f"{a}__{b}" in wide.columns else f"{b}__{a}"
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(name).alias("r"))

    return wide.select(F.inline(F.array(*[entry(a, b) for a in features for b in features])))


# ---- exploration -----------------------------------------------------------
def rate_by(df: DataFrame, key: str, label: str = "Rain") -> DataFrame:
    return df.groupBy(key).agg((F.avg(label) * 100).alias("rain_percent"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide_to_rows(wide, {"nulls": columns}, columns)


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows repeat an earlier row in all the columns."""
    groups = df.groupBy(*columns).agg(F.count("*").alias("c"))
    return groups.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicates"))


def describe_numbers(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per feature, and distinct values, top and its count.

    The smallest of equally frequent values is the top.
    """
    values = value_counts(df, features)
    moments = _moments(df, features, {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    order = quantiles(values, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    shape = values.groupBy("feature").agg(
        F.count("*").alias("distinct"),
        F.max(F.struct("c", (-F.col("x")).alias("neg"))).alias("top"),
    )
    return (
        moments.join(F.broadcast(order), "feature", "left")  # one row per feature on both sides
        .join(F.broadcast(shape), "feature", "left")
        .select(
            "feature",
            F.coalesce("n", F.lit(0)).alias("count"),
            F.coalesce("distinct", F.lit(0)).alias("unique"),
            (-F.col("top.neg")).alias("top"),
            F.col("top.c").alias("freq"),
            "mean",
            "std",
            "min",
            "q25",
            "q50",
            "q75",
            "max",
        )
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct, most frequent value (first by name among equals) and its count."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in columns]
    )
    values = (
        df.select(F.inline(pairs)).where(F.col("v").isNotNull()).groupBy("feature", "v").count()
    )
    most = values.groupBy("feature").agg(
        F.sum("count").alias("count"), F.count("*").alias("unique"), F.max("count").alias("freq")
    )
    named = values.groupBy("feature", "count").agg(F.min("v").alias("top"))
    named = named.groupBy("feature").agg(F.max(F.struct("count", "top")).alias("best"))
    return most.join(F.broadcast(named), "feature").select(
        "feature", "count", "unique", F.col("best.top").alias("top"), "freq"
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], many: int = 20) -> DataFrame:
    """Distinct values per column, and whether there are more than ``many``."""
    # As text, every value of every type stays apart; large integers would meet as doubles.
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("s")) for c in columns]
    every = df.select(F.inline(F.array(*pairs))).where(F.col("s").isNotNull()).distinct()
    values = every.groupBy("feature").agg(F.count("*").alias("distinct"))
    return values.withColumn("plot", F.when(F.col("distinct") > many, "box").otherwise("violin"))


def histogram(df: DataFrame, features: Sequence[str], bins: int = 20) -> DataFrame:
    """Equal-width bins from min to max, the last one closed, empty ones included."""
    wide = df.agg(
        *[F.min(F.col(f).cast("double")).alias(f"{f}__lo") for f in features],
        *[F.max(F.col(f).cast("double")).alias(f"{f}__hi") for f in features],
    )
    spans = wide_to_rows(
        wide, {"lo": [f"{f}__lo" for f in features], "hi": [f"{f}__hi" for f in features]}, features
    )
    spans = spans.withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    at = F.when(
        F.col("width") > 0,
        F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.lit(bins - 1)),
    ).otherwise(F.lit(0))
    rows = unpivot(df, features).where(F.col("x").isNotNull())
    counted = (
        rows.join(F.broadcast(spans), "feature")  # one row per feature
        .groupBy("feature", at.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    every = spans.select("feature", "lo", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counted, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


#: Bins per bandwidth, powers kept per bin, and the bandwidths beyond which a kernel is left out.
DENSITY_BINS, DENSITY_POWERS, DENSITY_REACH = 8, 6, 8.5


def density(df: DataFrame, features: Sequence[str], by: Sequence[str] = (), points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid from min to max, Scott's bandwidth.

    Values are summed up in bins of an eighth of the bandwidth: their number and the powers 1 to 5 of
    their distances t from the middle, in bandwidths. A kernel at distance u - t is the one at u times
    the sum of He_k(u) t^k / k!, so a bin's kernels follow from its sums. What is shuffled is a row per
    bin and task, and grid points meet bins, not values.

    Error: t is at most 1/16, and |He_k(u)| exp(-u * u / 2) at most 15 for k = 6, so the powers left out
    give 1.3e-9 of a kernel's height per value at most (15 / 6! / 16 ** 6, and little more for k > 6);
    beyond 8.4 bandwidths a kernel is below 4e-16 of it. So densities are off by less than
    1.3e-9 / (bandwidth * sqrt(2 pi)).

    Null and NaN are left out, and groups of one value or without spread. ``by`` is a class column.
    """
    keys = [*by, "feature"]
    long = unpivot(df, features, by).where(F.col("x").isNotNull() & ~F.isnan("x"))
    about = long.groupBy(*keys).agg(F.count("*").alias("n"), F.stddev_samp("x").alias("std"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    about = about.where((F.col("n") > 1) & (F.col("std") > 0)).select(
        *[F.col(k).alias(f"g_{k}") for k in keys],
        F.col("n").alias("g_n"),
        F.col("lo").alias("g_lo"),
        ((F.col("hi") - F.col("lo")) / F.lit(float(points - 1))).alias("g_step"),
        (F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("g_h"),
    )
    params = [*keys, "lo", "step", "h"]
    mine = [F.col(f"g_{k}").eqNullSafe(F.col(k)) for k in keys]
    # One row per feature and class, few and known while planning.
    held = long.join(F.broadcast(about), reduce(and_, mine)).select(*[F.col(f"g_{p}").alias(p) for p in params], "x")
    place = (F.col("x") - F.col("lo")) / F.col("h") * DENSITY_BINS
    held = held.withColumn("bin", F.floor(place)).withColumn("t", (place - F.col("bin") - 0.5) / DENSITY_BINS)
    power, powers = F.lit(1.0), []
    for k in range(DENSITY_POWERS):
        powers.append(F.sum(power).alias(f"m{k}"))
        power = power * F.col("t")
    bins = held.groupBy(*params, "bin").agg(*powers)
    middle = (F.col("bin") + 0.5) / DENSITY_BINS  # in bandwidths from the lowest value
    first = F.ceil(F.greatest((middle - DENSITY_REACH) * F.col("h") / F.col("step"), F.lit(0.0)))
    last = F.floor(F.least((middle + DENSITY_REACH) * F.col("h") / F.col("step"), F.lit(float(points - 1))))
    near = bins.where(first <= last).select("*", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("i"))
    u = F.col("i") * F.col("step") / F.col("h") - middle
    lower, hermite, kernels, scale = F.lit(0.0), F.lit(1.0), F.lit(0.0), 1.0
    for k in range(DENSITY_POWERS):
        kernels = kernels + hermite * F.col(f"m{k}") / scale
        lower, hermite, scale = hermite, u * hermite - k * lower, scale * (k + 1)
    grid = near.groupBy(*params, "i").agg(F.sum(F.exp(-u * u / 2) * kernels).alias("k"))
    # Places far from all values have no kernel in reach.
    every = about.withColumn("g_i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    meets = reduce(and_, mine) & (F.col("g_i") == F.col("i"))
    return every.join(grid, meets, "left").select(
        *[F.col(f"g_{k}").alias(k) for k in keys],
        F.col("g_i").alias("i"),
        (F.col("g_lo") + F.col("g_i") * F.col("g_step")).alias("at"),
        (F.coalesce("k", F.lit(0.0)) / (F.col("g_n") * F.col("g_h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
    )


def box_stats(df: DataFrame, features: Sequence[str], label: str = "Rain") -> DataFrame:
    """Per class and feature: quartiles, whiskers (extremes inside 1.5 IQR), values outside.

    ``label`` is a 0/1 class.
    """
    known = df.where(F.col(label).isin(0, 1))
    found = selection.quantile_values(known, features, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [label])
    spark, kind = df.sparkSession, df.schema[label].dataType.simpleString()
    if not found:
        return spark.createDataFrame([], f"`{label}` {kind}, feature string, n long, q1 double, median double, q3 double, whisker_low double, whisker_high double, outside long")
    parts = []
    for (y, f), q in found.items():
        x, reach = F.col(f).cast("double"), 1.5 * (q["q3"] - q["q1"])
        mine = (F.col(label) == y) & x.isNotNull()
        kept = mine & x.between(q["q1"] - reach, q["q3"] + reach)
        parts.append([F.min(F.when(kept, x)), F.max(F.when(kept, x)), F.count_if(mine & ~kept)])
    # One pass for all classes and features.
    wide = known.agg(*[e.alias(f"c{i}_{j}") for i, es in enumerate(parts) for j, e in enumerate(es)])
    rows = [
        F.struct(
            F.lit(y).cast(kind).alias(label), F.lit(f).alias("feature"), F.lit(q["n"]).cast("long").alias("n"),
            *[F.lit(float(q[c])).alias(c) for c in ("q1", "median", "q3")],
            F.col(f"c{i}_0").alias("whisker_low"), F.col(f"c{i}_1").alias("whisker_high"), F.col(f"c{i}_2").alias("outside"),
        )
        for i, ((y, f), q) in enumerate(found.items())
    ]
    return wide.select(F.inline(F.array(*rows)))


def outliers(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows strictly outside 1.5 IQR per feature, as count and percent of all rows.

    A column without values has no outliers.
    """
    found = selection.quantile_values(df, features, {"q1": 0.25, "q3": 0.75})

    def outside(f: str) -> Column:
        if (f,) not in found:
            return F.lit(0).cast("long")
        q1, q3 = found[f,]["q1"], found[f,]["q3"]
        reach, x = 1.5 * (q3 - q1), F.col(f).cast("double")
        return F.count_if((x < q1 - reach) | (x > q3 + reach))

    # One pass for all features.
    wide = df.agg(F.count("*").alias("rows"), *[outside(f).alias(f"c{i}") for i, f in enumerate(features)])
    share = [F.coalesce(F.col(f"c{i}") / F.nullif(F.col("rows"), F.lit(0)) * 100, F.lit(0.0)) for i in range(len(features))]
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f"c{i}").alias("count"), share[i].alias("percentage")) for i, f in enumerate(features)]
    return wide.select(F.inline(F.array(*rows)))


def _skew(c: Column) -> Column:
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def _kurt(c: Column) -> Column:
    n = F.count(c).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def shape_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Bias-adjusted skewness and excess kurtosis per feature."""
    return _moments(df, features, {"skewness": _skew, "kurtosis": _kurt})


def transform_check(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return _moments(
        df,
        features,
        {"mean": F.avg, "std": F.stddev_samp, "skewness": _skew, "min": F.min, "max": F.max},
    )


# ---- mean with a bootstrap band --------------------------------------------
def rate_with_band(
    df: DataFrame, key: Column, name: str, label: str = "Rain", draws: int = 1000, seed: int = 42
) -> DataFrame:
    """Mean of a 0/1 label per key with the middle 95 % of bootstrap means.

    Resampling n rows of which k are 1 gives Binomial(n, k/n) ones, so the resampling needs the two
    counts of each key only, however many rows there are.
    """
    counts = df.groupBy(key.alias(name)).agg(
        F.sum(label).cast("bigint").alias("k"), F.count(label).alias("n")
    )
    counts = counts.where(F.col("n") > 0)

    def resample(batches):
        for pdf in batches:
            low, high = [], []
            for at, k, n in zip(pdf[name], pdf["k"], pdf["n"]):
                rng = np.random.default_rng([seed, int(at)])
                means = rng.binomial(int(n), k / n, draws) / n
                a, b = np.percentile(means, [2.5, 97.5])
                low.append(a)
                high.append(b)
            yield pd.DataFrame(
                {name: pdf[name], "mean": pdf["k"] / pdf["n"], "low": low, "high": high}
            )

    return counts.mapInPandas(resample, f"{name} int, mean double, low double, high double")
