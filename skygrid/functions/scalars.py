"""Column expressions: every one stays inside generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.constants import (
    POSSIBLE_RAIN_CLOUD,
    SERVING_THRESHOLD,
    TIME_CANDIDATES,
    UNITS,
    UTC_OFFSET_HOURS,
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- time ------------------------------------------------------------------
def time_column(df: DataFrame, candidates: Sequence[str] = TIME_CANDIDATES) -> str | None:
    """Name of the table's time column, chosen while planning."""
    return next((name for name in candidates if name in df.columns), None)


def parse_time(c: Column | str) -> Column:
    """Text such as 2026-05-28T07:00 or 2026-05-28 07:00:00; null when unreadable."""
    return col(c).try_cast("timestamp")


def to_utc(c: Column | str, offset_hours: int = UTC_OFFSET_HOURS) -> Column:
    return col(c) - F.make_dt_interval(F.lit(0), F.lit(offset_hours)) if offset_hours else col(c)


def floor_hour(c: Column | str) -> Column:
    return F.date_trunc("hour", col(c))


def cyclic(hour: Column | str, month: Column | str) -> dict[str, Column]:
    """Sine and cosine of the hour of day and of the month (January at angle zero)."""
    day_turn = col(hour) * F.lit(2.0) * F.pi() / F.lit(24.0)
    year_turn = (col(month) - 1) * F.lit(2.0) * F.pi() / F.lit(12.0)
    return {
        "hour_sin": F.sin(day_turn),
        "hour_cos": F.cos(day_turn),
        "month_sin": F.sin(year_turn),
        "month_cos": F.cos(year_turn),
    }


def stamp(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")


def axis_label(c: Column | str) -> Column:
    return F.date_format(col(c), "MMM dd HH:mm")


def snapshot_id(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyyMMdd_HHmm")


# ---- numbers ---------------------------------------------------------------
def rain_flag(c: Column | str) -> Column:
    """1 when it rained; a missing amount counts as dry."""
    return F.when(F.coalesce(col(c) > 0, F.lit(False)), 1).otherwise(0)


def half_even(c: Column | str, places: int) -> Column:
    return F.bround(col(c), places)


def percent(c: Column | str, places: int = 1) -> Column:
    return F.bround(col(c) * 100, places)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def no_nan(c: Column | str) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))


def e5(c: Column | str) -> Column:
    """A coordinate as whole 1e-5 degrees, safe to join on."""
    return F.round(col(c) * 1e5).cast("bigint")


# ---- labels ----------------------------------------------------------------
def to_class(prob: Column | str, threshold: float = SERVING_THRESHOLD) -> Column:
    return (col(prob) >= F.lit(float(threshold))).cast("int")


def rain_text(label: Column | str, cloud: Column | str) -> Column:
    return (
        F.when(col(label) == 1, "Rain")
        .when(col(label) == 0, "Clear")
        .when(col(cloud) > POSSIBLE_RAIN_CLOUD, "Possible rain")
        .otherwise("Clear")
    )


def condition_text(label: Column | str) -> Column:
    return F.when(col(label) == 0, "No Rain").otherwise("Rain")


def unit_of(feature: Column | str) -> Column:
    pairs = [F.lit(part) for item in UNITS.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(feature)), F.lit(""))


# ---- table shape -----------------------------------------------------------
def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Columns in the given order; absent ones are left out."""
    return df.select(*[name for name in order if name in df.columns])


def normalise(df: DataFrame) -> DataFrame:
    """NaN becomes null and zone-less times become timestamps, as everything here expects."""
    changed = {}
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind in ("double", "float"):
            changed[field.name] = F.when(~F.isnan(field.name), F.col(field.name))
        elif kind == "timestamp_ntz":
            changed[field.name] = F.col(field.name).cast("timestamp")
    return df.withColumns(changed) if changed else df


def with_cell_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"lat_e5": e5("Latitude"), "lon_e5": e5("Longitude")})


def unpivot(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by..., feature, x): one generate step, no shuffle."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features]
    )
    return df.select(*by, F.inline(pairs))


def wide_to_rows(df: DataFrame, fields: dict[str, Sequence[str]], labels: Sequence[str]) -> DataFrame:
    """One row of aggregates to one row per label.

    ``fields`` maps an output name to the columns holding it, in the order of ``labels``.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("feature"),
                *[F.col(names[i]).alias(out) for out, names in fields.items()],
            )
            for i, label in enumerate(labels)
        ]
    )
    return df.select(F.inline(rows))
