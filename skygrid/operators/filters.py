"""Filters that depend on the table's own newest or oldest time, or on a given moment."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.scalars import col, floor_hour


def _days_hours(days: int, hours: int) -> Column:
    return F.make_dt_interval(F.lit(days), F.lit(hours))


def newest_window(df: DataFrame, time: str, *, days: int = 0, hours: int = 0) -> DataFrame:
    """Rows no older than the newest time minus the window, both ends included.

    The bound is a scalar subquery: one partial aggregate over one column, then a plain filter.
    """
    bound = df.agg((F.max(time) - _days_hours(days, hours)).alias("bound")).scalar()
    return df.where(F.col(time) >= bound)


def drop_oldest(df: DataFrame, time: str, *, days: int = 7) -> DataFrame:
    """Rows at least ``days`` younger than the oldest."""
    bound = df.agg((F.min(time) + _days_hours(days, 0)).alias("bound")).scalar()
    return df.where(F.col(time) >= bound)


def past_hours(df: DataFrame, time: str, as_of: datetime | Column) -> DataFrame:
    """Rows before the hour that contains ``as_of``."""
    return df.where(F.col(time) < floor_hour(_moment(as_of)))


def coming_hours(df: DataFrame, time: str, as_of: datetime | Column) -> DataFrame:
    """Rows from the next full hour on.

    Within minute 0 the moment itself is the bound, seconds and all, so that hour's own time is
    kept only when ``as_of`` falls exactly on it.
    """
    now = _moment(as_of)
    next_hour = floor_hour(now) + F.expr("INTERVAL 1 HOUR")
    return df.where(F.col(time) >= F.when(F.minute(now) > 0, next_hour).otherwise(now))


def _moment(as_of: datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def first_valid(df: DataFrame, value: str, order: str) -> DataFrame:
    """The first non-null value by ``order``, as one row."""
    return df.where(F.col(value).isNotNull()).agg(F.min_by(value, order).alias(value))


def status_of(df: DataFrame, ok: str = "ok", empty: str = "empty") -> DataFrame:
    """One row saying whether the input has rows; reads no further than the first of them."""
    return df.select(F.lit(1).alias("one")).limit(1).agg(
        F.when(F.count("*") > 0, ok).otherwise(empty).alias("status")
    )


def at_least(ids: DataFrame, column: str, least: int) -> Column:
    """Scalar condition: the table names at least ``least`` distinct ids."""
    return ids.select(column).distinct().limit(least).agg(F.count("*").alias("n")).scalar() >= least


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.where(col(c).isNotNull())
    return df
