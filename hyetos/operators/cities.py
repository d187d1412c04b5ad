"""Selections and per-location rows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyetos.functions.numbers import half_even
from hyetos.functions.timestamps import wall_clock, with_calendar_parts
from hyetos.params import MONITORED_CITIES, SliceParams


def monitored(df: DataFrame, cities: Iterable[str] | DataFrame = MONITORED_CITIES) -> DataFrame:
    """Rows of the monitored locations, given as names or as a table with ``name``."""
    if isinstance(cities, DataFrame):
        return df.join(cities.select("name"), "name", "left_semi")
    return df.filter(F.col("name").isin(list(cities)))


def for_city(df: DataFrame, city: str) -> DataFrame:
    return df.filter(F.col("name") == city)


def distinct_cities(df: DataFrame) -> DataFrame:
    return df.select("name").distinct().orderBy("name")


def city_timeline(trends: DataFrame) -> DataFrame:
    """Trend rows with calendar columns, ordered by name and window start."""
    return with_calendar_parts(trends, "window_start").orderBy("name", "window_start")


def latest_per_city(trends: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The row with the greatest window start per name, optionally none after ``as_of``.

    Forecasts lie ahead, so without ``as_of`` this is the furthest forecast window.
    """
    if as_of is not None:
        trends = trends.filter(F.col("window_start") <= wall_clock(as_of))
    rest = [c for c in trends.columns if c not in ("name", "window_start")]
    last = trends.groupBy("name").agg(F.max(F.struct("window_start", *rest)).alias("last"))
    return last.select(
        *[F.col(c) if c == "name" else F.col(f"last.{c}") for c in trends.columns]
    )


def hourly_slice(trends: DataFrame, params: SliceParams) -> DataFrame:
    """Temperature series of the windows that start within the slice, both ends included."""
    return trends.filter(
        F.col("window_start").between(wall_clock(params.start), wall_clock(params.end))
    ).select(
        "name",
        "window_start",
        F.date_format("window_start", "MM-dd HH:mm").alias("display_time"),
        half_even(F.col("avg_temp"), 2).alias("temperature_c"),
    )
