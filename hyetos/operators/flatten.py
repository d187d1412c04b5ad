"""Nested forecast documents to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hyetos.functions.timestamps import parse_timestamp


def _known(reading: str) -> Column:
    """A reading, NULL where it is NaN."""
    return F.when(~F.isnan(reading), F.col(reading))


def current_conditions(documents: DataFrame) -> DataFrame:
    """The readings at fetch time, one row per document."""
    return documents.select(
        F.col("location.name").alias("name"),
        parse_timestamp(F.col("fetch_timestamp")).alias("fetch_time"),
        _known("current.temp_c").alias("current_temp"),
        F.col("current.humidity").alias("current_humidity"),
        _known("current.wind_kph").alias("current_wind"),
        F.col("current.condition.text").alias("current_condition"),
    )


def explode_days(documents: DataFrame) -> DataFrame:
    """One row per forecast day; documents without days give none."""
    return documents.select(
        F.col("location.name").alias("name"),
        parse_timestamp(F.col("fetch_timestamp")).alias("fetch_time"),
        F.explode("forecast.forecastday").alias("day"),
    )


def explode_hours(days: DataFrame) -> DataFrame:
    """One row per forecast hour; days without hours give none."""
    return days.select(
        "name",
        "fetch_time",
        F.col("day.date").alias("forecast_date"),
        F.explode("day.hour").alias("hour"),
    )


def flatten(
    documents: DataFrame, hour_extra: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """The forecast fact table.

    ``hour_extra`` names further hour fields to keep. ``columns`` limits the usual
    columns, for documents that were read without the fields of the others.
    """
    # The names of the fact columns.
    usual = {
        "name": F.col("name"),
        "fetch_time": F.col("fetch_time"),
        "forecast_date": F.col("forecast_date"),
        "forecast_time": parse_timestamp(F.col("hour.time")),
        "temp": _known("hour.temp_c"),
        "humidity": F.col("hour.humidity"),
        "wind_speed": _known("hour.wind_kph"),
        "condition": F.col("hour.condition.text"),
    }
    return explode_hours(explode_days(documents)).select(
        *[column.alias(c) for c, column in usual.items() if columns is None or c in columns],
        *[F.col(f"hour.{field}").alias(field) for field in hour_extra],
    )


# Columns that alerts are made from.
ALERT_COLUMNS = ("name", "forecast_time", "temp", "wind_speed")
