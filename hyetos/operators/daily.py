"""Daily tables per location, built from trend rows with window bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyetos.functions.conditions import condition_text, with_condition_class
from hyetos.functions.numbers import fixed_text, merged_mean, modal, partial_sum
from hyetos.functions.timestamps import day_label

DAY = ("name", "date_str")


def _with_day(trends: DataFrame) -> DataFrame:
    return trends.withColumn("date_str", F.date_format("window_start", "yyyy-MM-dd"))


def daily_rollup(trends: DataFrame) -> DataFrame:
    """Extremes and unweighted means of the window values per day."""
    return _with_day(trends).groupBy(*DAY).agg(
        F.max("max_temp").alias("max_temp"),
        F.min("min_temp").alias("min_temp"),
        F.avg("avg_wind_speed").alias("avg_wind_speed"),
        F.avg("avg_humidity").alias("avg_humidity"),
    ).withColumn("date", F.to_date("date_str"))


def daily_condition(trends: DataFrame) -> DataFrame:
    """Most frequent window condition per day; ties go to the lowest value."""
    counts = (
        _with_day(trends)
        .groupBy(*DAY, "common_condition")
        .agg(F.count(F.lit(1)).alias("n_windows"))
    )
    return counts.groupBy(*DAY).agg(
        modal("common_condition", "n_windows").alias("common_condition")
    )


def daily_last_condition(trends: DataFrame, column: str = "last_condition") -> DataFrame:
    """Condition of the last window of the day that has one."""
    last = F.max(
        F.when(F.col(column).isNotNull(), F.struct("window_start", column))
    )
    return (
        _with_day(trends)
        .groupBy(*DAY)
        .agg(last.alias("last"))
        .select(*DAY, F.col(f"last.{column}").alias("last_condition"))
    )


def join_condition(rollup: DataFrame, conditions: DataFrame) -> DataFrame:
    """Add a condition column to the rollup; days without one keep their row."""
    return rollup.join(conditions, list(DAY), "left")


def rollup_with_condition(trends: DataFrame) -> DataFrame:
    """Equal to joining :func:`daily_rollup` and :func:`daily_condition`, in one pass.

    ``trends`` is read once and nothing is joined: measures and counts are taken per
    day and condition, then merged per day.
    """
    partial = _with_day(trends).groupBy(*DAY, "common_condition").agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.max("max_temp").alias("max_temp"),
        F.min("min_temp").alias("min_temp"),
        *partial_sum(F.col("avg_wind_speed"), "avg_wind_speed"),
        *partial_sum(F.col("avg_humidity"), "avg_humidity"),
    )
    return partial.groupBy(*DAY).agg(
        F.max("max_temp").alias("max_temp"),
        F.min("min_temp").alias("min_temp"),
        merged_mean("avg_wind_speed").alias("avg_wind_speed"),
        merged_mean("avg_humidity").alias("avg_humidity"),
        F.min(F.to_date("date_str")).alias("date"),
        modal("common_condition", "n_windows").alias("common_condition"),
    )


def label_days(daily: DataFrame) -> DataFrame:
    """Add day label, condition text, class and glyph for display."""
    labelled = daily.withColumn("day_label", day_label(F.to_date("date_str"))).withColumn(
        "condition_text", condition_text(daily)
    )
    return with_condition_class(labelled, "condition_text").withColumn(
        "condition_text", F.coalesce(F.nullif("condition_text", F.lit("")), F.lit("Unknown"))
    )


def daily_forecast(trends: DataFrame) -> DataFrame:
    """The daily table of every location, with whichever condition ``trends`` carries."""
    if "common_condition" in trends.columns:
        daily = rollup_with_condition(trends)
    elif "last_condition" in trends.columns:
        daily = join_condition(daily_rollup(trends), daily_last_condition(trends))
    else:
        daily = daily_rollup(trends)
    return label_days(daily)


# Unit shown after each measure.
UNITS = {"max_temp": "°C", "min_temp": "°C", "avg_wind_speed": "Km/h", "avg_humidity": "%"}


def display_days(daily: DataFrame) -> DataFrame:
    """The daily table as shown: label, condition and each measure as text with its unit."""
    return daily.select(
        *DAY,
        "day_label",
        "condition_text",
        "condition_glyph",
        *[
            F.concat(fixed_text(F.col(measure), 1), F.lit(unit)).alias(f"{measure}_text")
            for measure, unit in UNITS.items()
        ],
    )
