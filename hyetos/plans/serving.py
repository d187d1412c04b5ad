"""Tables a client shows, computed for all locations at once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyetos.functions.conditions import (
    GLYPHS,
    OTHER,
    condition_text,
    with_condition_class,
)
from hyetos.functions.numbers import fixed_text
from hyetos.functions.timestamps import wall_clock
from hyetos.operators.alerts import first_alert
from hyetos.operators.cities import hourly_slice, latest_per_city
from hyetos.operators.trends import trend, with_window_bounds
from hyetos.params import SliceParams, TrendParams


def city_card(trends: DataFrame, alerts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Header row per location: latest reading, condition class and first alert, if any."""
    latest = latest_per_city(trends, as_of)
    has_condition = {"common_condition", "last_condition"} & set(trends.columns)
    if has_condition:
        text = latest.withColumn("condition_text", condition_text(latest))
        shown = with_condition_class(text, "condition_text")
    else:
        shown = latest.withColumn("condition_class", F.lit(OTHER)).withColumn(
            "condition_glyph", F.lit(GLYPHS[OTHER])
        )
    cards = shown.select(
        "name",
        "window_start",
        "avg_temp",
        "avg_humidity",
        F.concat(fixed_text(F.col("avg_temp"), 1), F.lit("°C")).alias("temperature_text"),
        F.concat(fixed_text(F.col("avg_humidity"), 0), F.lit("%")).alias("humidity_text"),
        "condition_class",
        "condition_glyph",
    )
    alert = first_alert(alerts).withColumn(
        "alert_text", F.concat(fixed_text(F.col("alert_value"), 1), F.col("alert_unit"))
    )
    return cards.join(alert, "name", "left")


def slice_from_forecast(
    forecast: DataFrame, params: SliceParams, trend_params: TrendParams = TrendParams()
) -> DataFrame:
    """:func:`hourly_slice` of the trend, reading only forecast hours that can reach it.

    A window starting in the slice holds hours from its start to just before its end.
    """
    beyond = wall_clock(params.end) + F.expr(f"INTERVAL {trend_params.window}")
    near = forecast.filter(
        (F.col("forecast_time") >= wall_clock(params.start)) & (F.col("forecast_time") < beyond)
    )
    return hourly_slice(with_window_bounds(trend(near, trend_params)), params)
