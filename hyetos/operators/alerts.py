"""Threshold alerts and their summary per location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hyetos.operators.revisions import latest_revision
from hyetos.params import Thresholds

# Alert types in order of priority.
HIGH_TEMPERATURE = "HIGH TEMPERATURE"
LOW_TEMPERATURE = "LOW TEMPERATURE"
HIGH_WIND = "HIGH WIND"
PRIORITY = (HIGH_TEMPERATURE, LOW_TEMPERATURE, HIGH_WIND)


def is_extreme(thresholds: Thresholds = Thresholds()) -> Column:
    """Whether a forecast hour is beyond a threshold; NULL if that is not known."""
    return (
        (F.col("temp") > thresholds.high_temp)
        | (F.col("temp") < thresholds.low_temp)
        | (F.col("wind_speed") > thresholds.high_wind)
    )


def alert_type(thresholds: Thresholds = Thresholds()) -> Column:
    """The first alert type that applies to a forecast hour, or NULL."""
    return (
        F.when(F.col("temp") > thresholds.high_temp, HIGH_TEMPERATURE)
        .when(F.col("temp") < thresholds.low_temp, LOW_TEMPERATURE)
        .when(F.col("wind_speed") > thresholds.high_wind, HIGH_WIND)
    )


def extreme(
    forecast: DataFrame, thresholds: Thresholds = Thresholds(), keep: Sequence[str] = ()
) -> DataFrame:
    """Forecast hours beyond a threshold, each with the first alert type that applies.

    A NULL reading neither raises nor hides an alert of the other reading. ``keep``
    names further columns to carry along.
    """
    return forecast.filter(is_extreme(thresholds)).select(
        "name",
        F.col("forecast_time").alias("timestamp"),
        F.col("temp").alias("temperature"),
        "wind_speed",
        alert_type(thresholds).alias("alert_type"),
        *keep,
    )


def extreme_latest(
    forecast: DataFrame,
    thresholds: Thresholds = Thresholds(),
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Alerts of the latest revision only, so an hour alerts at most once.

    Only the columns that alerts use are shuffled. Revisions that neither fetch time nor
    ``tiebreak`` order are ordered by their readings.
    """
    used = ["name", "forecast_time", "fetch_time", "temp", "wind_speed"]
    used += [c for c in tiebreak if c not in used]
    return extreme(latest_revision(forecast.select(*used), tiebreak), thresholds)


def alert_value() -> Column:
    """The reading an alert is about."""
    return F.when(F.col("alert_type") == HIGH_WIND, F.col("wind_speed")).otherwise(
        F.col("temperature")
    )


def alert_unit() -> Column:
    return F.when(F.col("alert_type") == HIGH_WIND, F.lit("Km/h")).when(
        F.col("alert_type").isNotNull(), F.lit("°C")
    )


def first_alert(alerts: DataFrame) -> DataFrame:
    """One alert per name: earliest hour, then type priority, then lowest value.

    Alerts without a time come last. Rows are first reduced per hour and type, which
    hashes on numbers, before the minimum over structs.
    """
    return _first(alerts)


def _first(alerts: DataFrame) -> DataFrame:
    """The first alert of every name; rows whose type is NULL only make their name appear."""
    per_hour = alerts.groupBy("name", "timestamp", "alert_type").agg(
        F.min(alert_value()).alias("alert_value")
    )
    rank = F.lit(len(PRIORITY))
    for position, alert_type in reversed(list(enumerate(PRIORITY))):
        rank = F.when(F.col("alert_type") == alert_type, position).otherwise(rank)
    order = F.struct(
        F.col("timestamp").isNull().alias("no_time"),
        F.col("timestamp"),
        rank.alias("rank"),
        F.col("alert_value"),
        F.col("alert_type"),
    )
    return (
        per_hour.groupBy("name")
        .agg(F.min(F.when(F.col("alert_type").isNotNull(), order)).alias("first"))
        .select(
            "name",
            F.col("first.timestamp").alias("alert_time"),
            F.col("first.alert_type").alias("alert_type"),
            F.col("first.alert_value").alias("alert_value"),
        )
        .withColumn("alert_unit", alert_unit())
    )


def forecast_alerts(forecast: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """:func:`alert_summary` of every name in ``forecast``, which is read once.

    Hours without an alert fall together in one row per name before the shuffle.
    """
    found = alert_type(thresholds)
    typed = forecast.select(
        "name",
        F.when(found.isNotNull(), F.col("forecast_time")).alias("timestamp"),
        F.col("temp").alias("temperature"),
        "wind_speed",
        found.alias("alert_type"),
    )
    return _first(typed)


def alert_summary(alerts: DataFrame, cities: DataFrame) -> DataFrame:
    """One row per name in ``cities``; the alert columns are NULL where there is none."""
    return cities.select("name").join(first_alert(alerts), "name", "left")


def alert_sessions(alerts: DataFrame, gap: str = "90 minutes", combine: bool = True) -> DataFrame:
    """Runs of extreme hours per name, which end where no alert follows within ``gap``.

    Columns: name, session_start, last_alert, n_alerts, peak_temperature, peak_wind_speed. Alerts
    are first added up per name and time, so that what is sorted for a location is its
    different hours and not its alerts; a stream keeps merged sessions in its state instead
    (``combine=False``). Alerts without a time belong to no session.
    """
    peaks = [F.max("temperature").alias("temperature"), F.max("wind_speed").alias("wind_speed")]
    timed = alerts.withColumn("n", F.lit(1).cast("long"))
    if combine:
        timed = timed.groupBy("name", "timestamp").agg(F.count("*").alias("n"), *peaks)
    sessions = timed.groupBy("name", F.session_window("timestamp", gap).alias("session")).agg(
        F.max("timestamp").alias("last_alert"),
        F.sum("n").alias("n_alerts"),
        F.max("temperature").alias("peak_temperature"),
        F.max("wind_speed").alias("peak_wind_speed"),
    )
    return sessions.select(
        "name", F.col("session.start").alias("session_start"), "last_alert", "n_alerts",
        "peak_temperature", "peak_wind_speed",
    )
