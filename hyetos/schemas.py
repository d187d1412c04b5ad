"""Declared schemas as DDL text, which readers, ``from_json`` and frames all take.

Every field is nullable; undeclared JSON fields are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence


def document_schema(
    real: str = "float", hour_extra: str = "", only: Sequence[str] | None = None
) -> str:
    """Nested forecast document, one per location and fetch.

    ``real`` is the type of temperatures and wind speeds. ``hour_extra`` is a DDL
    list of further fields to read from each hour, for example ``"uv float"``.
    ``only`` limits the readings of each hour; what is not declared is not parsed.
    """
    readings = {
        "temp_c": real,
        "condition": "struct<text string>",
        "wind_kph": real,
        "humidity": "int",
    }
    wanted = {k: t for k, t in readings.items() if only is None or k in only}
    hour = _fields({"time": "string", **wanted}) + (f", {hour_extra}" if hour_extra else "")
    return f"""location struct<name string>,
        current struct<{_fields(readings)}>,
        forecast struct<forecastday array<struct<date string, hour array<struct<{hour}>>>>>,
        fetch_timestamp string"""


def _fields(types: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in types.items())


DOCUMENT = document_schema()

# What alerts need of a document.
ALERT_DOCUMENT = document_schema(only=("temp_c", "wind_kph"))

FORECAST = """name string, fetch_time timestamp, forecast_date string, forecast_time timestamp,
    temp float, humidity int, wind_speed float, condition string"""

TREND = """window struct<start timestamp, end timestamp>, name string,
    avg_temp double, max_temp float, min_temp float,
    avg_humidity double, avg_wind_speed double, common_condition string"""

ALERT = """name string, timestamp timestamp, temperature float, wind_speed float, alert_type string"""

# One trend record as exported to JSON: the window is the array [start, end].
TREND_RECORD = """window array<string>, name string, avg_temp double, max_temp double, min_temp double,
    avg_humidity double, avg_wind_speed double, common_condition string"""
