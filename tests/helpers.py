"""Literal forecast rows and nested documents."""

import json
from datetime import datetime, timedelta

FORECAST_DDL = """name string, fetch_time timestamp, forecast_date string,
    forecast_time timestamp, temp float, humidity int, wind_speed float, condition string"""

BASE = datetime(2024, 6, 1)


def at(hours: float) -> datetime:
    return BASE + timedelta(hours=hours)


def forecast_frame(spark, rows, real="float"):
    """Rows of (name, forecast_time, temp, humidity, wind, condition[, fetch_time])."""
    full = []
    for name, time, temp, humidity, wind, condition, *fetch in rows:
        day = None if time is None else time.strftime("%Y-%m-%d")
        fetched = fetch[0] if fetch else BASE
        full.append((name, fetched, day, time, temp, humidity, wind, condition))
    return spark.createDataFrame(full, FORECAST_DDL.replace("float", real))


def document(name, fetched, hours):
    """A document with (time, temp, humidity, wind, condition) hours, grouped by day."""
    days = {}
    for time, temp, humidity, wind, condition in hours:
        entry = {
            "time": time.strftime("%Y-%m-%d %H:%M"),
            "temp_c": temp,
            "condition": {"text": condition, "icon": "not declared"},
            "wind_kph": wind,
            "humidity": humidity,
        }
        days.setdefault(time.strftime("%Y-%m-%d"), []).append(entry)
    return {
        "location": {"name": name, "country": "not declared"},
        "current": {
            "temp_c": 28.0,
            "condition": {"text": "Sunny"},
            "wind_kph": 5.0,
            "humidity": 50,
        },
        "forecast": {"forecastday": [{"date": d, "hour": h} for d, h in days.items()]},
        "fetch_timestamp": fetched.isoformat(),
    }


def land(folder, name, documents):
    """One fetch cycle: a file with a JSON array of documents."""
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(documents))


def rows(df, *columns):
    """Rows as sorted tuples, NULLs included."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)
