import random
from collections import defaultdict
from datetime import timedelta

import pytest
from helpers import at, forecast_frame, rows

from hyetos.operators.alerts import (
    alert_sessions,
    alert_summary,
    extreme,
    extreme_latest,
    first_alert,
    forecast_alerts,
)
from hyetos.params import Thresholds
from hyetos.schemas import ALERT

HOT, COLD, WIND = "HIGH TEMPERATURE", "LOW TEMPERATURE", "HIGH WIND"


@pytest.mark.parametrize(
    "temp, wind, expected",
    [
        (30.0, 25.0, None),
        (0.0, 25.0, None),
        (30.5, 25.0, HOT),
        (-0.5, 25.0, COLD),
        (20.0, 25.5, WIND),
        (31.0, 30.0, HOT),
        (-1.0, 30.0, COLD),
        (None, 26.0, WIND),
        (31.0, None, HOT),
        (None, 20.0, None),
        (None, None, None),
    ],
)
def test_classification(spark, temp, wind, expected):
    found = extreme(forecast_frame(spark, [("A", at(0), temp, 1, wind, "x")])).collect()
    assert [r.alert_type for r in found] == ([] if expected is None else [expected])


def test_schema_and_missing_time(spark):
    found = extreme(forecast_frame(spark, [("A", None, 31.0, 1, 2.0, "x")]))
    assert found.schema.simpleString() == spark.createDataFrame([], ALERT).schema.simpleString()
    assert rows(found) == [("A", None, 31.0, 2.0, HOT)]


def test_float_reading_against_double_limit(spark):
    found = extreme(forecast_frame(spark, [("A", at(0), 30.1, 1, 0.0, "x")]), Thresholds(high_temp=30.1))
    assert found.count() == 1


def alert_frame(spark, data):
    return spark.createDataFrame(data, ALERT)


def test_first_alert_order(spark):
    alerts = alert_frame(
        spark,
        [
            ("A", at(2), 35.0, 1.0, HOT),
            ("A", at(1), 20.0, 40.0, WIND),
            ("A", at(1), -2.0, 40.0, COLD),
            ("A", at(1), -3.0, 40.0, COLD),
            ("A", None, 50.0, 1.0, HOT),
            ("B", at(5), 20.0, 40.0, WIND),
            ("B", at(5), 20.0, 30.0, WIND),
            ("C", None, 31.0, 1.0, HOT),
        ],
    )
    assert rows(first_alert(alerts)) == [
        ("A", at(1), COLD, -3.0, "°C"),
        ("B", at(5), WIND, 30.0, "Km/h"),
        ("C", None, HOT, 31.0, "°C"),
    ]


def test_summary_keeps_places_without_alerts(spark):
    places = spark.createDataFrame([("A",), ("B",)], "name string")
    alerts = alert_frame(spark, [("A", at(0), 35.0, 1.0, HOT), ("Z", at(0), 35.0, 1.0, HOT)])
    assert rows(alert_summary(alerts, places)) == [
        ("A", at(0), HOT, 35.0, "°C"),
        ("B", None, None, None, None),
    ]
    assert rows(alert_summary(alert_frame(spark, []), places), "name", "alert_type") == [("A", None), ("B", None)]


def test_only_the_latest_revision_alerts(spark):
    frame = forecast_frame(
        spark,
        [
            ("A", at(10), 35.0, 1, 1.0, "x", at(0)),
            ("A", at(10), 34.0, 1, 1.0, "x", at(1)),
            ("A", at(11), 35.0, 1, 1.0, "x", at(0)),
            ("A", at(11), 25.0, 1, 1.0, "x", at(1)),
        ],
    )
    assert extreme(frame).count() == 3
    assert rows(extreme_latest(frame), "timestamp", "temperature") == [(at(10), 34.0)]


def test_sessions_are_runs_of_hours(spark):
    source = random.Random(4)
    rows_in = []
    for name in ("A", "A", "A", "B", None):
        for _ in range(60):
            time = at(source.randrange(0, 60)) if source.random() > 0.05 else None
            rows_in.append((name, time, float(source.randrange(20, 40)), 5, float(source.randrange(0, 40)), "x"))
    alerts = extreme(forecast_frame(spark, rows_in))
    expected = []
    by_name = defaultdict(list)
    for r in alerts.where("timestamp is not null").collect():
        by_name[r.name].append(r)
    for name, own in by_name.items():
        runs = []
        for r in sorted(own, key=lambda r: r.timestamp):
            if not runs or r.timestamp - runs[-1][-1].timestamp >= timedelta(minutes=90):
                runs.append([])
            runs[-1].append(r)
        for run in runs:
            peaks = max(r.temperature for r in run), max(r.wind_speed for r in run)
            expected.append((name, run[0].timestamp, run[-1].timestamp, len(run), *peaks))
    assert len(expected) > 3
    for combine in (True, False):
        assert rows(alert_sessions(alerts, combine=combine)) == sorted(expected, key=repr)
    assert alert_sessions(alerts.limit(0)).collect() == []


def test_summary_of_one_read_is_the_joined_one(spark):
    source = random.Random(8)
    rows_in = [
        (
            source.choice(["A", "B", "C", None]), at(source.randrange(9)) if source.random() > 0.1 else None,
            source.choice([None, 10.0, 31.0, -3.0, 40.0]), 5, source.choice([None, 1.0, 30.0]), "x",
        )
        for _ in range(200)
    ] + [("calm", at(0), 10.0, 5, 1.0, "x"), ("unknown", at(0), None, 5, None, "x")]
    forecast = forecast_frame(spark, rows_in)
    found = forecast_alerts(forecast)
    joined = alert_summary(extreme(forecast), forecast.select("name").distinct().where("name is not null"))
    assert rows(found.where("name is not null"), *joined.columns) == rows(joined)
    assert found.where("name is null").count() == 1  # the join has no row for it
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Scan") == 1
