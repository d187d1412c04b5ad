import random
from collections import Counter
from datetime import datetime
from statistics import fmean

import pytest
from helpers import at, rows

from hyetos.operators.daily import (
    daily_condition,
    daily_forecast,
    daily_last_condition,
    daily_rollup,
    display_days,
    join_condition,
    rollup_with_condition,
)

DDL = """window_start timestamp, name string, max_temp double, min_temp double,
    avg_wind_speed double, avg_humidity double, common_condition string"""


@pytest.fixture(scope="module")
def windows():
    rng = random.Random(2)
    return [
        (
            at(h),
            name,
            rng.randint(0, 400) / 8,
            rng.randint(-400, 0) / 8,
            rng.choice([None, rng.randint(0, 400) / 8]),
            rng.randint(0, 800) / 8,
            None if name == "C" else rng.choice([None, "x", "y", "z"]),
        )
        for name in "ABC"
        for h in range(100)
        if rng.random() < 0.8
    ]


@pytest.fixture(scope="module")
def trend(spark, windows):
    return spark.createDataFrame(windows, DDL)


def by_hand(windows):
    """Measures and modal condition of each name and day, from the rule itself."""
    days = {}
    for time, name, high, low, wind, humidity, condition in windows:
        days.setdefault((name, time.strftime("%Y-%m-%d")), []).append((high, low, wind, humidity, condition))
    expected = []
    for (name, day), held in sorted(days.items()):
        highs, lows, winds, humidities, conditions = zip(*held)
        winds = [w for w in winds if w is not None]
        counts = Counter(c for c in conditions if c is not None)
        mode = min(counts, key=lambda c: (-counts[c], c), default=None)
        means = (fmean(winds) if winds else None, fmean(humidities))
        expected.append((name, day, max(highs), min(lows), *means, datetime.fromisoformat(day).date(), mode))
    return expected


def test_like_counting_by_hand(trend, windows):
    expected = by_hand(windows)
    columns = ("name", "date_str", "max_temp", "min_temp", "avg_wind_speed", "avg_humidity", "date")
    for found in (daily_rollup(trend), rollup_with_condition(trend)):
        for ours, theirs in zip(rows(found, *columns), expected, strict=True):
            assert ours[:4] + ours[6:] == theirs[:4] + theirs[6:7]
            assert list(ours[4:6]) == [None if v is None else pytest.approx(v) for v in theirs[4:6]]
    assert rows(daily_condition(trend)) == sorted([(e[0], e[1], e[7]) for e in expected], key=repr)


def test_one_pass_equals_the_join(trend):
    joined = join_condition(daily_rollup(trend), daily_condition(trend))
    one = rollup_with_condition(trend)
    key = ("name", "date_str", "max_temp", "min_temp", "common_condition")
    assert rows(one, *key) == rows(joined, *key)
    assert one.columns == joined.columns


def test_join_keeps_days_without_a_condition(spark, trend):
    none = spark.createDataFrame([], "name string, date_str string, common_condition string")
    joined = join_condition(daily_rollup(trend), none)
    assert joined.count() == daily_rollup(trend).count()


def test_last_condition_skips_nulls(spark):
    data = [(at(0), "A", "x"), (at(1), "A", "y"), (at(2), "A", None), (at(24), "A", None)]
    frame = spark.createDataFrame(data, "window_start timestamp, name string, last_condition string")
    assert rows(daily_last_condition(frame)) == [("A", "2024-06-01", "y"), ("A", "2024-06-02", None)]


def test_forecast_with_each_kind_of_condition(trend):
    columns = ("date_str", "day_label", "condition_text", "condition_class", "condition_glyph")
    only_c = trend.filter("name = 'C'")
    assert rows(daily_forecast(only_c), *columns)[0] == ("2024-06-01", "Sat 01", "Unknown", "unknown", "❓")
    last = trend.filter("name = 'A'").withColumnRenamed("common_condition", "last_condition")
    labelled = daily_forecast(last)
    assert "last_condition" in labelled.columns
    assert labelled.filter("condition_text != coalesce(last_condition, 'Unknown')").count() == 0
    bare = daily_forecast(trend.drop("common_condition"))
    assert {r.condition_text for r in bare.collect()} == {"Unknown"}


def test_display(spark):
    data = [(at(0), "A", 21.25, -3.75, 10.35, 60.0, "Fog")]
    shown = display_days(daily_forecast(spark.createDataFrame(data, DDL))).first()
    assert tuple(shown) == ("A", "2024-06-01", "Sat 01", "Fog", "🌫️", "21.2°C", "-3.8°C", "10.3Km/h", "60.0%")
