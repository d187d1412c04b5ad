from datetime import datetime, timedelta

import numpy as np
import pytest
from helpers import at, rows

from hyetos.functions.numbers import fixed_text, half_even
from hyetos.operators.cities import (
    city_timeline,
    distinct_cities,
    for_city,
    hourly_slice,
    latest_per_city,
    monitored,
)
from hyetos.params import MONITORED_CITIES, SliceParams

DDL = "window_start timestamp, name string, avg_temp double, common_condition string"


@pytest.fixture
def trend(spark):
    data = [(at(h), name, h + 0.125, f"c{h}") for name in ("B", "A") for h in range(4)]
    return spark.createDataFrame(data, DDL)


def test_monitored_by_names_and_by_table(spark, trend):
    table = spark.createDataFrame([("A",), ("A",), ("X",)], "name string")
    expected = rows(for_city(trend, "A"))
    assert len(expected) == 4
    assert rows(monitored(trend, ["A", "X"]), *trend.columns) == expected
    assert rows(monitored(trend, table), *trend.columns) == expected
    assert monitored(trend).count() == 0 and len(MONITORED_CITIES) == 7


def test_distinct_cities_are_ordered(trend):
    assert [r.name for r in distinct_cities(trend).collect()] == ["A", "B"]


def test_latest(trend):
    assert rows(latest_per_city(trend), "name", "common_condition") == [("A", "c3"), ("B", "c3")]
    bounded = latest_per_city(trend, as_of=at(1))
    assert rows(bounded, "name", "common_condition") == [("A", "c1"), ("B", "c1")]
    assert bounded.columns == trend.columns


def test_timeline_order_and_parts(trend):
    found = city_timeline(trend).collect()
    assert [(r.name, r.window_start) for r in found] == [(n, at(h)) for n in "AB" for h in range(4)]
    first = found[1].asDict()
    assert first["hour"] == 1 and first["time_str"] == "01:00" and first["date_str"] == "2024-06-01"
    assert first["display_time"] == "06-01 01:00" and str(first["date"]) == "2024-06-01"


def test_slice_includes_both_ends(trend):
    params = SliceParams(as_of=at(2), back=timedelta(hours=1), ahead=timedelta(hours=1))
    found = hourly_slice(for_city(trend, "A"), params)
    assert rows(found, "display_time") == [("06-01 01:00",), ("06-01 02:00",), ("06-01 03:00",)]
    default = SliceParams(as_of=datetime(2024, 1, 15, 12))
    assert (default.start, default.end) == (datetime(2024, 1, 15), datetime(2024, 1, 17))


def test_rounding_is_that_of_numpy(spark):
    values = [0.125, 0.375, 2.675, 1.005, -0.125, 1e10 + 0.005, 0.0] + list(np.linspace(-9, 9, 997))
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = [r[0] for r in frame.select(half_even(frame.v, 2)).collect()]
    assert found == [float(x) for x in np.round(np.array(values), 2)]


def test_fixed_text_is_that_of_python(spark):
    values = [0.05, 0.25, 0.35, -0.25, -0.04, 2.5, 1234.75, 0.0] + [n / 8 for n in range(-300, 300)]
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = frame.select(fixed_text(frame.v, 1), fixed_text(frame.v, 0)).collect()
    assert [tuple(r) for r in found] == [(f"{v:.1f}", f"{v:.0f}") for v in values]
