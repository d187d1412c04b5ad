from datetime import datetime

from helpers import at, forecast_frame, rows

from hyetos.operators.alerts import extreme
from hyetos.operators.cities import hourly_slice
from hyetos.operators.trends import trend, with_window_bounds
from hyetos.params import SliceParams, TrendParams
from hyetos.plans.serving import city_card, slice_from_forecast


def test_city_card(spark):
    frame = forecast_frame(
        spark,
        [
            ("A", at(0), 35.25, 50, 5.0, "Sunny"),
            ("A", at(1), 21.25, 61, 5.0, "Fog"),
            ("B", at(1), 10.0, 61, 5.0, None),
            ("C", at(1), 10.0, 61, 30.125, "hail"),
        ],
    )
    bounds = with_window_bounds(trend(frame))
    cards = city_card(bounds, extreme(frame))
    columns = ("name", "temperature_text", "humidity_text", "condition_class", "alert_type", "alert_value", "alert_text")
    assert rows(cards, *columns) == [
        ("A", "21.2°C", "61%", "fog", "HIGH TEMPERATURE", 35.25, "35.2°C"),
        ("B", "10.0°C", "61%", "unknown", None, None, None),
        ("C", "10.0°C", "61%", "other", "HIGH WIND", 30.125, "30.1Km/h"),
    ]
    early = city_card(bounds, extreme(frame), as_of=at(0))
    assert rows(early, "name", "condition_class") == [("A", "clear")]
    bare = city_card(bounds.drop("common_condition"), extreme(frame))
    assert rows(bare, "name", "condition_class", "condition_glyph")[0] == ("A", "other", "🌡️")


def test_prefiltered_slice_equals_the_slice_of_the_whole(spark):
    frame = forecast_frame(spark, [("A", at(h / 4), h / 4, 1, 1.0, "x") for h in range(400)])
    for window in ("10 minutes", "1 hour", "7 hours"):
        params = SliceParams(as_of=datetime(2024, 6, 2, 12, 30))
        whole = hourly_slice(with_window_bounds(trend(frame, TrendParams(window))), params)
        assert whole.count() > 0
        assert rows(slice_from_forecast(frame, params, TrendParams(window))) == rows(whole)
