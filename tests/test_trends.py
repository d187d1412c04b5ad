import math
import random
import struct
from collections import Counter, defaultdict
from datetime import timedelta

import pytest
from helpers import at, forecast_frame, rows
from pyspark.sql import functions as F

from hyetos.operators.trends import (
    MEASURES,
    modal_condition,
    order_trend,
    sliding_trend,
    trend,
    trend_cube,
    with_window_bounds,
)
from hyetos.params import TrendParams
from hyetos.schemas import TREND

EXACT = TrendParams(decimals=2)


def test_schema(spark):
    assert trend(forecast_frame(spark, [])).schema.simpleString() == (
        spark.createDataFrame([], TREND).schema.simpleString()
    )


def test_window_edges(spark):
    last = timedelta(minutes=9, seconds=59, microseconds=999999)
    times = [at(0), at(0) + last, at(0) + timedelta(minutes=10), None]
    frame = forecast_frame(spark, [("A", t, 1.0, 1, 1.0, "x") for t in times])
    bounds = rows(with_window_bounds(trend(frame)), "window_start", "window_end")
    ten = timedelta(minutes=10)
    assert bounds == [(at(0), at(0) + ten), (at(0) + ten, at(0) + 2 * ten)]


def test_windows_before_the_epoch(spark):
    frame = forecast_frame(spark, [("A", at(-24 * 365 * 60) + timedelta(minutes=7), 1.0, 1, 1.0, "x")])
    start = with_window_bounds(trend(frame)).first().window_start
    assert start == at(-24 * 365 * 60)


@pytest.mark.parametrize(
    "conditions, expected",
    [
        (["b", "a", "b"], "b"),
        (["b", "a"], "a"),
        ([None, None, "c"], "c"),
        ([None, None], None),
        (["", "z", ""], ""),
    ],
)
def test_modal_condition(spark, conditions, expected):
    frame = forecast_frame(spark, [("A", at(0), 1.0, 1, 1.0, c) for c in conditions])
    assert trend(frame).first().common_condition == expected
    assert modal_condition(frame, "name").first().common_condition == expected


@pytest.mark.parametrize("params", [TrendParams(), EXACT])
def test_nulls_are_skipped(spark, params):
    frame = forecast_frame(
        spark,
        [("A", at(0), None, None, None, "x"), ("A", at(0), 2.0, 5, None, "y"), ("B", at(0), None, None, None, None)],
    )
    found = rows(trend(frame, params), "name", "avg_temp", "max_temp", "min_temp", "avg_humidity", "avg_wind_speed")
    assert found == [("A", 2.0, 2.0, 2.0, 5.0, None), ("B", None, None, None, None, None)]


def test_float_readings_average_as_widened_doubles(spark):
    frame = forecast_frame(spark, [("A", at(0), 30.1, 1, 1.0, "x")])
    widened = struct.unpack("f", struct.pack("f", 30.1))[0]
    assert trend(frame).first().avg_temp == widened
    assert trend(frame, EXACT).first().avg_temp == widened


def test_more_digits_than_the_unit_are_kept(spark):
    frame = forecast_frame(spark, [("A", at(0), 1.004, 1, 1.0, "x")] * 2, real="double")
    assert trend(frame, EXACT).first().avg_temp == 1.004


@pytest.mark.parametrize("odd", [math.nan, math.inf, -math.inf, 1e300])
def test_units_do_not_lose_values_they_cannot_hold(spark, odd):
    frame = forecast_frame(spark, [("A", at(0), odd, 1, 1.0, "x"), ("A", at(0), 1.25, 1, 1.0, "y")], real="double")
    plain, exact = trend(frame).first().avg_temp, trend(frame, EXACT).first().avg_temp
    assert plain == exact or (math.isnan(plain) and math.isnan(exact))


def test_against_brute_force(spark):
    rng = random.Random(11)
    data = [
        (
            rng.choice("ABC"),
            at(0) + timedelta(minutes=rng.randint(0, 300)),
            rng.choice([None, rng.randint(-2000, 4000) / 100]),
            rng.choice([None, rng.randint(0, 99)]),
            rng.randint(0, 200) / 4,
            rng.choice([None, "x", "y", "z"]),
        )
        for _ in range(2000)
    ]
    groups = defaultdict(list)
    for row in data:
        start = row[1] - timedelta(minutes=row[1].minute % 15)
        groups[start, row[0]].append(row)

    def mean(values):
        return sum(values) / len(values) if values else None

    expected = []
    for (start, name), members in groups.items():
        cents = [round(r[2] * 100) for r in members if r[2] is not None]
        counts = Counter(r[5] for r in members if r[5] is not None)
        expected.append(
            (
                start,
                start + timedelta(minutes=15),
                name,
                sum(cents) / 100.0 / len(cents) if cents else None,
                max(cents) / 100 if cents else None,
                min(cents) / 100 if cents else None,
                mean([r[3] for r in members if r[3] is not None]),
                mean([r[4] for r in members]),
                min(counts, key=lambda c: (-counts[c], c)) if counts else None,
            )
        )
    frame = forecast_frame(spark, data, real="double").repartition(5)
    params = TrendParams(window="15 minutes", decimals=2)
    found = with_window_bounds(order_trend(trend(frame, params)))
    assert [tuple(r) for r in found.collect()] == sorted(expected, key=lambda r: (r[0], r[2]))


def test_means_lie_between_the_extremes_and_no_row_is_lost(spark):
    rng = random.Random(5)
    data = [("A", at(rng.randint(0, 50)), rng.uniform(-20, 40), 1, 1.0, "x") for _ in range(500)]
    frame = forecast_frame(spark, data, real="double")
    result = trend(frame)
    slack = 1e-9
    outside = (F.col("avg_temp") > F.col("max_temp") + slack) | (F.col("avg_temp") < F.col("min_temp") - slack)
    assert result.filter(outside).count() == 0
    from hyetos.operators.trends import partial_trend

    assert partial_trend(frame).agg(F.sum("n_rows")).first()[0] == 500


def test_large_values_keep_their_digits(spark):
    for value in (10000000000.004, 10000000000.01, 123456789012.34, 0.1 + 0.2, 25.3 - 10.0, -7e11 - 0.006):
        frame = forecast_frame(spark, [("A", at(0), value, 1, 1.0, "x")], real="double")
        found = trend(frame, EXACT).first().avg_temp
        assert abs(found - value) <= 1e-9


def random_forecast(spark, n=400):
    source = random.Random(n)
    rows_in = []
    for _ in range(n):
        time = at(source.randrange(0, 3000) / 60) if source.random() > 0.03 else None
        reading = source.choice([None, source.randrange(-500, 4500) / 100])
        condition = source.choice(["x", "y", "z", None])
        rows_in.append((source.choice(["A", "A", "B", None]), time, reading, source.choice([None, 5, 9]), 0.25 * source.randrange(99), condition))
    return forecast_frame(spark, rows_in, real="double")


def nearly(df):
    return rows(df.withColumns({c: F.round(c, 9) for c in ("avg_temp", "avg_humidity", "avg_wind_speed")}))


def test_sliding_windows_are_made_of_panes(spark):
    forecast = random_forecast(spark)
    spread = forecast.select("*", F.window("forecast_time", "1 hour", "10 minutes").alias("w"))
    plain = spread.withColumn("forecast_time", F.col("w.start"))
    expected = with_window_bounds(trend(plain, TrendParams(window="10 minutes", decimals=2)))
    expected = expected.withColumn("window_end", F.col("window_start") + F.expr("interval 1 hour"))
    found = with_window_bounds(sliding_trend(forecast, EXACT, panes=6))
    assert nearly(found) == nearly(expected) and found.count() > 300
    single = with_window_bounds(sliding_trend(forecast, EXACT, panes=1))
    assert nearly(single) == nearly(with_window_bounds(trend(forecast, EXACT)))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2  # readings to panes, panes to blocks


def test_cube_is_every_set_by_itself(spark):
    forecast = random_forecast(spark)
    found = trend_cube(forecast, [["name", "forecast_date"], ["name"], ["forecast_date"], []], EXACT)
    expected = []
    for grouping, own in ((0, ["name", "forecast_date"]), (1, ["name"]), (2, ["forecast_date"]), (3, [])):
        single = trend_cube(forecast, [own], EXACT).drop("grouping")
        for c in ("name", "forecast_date"):
            if c not in own:
                single = single.withColumn(c, F.lit(None).cast("string"))
        expected += nearly(single.withColumn("grouping", F.lit(grouping)).select(*found.columns))
    assert nearly(found) == sorted(expected, key=repr)
    days = nearly(found.where("grouping = 2").select("forecast_date", *MEASURES))
    by_hand = forecast.groupBy("forecast_date").agg(F.max("temp").alias("m"), F.avg("wind_speed").alias("w"))
    assert [(r[0], r[2], r[5]) for r in days] == rows(by_hand.withColumn("w", F.round("w", 9)))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan") == 1 and text.count("Expand") == 1
    assert text.index("Expand") < text.index("partial_count(1)")  # the sums are expanded, not the readings
