import random

from helpers import at, forecast_frame, rows

from hyetos.operators.revisions import latest_revision


def test_against_brute_force(spark):
    rng = random.Random(3)
    data = [
        (rng.choice("AB"), at(rng.randint(0, 20)), rng.randint(0, 9) / 2, rng.randint(0, 9), 1.0, rng.choice("xy"), at(rng.randint(0, 5)))
        for _ in range(400)
    ]
    best = {}
    for row in data:
        name, time, temp, humidity, wind, condition, fetched = row
        key = (name, time)
        order = (fetched, temp, humidity, wind, condition)
        best[key] = max(best.get(key, order), order)
    expected = [(n, t, o[1], o[2], o[4], o[0]) for (n, t), o in best.items()]
    found = latest_revision(forecast_frame(spark, data, real="double").repartition(4))
    columns = ("name", "forecast_time", "temp", "humidity", "condition", "fetch_time")
    assert rows(found, *columns) == sorted(expected, key=repr)


def test_columns_and_null_fetch_times(spark):
    frame = forecast_frame(spark, [("A", at(0), 1.0, 1, 1.0, "x", None), ("A", at(0), 2.0, 1, 1.0, "x", at(0))])
    found = latest_revision(frame)
    assert found.schema.simpleString() == frame.schema.simpleString()
    assert rows(found, "temp") == [(2.0,)]
