import random
from bisect import bisect_left, bisect_right

from helpers import at, forecast_frame

from hyetos.operators import sketches
from hyetos.sources import snapshots

RANKS = {"low": 0.05, "median": 0.5, "high": 0.95}


def frame(spark, n, seed=1):
    source = random.Random(seed)
    rows = []
    for i in range(n):
        temp = source.choice([None, source.gauss(10, 8), float(round(source.gauss(20, 2)))])
        rows.append((f"C{source.randrange(3000)}", at(24 * source.randrange(3)), temp, 5, 1.0, "x"))
    return forecast_frame(spark, rows, real="double")


def check(forecast, found):
    days = {}
    for r in forecast.collect():
        days.setdefault(r.forecast_date, []).append(r)
    assert {r.forecast_date for r in found} == set(days)
    for r in found:
        own = days[r.forecast_date]
        temps = sorted(x.temp for x in own if x.temp is not None)
        names = len({x.name for x in own})
        assert r.n_rows == len(own) and abs(r.n_locations - names) <= 0.06 * names + 0.5
        for name, rank in RANKS.items():
            below, up_to = bisect_left(temps, r[name]) / len(temps), bisect_right(temps, r[name]) / len(temps)
            assert below - sketches.RANK_ERROR <= rank <= up_to + sketches.RANK_ERROR


def test_within_the_bound_on_one_and_many_partitions_and_batches(spark, tmp_path):
    forecast = frame(spark, 12_000).cache()
    for n in (1, 40):
        once = sketches.daily_sketches(forecast.repartition(n))
        check(forecast, sketches.read_sketches(once, RANKS).collect())
    for n, part in enumerate(forecast.randomSplit([1.0] * 6, 3)):
        snapshots.write_snapshot(sketches.daily_sketches(part), n, str(tmp_path), "k")
    merged = sketches.merged_sketches(snapshots.read_history(spark, str(tmp_path), "k"))
    check(forecast, sketches.read_sketches(merged, RANKS).collect())
    assert merged.selectExpr("max(length(temps) + length(names)) as n").first().n < 20_000


def test_days_without_readings_and_no_days(spark):
    forecast = forecast_frame(spark, [("A", at(0), None, 5, 1.0, "x"), (None, at(0), None, 5, 1.0, "x")])
    found = sketches.read_sketches(sketches.merged_sketches(sketches.daily_sketches(forecast)), RANKS).collect()
    assert [tuple(r) for r in found] == [("2024-06-01", 2, 1, None, None, None)]
    assert sketches.read_sketches(sketches.merged_sketches(sketches.daily_sketches(forecast.limit(0))), RANKS).collect() == []
