import random
from datetime import datetime, timedelta

import pytest
from helpers import at
from pyspark.sql import functions as F

from hyetos.operators.asof import asof_join

LEFT = "id long, name string, seen timestamp, valid_value string"
RIGHT = "name string, issued timestamp, rank int, value string"


def expected(left, right):
    """Every left row beside all right rows, the greatest that is not later."""
    found = []
    for number, name, seen, mark in left:
        fits = [
            (issued, rank, value or "")
            for n, issued, rank, value in right
            if name is not None and n == name and seen is not None and issued is not None and issued <= seen
        ]
        best = max(fits, default=None)
        found.append((number, name, seen, mark, *((best[0], best[2] or None) if best else (None, None))))
    return sorted(found, key=repr)


def joined(spark, left, right, **options):
    taken = {"issued": "since", "value": "found"}
    df = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["name"], "seen", "issued",
        taken, tiebreak=["rank"], **options,
    )
    assert df.columns == ["id", "name", "seen", "valid_value", "since", "found"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bucket_seconds", [60, 86_400, 10**9])
def test_like_all_pairs(spark, bucket_seconds):
    source = random.Random(bucket_seconds)

    def moment():
        return at(source.randrange(0, 24 * 60) / 60) if source.random() > 0.05 else None

    def name():  # one location holds most rows
        return source.choice(["hot", "hot", "hot", "a", "b", None])

    left = [(i, name(), moment(), "x") for i in range(300)] + [(1, "hot", at(3), "x")] * 2
    right = [(name(), moment(), source.randrange(3), source.choice("uvw")) for _ in range(200)]
    right = list({r[:3]: r for r in right}.values()) + [("only right", at(1), 0, "u")]
    found = joined(spark, left, right, bucket_seconds=bucket_seconds)
    assert found == expected(left, right)
    assert sum(r[-1] is not None for r in found) > 100


def test_edges(spark):
    early = datetime(1969, 12, 31, 23, 59, 59)
    left = [(1, "a", early, None), (2, "a", at(0), None), (3, "b", at(0), None), (4, "a", at(24 * 400), None)]
    right = [("a", early, 0, "old"), ("a", early, 1, "newer"), ("a", at(0), 0, None), ("b", at(0.001), 0, "late")]
    assert joined(spark, left, right) == expected(left, right)
    assert joined(spark, [], right) == []
    assert joined(spark, left, []) == expected(left, [])
    assert joined(spark, [], []) == []


def test_a_hot_location_is_dealt_by_time(spark):
    rows = spark.range(20_000).select(
        F.lit("hot").alias("name"), (F.lit(at(0)) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("issued"), "id"
    )
    seen = rows.withColumnsRenamed({"issued": "seen", "id": "own"})
    found = asof_join(seen, rows, ["name"], "seen", "issued", {"id": "valid"}, bucket_seconds=3600)
    assert found.where("own = valid").count() == 20_000
    text = found._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("_bucket" in w.split("windowspecdefinition(")[1].split("ASC")[0] for w in windows) == 2


def test_more_keys_and_times_without_zone(spark):
    left = spark.sql("select 1 k, 'a' n, timestamp_ntz'2024-01-02 00:00:00' t union all select 2, 'a', timestamp_ntz'2024-01-02 00:00:00'")
    right = spark.sql("select 1 k, 'a' n, timestamp_ntz'2023-01-02 00:00:00' s, 7 v")
    rows = asof_join(left, right, ["k", "n"], "t", "s", {"v": "v"}).collect()
    assert sorted((r.k, r.v) for r in rows) == [(1, 7), (2, None)]
    assert rows[0].t - datetime(2024, 1, 2) == timedelta(0)
