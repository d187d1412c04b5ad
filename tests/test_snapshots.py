import json
import math
from datetime import timedelta

import pytest
from helpers import at, forecast_frame, rows
from pyspark.sql import functions as F

from hyetos.operators.alerts import extreme
from hyetos.operators.trends import trend, with_window_bounds
from hyetos.schemas import ALERT
from hyetos.sources import snapshots
from hyetos.sources.snapshots import (
    batch_folder,
    export_records,
    history_path,
    latest_entry,
    read_history,
    read_latest,
    read_manifest,
    read_trend_records,
    with_record_bounds,
    write_snapshot,
)


@pytest.fixture
def frame(spark):
    return spark.range(5)


def test_latest_is_the_last_batch_even_if_empty(spark, frame, tmp_path):
    root = str(tmp_path)
    write_snapshot(frame, 0, root, "k", "q")
    write_snapshot(frame.filter("id > 2"), 9, root, "k", "q")
    write_snapshot(frame.filter("id > 1"), 10, root, "k", "q")
    assert rows(read_latest(spark, root, "k")) == [(2,), (3,), (4,)]
    assert rows(read_manifest(spark, root, "k")) == [(0, "q", 5), (10, "q", 3), (9, "q", 2)]
    write_snapshot(frame.filter("id > 7"), 11, root, "k", "q")
    assert latest_entry(spark, root, "k").n_rows == 0
    assert rows(read_latest(spark, root, "k")) == []
    assert read_history(spark, root, "k").count() == 10


def test_no_snapshot_yet(spark, tmp_path):
    assert read_latest(spark, str(tmp_path), "k") is None
    empty = read_latest(spark, str(tmp_path), "k", ALERT)
    assert empty.columns == ["name", "timestamp", "temperature", "wind_speed", "alert_type"]
    assert empty.count() == 0


def test_repeating_a_batch_changes_nothing(spark, frame, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        write_snapshot(frame, 0, root, "k")
    assert read_history(spark, root, "k").count() == 5


def test_a_batch_without_manifest_entry_is_not_seen(spark, frame, tmp_path):
    root = str(tmp_path)
    write_snapshot(frame, 0, root, "k")
    frame.write.parquet(f"{history_path(root, 'k')}/{batch_folder(1)}")
    (tmp_path / "k" / "manifest" / batch_folder(1) / "_temporary").mkdir(parents=True)
    assert read_history(spark, root, "k").count() == 5
    assert latest_entry(spark, root, "k").batch_id == 0
    write_snapshot(frame.filter("id = 0"), 1, root, "k")
    assert rows(read_latest(spark, root, "k")) == [(0,)]


def read_json(path):
    return [json.loads(line) for part in path.glob("*.json") for line in part.read_text().splitlines()]


def test_records(spark, tmp_path):
    half = at(1) + timedelta(microseconds=500000)
    data = [("A", at(0), 1.5, 1, 2.0, "x"), ("A", half, math.nan, 2, 2.0, None)]
    frame = forecast_frame(spark, data, real="double")
    trends = trend(frame)
    export_records(trends, str(tmp_path / "trends"))
    records = sorted(read_json(tmp_path / "trends"), key=lambda r: r["window"])
    assert records[0]["window"] == ["2024-06-01T00:00:00", "2024-06-01T00:10:00"]
    assert "avg_temp" not in records[1] and "common_condition" not in records[1]
    back = read_trend_records(spark, str(tmp_path / "trends"))
    assert rows(back, "window_start", "window_end", "name", "avg_humidity", "common_condition") == rows(
        with_window_bounds(trends), "window_start", "window_end", "name", "avg_humidity", "common_condition"
    )
    export_records(extreme(forecast_frame(spark, [("A", half, 31.0, 1, 2.0, "x")])), str(tmp_path / "alerts"))
    assert read_json(tmp_path / "alerts")[0]["timestamp"] == "2024-06-01T01:00:00.500000"


def test_window_forms(spark):
    def bounds(ddl, window):
        return with_record_bounds(spark.createDataFrame([("A", window)], f"name string, window {ddl}"))

    end = at(0) + timedelta(minutes=10)
    pair = bounds("array<string>", ["2024-06-01T00:00:00", "2024-06-01T00:10:00"])
    assert rows(pair) == [(at(0), end, "A")]
    assert rows(bounds("array<string>", ["2024-06-01 00:00"])) == [(at(0), None, "A")]
    assert rows(bounds("struct<start timestamp, end timestamp>", (at(0), end))) == [(at(0), end, "A")]
    assert rows(bounds("string", "2024-06-01T00:00:00")) == [(at(0), "A")]
    assert rows(bounds("string", "no time")) == [(None, "A")]
    assert rows(bounds("timestamp", at(0))) == [(at(0), "A")]
    assert bounds("int", 3).columns == ["name", "window"]
    plain = spark.createDataFrame([("A",)], "name string")
    assert with_record_bounds(plain).columns == ["name"]


def test_compacted_history_is_the_same_history(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "MOST_SEGMENTS", 2)
    root, readers = str(tmp_path), []
    for n in range(9):
        snapshots.write_snapshot(spark.range(n, n + 5).withColumn("n", F.lit(n)), n, root, "k", f"q{n}")
        readers.append((n, snapshots.read_history(spark, root, "k")))  # files are listed here
        if n % 2:
            assert snapshots.compact(spark, root, "k") == n // 2
            readers.append((n, snapshots.read_history(spark, root, "k")))
            for upto, reader in readers[-2:]:  # one that began before the swap, one after it
                assert reader.count() == 5 * (upto + 1)
            if n > 3:
                snapshots.expire(spark, root, "k")
                assert readers[-2][1].count() == 5 * (n + 1)  # the one before the swap keeps its files
    found = snapshots.read_history(spark, root, "k")
    assert rows(found, "batch_id", "id", "n") == sorted([(n, i, n) for n in range(9) for i in range(n, n + 5)], key=repr)
    entries = rows(snapshots.read_manifest(spark, root, "k"))
    assert entries == sorted([(n, f"q{n}", 5) for n in range(9)], key=repr)
    assert snapshots.latest_entry(spark, root, "k").batch_id == 8
    assert len(snapshots.latest_generation(spark, root, "k").segments) <= 3
    folders = sorted(p.name for p in (tmp_path / "k" / "history").iterdir())
    assert len(folders) < 6 and folders[-1] == "batch_id=000000000008"


def test_a_compacted_batch_is_not_written_again(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        snapshots.write_snapshot(spark.range(2), n, root, "k")
    assert snapshots.compact(spark, root, "k", keep_last=0) == 0
    assert snapshots.compact(spark, root, "k", keep_last=0) is None
    snapshots.write_snapshot(spark.range(50), 1, root, "k")
    assert snapshots.read_history(spark, root, "k").count() == 6
    snapshots.expire(spark, root, "k")  # nothing before the first generation is removed
    assert len(list((tmp_path / "k" / "history").iterdir())) == 3


def test_half_written_batches_and_generations_are_not_seen(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        snapshots.write_snapshot(spark.range(2), n, root, "k")
    spark.range(9).write.parquet(f"{root}/k/history/batch_id=000000000003")  # without an entry
    (tmp_path / "k" / "generations" / "gen=000000000000").mkdir(parents=True)  # nothing in it yet
    assert snapshots.latest_generation(spark, root, "k") is None
    assert snapshots.read_history(spark, root, "k").count() == 6
    with pytest.raises(Exception):
        snapshots.compact(spark, root, "k")  # another compaction holds that number
    assert snapshots.read_history(spark, root, "k").count() == 6
