from datetime import datetime

import pytest
from helpers import at, document, land, rows

from hyetos import app
from hyetos.sources.snapshots import read_latest


def test_stream_then_serve(spark, tmp_path, monkeypatch):
    landing, root, out = (str(tmp_path / p) for p in ("landing", "job", "out"))
    hours = [(at(h), 20.0 + h, 50, 5.0, "Sunny") for h in range(30)]
    land(tmp_path / "landing", "a", [document("A", at(0), hours), document("B", at(0), hours[:5])])
    monkeypatch.setattr(spark, "stop", lambda: None)
    app.main(["stream", "--landing", landing, "--root", root, "--once", "--max-files", "1", "--arrays"])
    app.main(["serve", "--root", root, "--out", out, "--as-of", "2024-06-01T12:00"])

    def table(name):
        return spark.read.parquet(f"{out}/{name}")

    assert rows(table("city_card"), "name", "temperature_text", "alert_type") == [
        ("A", "49.0°C", "HIGH TEMPERATURE"),
        ("B", "24.0°C", None),
    ]
    assert table("city_timeline").count() == 35
    assert table("hourly_slice").count() == 35
    assert rows(table("daily_forecast"), "name", "day_label") == [("A", "Sat 01"), ("A", "Sun 02"), ("B", "Sat 01")]


def test_serve_before_any_snapshot(spark, tmp_path):
    out = str(tmp_path / "out")
    app.main(["serve", "--root", str(tmp_path / "none"), "--out", out, "--format", "parquet"])
    assert spark.read.parquet(f"{out}/city_card").count() == 0


def test_stream_of_some_cities(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "job")
    documents = [document(name, at(0), [(at(0), 35.0, 50, 5.0, "Sunny")]) for name in "ABC"]
    land(tmp_path / "landing", "a", documents)
    app.main(["stream", "--landing", landing, "--root", root, "--once", "--arrays", "--cities", "A", "C"])
    for kind in ("trends", "extreme"):
        assert rows(read_latest(spark, root, kind), "name") == [("A",), ("C",)]


def test_bounded_trends_are_served_on_request_only(spark, tmp_path):
    landing, root, out = (str(tmp_path / p) for p in ("landing", "job", "out"))
    hours = [(at(h), 20.0, 50, 5.0, "Sunny") for h in range(0, 24 * 12)]
    land(tmp_path / "landing", "a", [document("A", at(0), hours)])
    app.main(["stream", "--landing", landing, "--root", root, "--once", "--arrays", "--bounded"])
    with pytest.raises(SystemExit):
        app.main(["serve", "--root", root, "--out", out])
    app.main(["serve", "--root", root, "--out", out, "--bounded"])
    assert spark.read.parquet(f"{out}/daily_forecast").count() >= 3
    app.main(["export", "--root", root, "--out", f"{out}/records", "--bounded"])
    assert spark.read.json(f"{out}/records/trends").count() > 70


def test_moments_are_utc():
    assert app.moment("2024-06-01T12:00+02:00") == datetime(2024, 6, 1, 10)
    assert app.moment("2024-06-01T12:00") == datetime(2024, 6, 1, 12)
