import json
from datetime import datetime
from pathlib import Path

from helpers import rows
from pyspark.sql import functions as F

from hyetos.operators.flatten import current_conditions, flatten
from hyetos.plans import queries
from hyetos.sources import documents
from hyetos.sources.events import EVENT_DOCUMENT, LEAD_HOURS, document_view, forecast_view
from hyetos.sources.snapshots import read_manifest
from hyetos.streaming import queries as streams

DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark, props):
    ts = datetime(2024, 1, 1, 20, 30, 0, 5)
    return spark.createDataFrame([(n, ts, 8, "click", 12.5, p) for n, p in enumerate(props)], DDL)


def test_reading_in_usual_and_other_forms(spark):
    props = ['{"k": 7}', '{"k": 123}', '{"k":8}', '{"k": "9"}', '{"j": 1, "k": 10}', '{"k": 11, "j": 2}', '{"k": -3}']
    props += ['{"j": 1}', "no json", '{"k": 12', "", None]
    found = forecast_view(events(spark, props)).orderBy("event_id").collect()
    assert [r.humidity for r in found] == [7, 123, 8, 9, 10, 11, -3, None, None, None, None, None]
    assert found[0].wind_speed == 8.25 and found[7].wind_speed is None


def test_documents_forecast_the_lead_hours(spark):
    one = events(spark, ['{"k": 4}'])
    flat = flatten(document_view(one), hour_extra=("event_id",))
    days = ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-02"]
    assert len(LEAD_HOURS) == 4 and rows(flat, "forecast_date") == [(d,) for d in days]
    assert rows(flat, "temp") == [(2.5,), (3.0,), (3.5,), (4.0,)]
    assert flat.filter(F.hour("forecast_time") % 8 != 4).count() == 0
    now = current_conditions(document_view(one)).first()
    assert (now.name, now.current_temp, now.current_humidity) == ("CITY_1", 2.5, 4)
    assert now.fetch_time == datetime(2024, 1, 1, 20, 30, 0, 5)


def lengths(folder):
    return [len(json.loads(f.read_text())) for f in Path(folder.removeprefix("file:")).glob("part-*")]


def test_hot_timestamp_lands_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "MOST_DOCUMENTS", 100, raising=False)
    hot = events(spark, [f'{{"k": {i % 90}}}' for i in range(450)]).coalesce(1)
    hot.write.parquet(f"{tmp_path}/events.parquet")
    root = queries._run_pipeline(spark, str(tmp_path), "hot")
    sizes = lengths(f"{root}/landing")
    assert sum(sizes) == 450 and max(sizes) <= 100
    docs = document_view(spark.read.parquet(f"{tmp_path}/events.parquet"))
    documents.land_arrays(docs, f"{tmp_path}/landing")
    assert sorted(lengths(f"{tmp_path}/landing")) == [50, 100, 100, 100, 100]
    found = documents.read_documents(spark, f"{tmp_path}/landing", EVENT_DOCUMENT, arrays=True)
    flat = lambda rows: sorted(map(repr, flatten(rows, hour_extra=("event_id",)).collect()))
    assert flat(found) == flat(docs)


def test_batches_of_the_main_path_do_not_grow_with_its_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "MOST_DOCUMENTS", 1)
    table = events(spark, [f'{{"k": {i % 90}}}' for i in range(330)]).coalesce(1)
    table.write.parquet(f"{tmp_path}/events.parquet")
    root = queries._run_pipeline(spark, str(tmp_path), "many")
    assert len(lengths(f"{root}/landing")) == 330
    for kind in (streams.TRENDS, streams.EXTREME):
        assert read_manifest(spark, root, kind).count() == 3
