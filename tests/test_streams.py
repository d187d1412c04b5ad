import random
from datetime import timedelta

import pytest
from helpers import at, document, forecast_frame, land, rows

from hyetos.operators.alerts import alert_sessions, extreme
from hyetos.operators.flatten import flatten
from hyetos.operators.revisions import latest_revision
from hyetos.operators.trends import trend
from hyetos.sources.documents import read_documents, stream_documents, stream_judged
from hyetos.sources.snapshots import (
    compact,
    expire,
    group_counts,
    read_group,
    read_history,
    read_latest,
    read_manifest,
    write_group,
)
from hyetos.streaming import queries as streams
from hyetos.streaming.spells import start_spells

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
CONDITIONS = ("Sunny", "Fog", "Rain")


def cycle(n, span=12):
    """Fetch cycle n: two places, hours n*6 to n*6+span, readings that vary by cycle."""
    docs = []
    for place in range(2):
        hours = [
            (at(n * 6 + h), float((h * 7 + n * 5 + place) % 45 - 5), (h + n) % 100, float((h * 3 + n) % 30), CONDITIONS[(h + n) % 3])
            for h in range(span)
        ]
        docs.append(document(f"C{place}", at(n * 6), hours))
    return docs


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    for n in range(4):
        land(folder, f"cycle{n}", cycle(n))
    return folder


def stream(spark, landing, **options):
    return flatten(stream_documents(spark, str(landing), arrays=True, **options))


def batch(spark, landing):
    return flatten(read_documents(spark, str(landing), arrays=True))


def run(query):
    streams.await_all([query])


def test_trend_equals_batch(spark, landing, tmp_path):
    root = str(tmp_path / "job")
    run(streams.start_trend(stream(spark, landing, max_files=1), root, once=True))
    assert read_manifest(spark, root, streams.TRENDS).count() == 4
    expected = trend(batch(spark, landing))
    assert rows(read_latest(spark, root, streams.TRENDS), *expected.columns) == rows(expected)


def test_alerts_equal_batch_and_latest_is_the_last_file(spark, landing, tmp_path):
    root = str(tmp_path / "job")
    run(streams.start_alerts(stream(spark, landing, max_files=1), root, once=True))
    history = read_history(spark, root, streams.EXTREME)
    assert history.select("batch_id").distinct().count() == 4
    expected = rows(extreme(batch(spark, landing)))
    assert expected and rows(history.drop("batch_id")) == expected
    assert read_latest(spark, root, streams.EXTREME).count() < len(expected)


def test_restart_goes_on_where_it_stopped(spark, landing, tmp_path):
    root = str(tmp_path / "job")
    for _ in range(2):
        run(streams.start_alerts(stream(spark, landing), root, once=True))
        run(streams.start_trend(stream(spark, landing), root, once=True))
    assert rows(read_history(spark, root, streams.EXTREME).drop("batch_id")) == rows(extreme(batch(spark, landing)))
    land(landing, "later", cycle(9))
    run(streams.start_alerts(stream(spark, landing), root, once=True))
    run(streams.start_trend(stream(spark, landing), root, once=True))
    assert rows(read_history(spark, root, streams.EXTREME).drop("batch_id")) == rows(extreme(batch(spark, landing)))
    expected = trend(batch(spark, landing))
    assert rows(read_latest(spark, root, streams.TRENDS), *expected.columns) == rows(expected)
    entry = read_manifest(spark, root, streams.EXTREME).select("query_id").distinct().collect()
    assert len(entry) == 1 and entry[0].query_id


def test_history_without_checkpoint_is_refused(spark, landing, tmp_path):
    root = tmp_path / "job"
    (root / streams.EXTREME / "history" / "batch_id=0").mkdir(parents=True)
    with pytest.raises(ValueError, match="no checkpoint"):
        streams.start_alerts(stream(spark, landing), str(root), once=True)


def test_two_queries_run_side_by_side(spark, landing, tmp_path):
    root = str(tmp_path / "job")
    both = [
        streams.start_trend(stream(spark, landing), root, once=True),
        streams.start_alerts(stream(spark, landing), root, once=True),
    ]
    assert both[0].id != both[1].id
    streams.await_all(both)
    assert read_latest(spark, root, streams.TRENDS).count() > 0
    assert read_latest(spark, root, streams.EXTREME).count() > 0


def test_a_failing_sink_fails_the_query(spark, landing, tmp_path):
    root = tmp_path / "job"
    (root / streams.EXTREME).mkdir(parents=True)
    (root / streams.EXTREME / "manifest").write_text("a file where a folder must be")
    query = streams.start_alerts(stream(spark, landing), str(root), once=True)
    with pytest.raises(Exception):
        streams.await_all([query])


def test_await_any_raises_the_failure_and_stops_the_rest(spark, landing, tmp_path):
    root = tmp_path / "job"
    (root / streams.EXTREME).mkdir(parents=True)
    (root / streams.EXTREME / "manifest").write_text("a file where a folder must be")
    spark.streams.resetTerminated()
    healthy = streams.start_trend(stream(spark, landing), str(root))
    streams.start_alerts(stream(spark, landing), str(root))
    with pytest.raises(Exception):
        streams.await_any(spark)
    assert not healthy.isActive
    spark.streams.resetTerminated()


def test_console_shows_the_batch(spark, landing, tmp_path, capfd):
    run(streams.start_alerts(stream(spark, landing), str(tmp_path / "job"), once=True, console=True))
    shown = capfd.readouterr().out
    assert "extreme batch 0" in shown and "alert_type" in shown


def test_flatten_equals_batch(spark, landing, tmp_path):
    root = str(tmp_path / "job")
    run(streams.start_flatten(stream_documents(spark, str(landing), max_files=2), root, once=True))
    expected = rows(batch(spark, landing))
    assert rows(read_history(spark, root, streams.FORECAST).drop("batch_id")) == expected


def test_bounded_trend_writes_closed_windows_once(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "job")
    for n in range(6):
        land(landing, f"cycle{n}", cycle(n, span=48))
        run(streams.start_trend_bounded(stream(spark, landing, max_files=1), root, delay="4 days", once=True))
    far = at(24 * 30)
    land(landing, "far", [document("C0", far, [(far, 1.0, 1, 1.0, "Fog")])])
    run(streams.start_trend_bounded(stream(spark, landing), root, delay="4 days", once=True))
    expected = trend(batch(spark, landing).filter(f"forecast_time < timestamp '{far - timedelta(days=4)}'"))
    found = read_history(spark, root, streams.TRENDS_BOUNDED)
    assert rows(found, *expected.columns) == rows(expected)


def test_alerts_once_per_hour(spark, landing, tmp_path):
    root = str(tmp_path / "job")
    forecast = stream(spark, landing, max_files=1)
    run(streams.start_alerts_once_per_hour(forecast, root, once=True))
    keys = ("name", "timestamp", "alert_type")
    once = rows(read_history(spark, root, streams.EXTREME_ONCE), *keys)
    repeated = rows(extreme(batch(spark, landing)), *keys)
    assert once == sorted(set(repeated), key=repr) and len(once) < len(repeated)


def test_revisions_follow_every_batch(spark, landing, tmp_path):
    root = str(tmp_path / "job")
    run(streams.start_revisions(stream(spark, landing, max_files=1), root, once=True))
    expected = latest_revision(batch(spark, landing))
    changes = read_history(spark, root, streams.REVISIONS).drop("batch_id")
    assert changes.count() > expected.count()
    assert rows(latest_revision(changes.select(*expected.columns))) == rows(expected)


def test_sessions_close_behind_the_watermark(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "job")
    for n in range(4):
        land(landing, f"cycle{n}", cycle(n))
        run(streams.start_sessions(stream(spark, landing), root, delay="2 days", once=True))
    far = at(24 * 30)
    land(landing, "far", [document("C0", far, [(far, 40.0, 1, 1.0, "Fog")])])
    run(streams.start_sessions(stream(spark, landing), root, delay="2 days", once=True))
    open_still = f"session_start < timestamp '{far}'"
    expected = alert_sessions(extreme(batch(spark, landing))).where(open_still)
    found = read_history(spark, root, streams.SESSIONS).drop("batch_id")
    assert rows(found) == rows(expected) and expected.count() > 2


def fetches(spark, folder, rows_in):
    """Land (name, hour, fetched, temp) as one file of flat forecast rows."""
    frame = forecast_frame(spark, [(n, h, t, 5, 1.0, "x", f) for n, h, f, t in rows_in])
    frame.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(frame.schema).parquet(str(folder))


def test_alerts_are_withdrawn_by_later_revisions(spark, tmp_path):
    source, everything, root = random.Random(2), [], str(tmp_path / "job")
    for n in range(4):
        new = [
            (source.choice("AB"), at(source.randrange(3)), at(n * 2 + source.randrange(0, 110) / 60), source.choice([20.0, 20.0, 40.0, None]))
            for _ in range(60)
        ]
        everything += new
        forecast = fetches(spark, tmp_path / "landing", new)
        run(streams.start_withdrawn(forecast, root, within="20 minutes", delay="5 minutes", once=True))
    last = at(100)
    closing = [("Z", at(0), last, 40.0), ("Z", at(1), last, 20.0)]  # move both watermarks on
    run(streams.start_withdrawn(fetches(spark, tmp_path / "landing", closing), root, within="20 minutes", delay="5 minutes", once=True))
    expected = set()
    for name, hour, fetched, temp in everything:
        if temp == 40.0:
            later = [f for n, h, f, t in everything if (n, h) == (name, hour) and t != 40.0 and fetched < f <= fetched + timedelta(minutes=20)]
            expected.add((name, hour, fetched, min(later, default=None)))
    found = streams.first_withdrawal(read_history(spark, root, streams.WITHDRAWN))
    found = rows(found.where("name <> 'Z'"), "name", "timestamp", "fetch_time", "withdrawn_at")
    assert found == sorted(expected, key=repr)
    assert {r[-1] is None for r in found} == {True, False}


def test_alerts_of_a_busy_hour_are_not_paired_with_its_revisions(spark, tmp_path):
    root, landing = str(tmp_path / "job"), tmp_path / "landing"
    hours = [("A", at(0), at(m / 60), t) for m in range(0, 20, 2) for t in [40.0] * 20]
    calm = [("A", at(0), at(m / 60), t) for m in range(1, 21, 2) for t in [20.0] * 20]
    nobody = [(None, at(0), at(0.1), 40.0), (None, at(0), at(0.2), 20.0), ("A", None, at(0.1), 40.0)]
    slow = {"within": "30 minutes", "delay": "30 minutes", "once": True}

    def go(new):
        run(streams.start_withdrawn(fetches(spark, landing, new), root, **slow))

    go(hours + calm + nobody)
    history = read_history(spark, root, streams.WITHDRAWN)
    assert history.count() == 200  # one row an alert, not one for each later revision
    go([("B", at(0), at(0.3), 40.0), ("B", at(0), at(0.5), 20.0)])
    go([("B", at(0), at(0.4), 15.0), ("A", at(0), at(0.5 / 60), 10.0)])  # late, yet before what was known
    go([("Z", at(0), at(9), 40.0), ("Z", at(1), at(9), 20.0)])  # move the mark on
    history = read_history(spark, root, streams.WITHDRAWN).where("name is null or name <> 'Z'")
    assert history.count() == 200 + 1 + 1 + 20 + 2  # B; then B and the alerts of minute 0 again; those of nobody
    found = streams.first_withdrawal(history).select("name", "fetch_time", "withdrawn_at", "temperature_then")
    expected = {("A", at(m / 60), at((m + 1) / 60), 20.0) for m in range(2, 20, 2)}
    expected |= {("A", at(0), at(0.5 / 60), 10.0), ("B", at(0.3), at(0.4), 15.0)}
    expected |= {(None, at(0.1), None, None), ("A", at(0.1), None, None)}
    assert rows(found) == sorted(expected, key=repr)
    waiting = spark.read.parquet(f"{root}/{streams.WITHDRAWN}/waiting/batch_id=000000000003/rows")
    assert rows(waiting, "name") == [("Z",), ("Z",)]  # what is settled does not wait


def spells_by_hand(peaks, mark, quiet=2):
    """Closed spells of {name: {hour number: peak}} for the hours closed at ``mark``."""
    found = []
    for name, hours in peaks.items():
        spell = None
        for hour in sorted(h for h in hours if h + 1 <= mark):
            if spell and hour - spell[1] > quiet:
                found.append((name, *spell, "quiet"))
                spell = None
            if spell and hours[hour] <= 25:
                found.append((name, *spell, "calm"))
                spell = None
            elif spell:
                spell = (spell[0], hour, spell[2] + 1, max(spell[3], hours[hour]))
            elif hours[hour] > 30:
                spell = (hour, hour, 1, hours[hour])
        if spell and spell[1] + quiet + 1 <= mark:
            found.append((name, *spell, "quiet"))
    return sorted(found, key=repr)


def test_spells_open_last_and_close_across_restarts(spark, tmp_path):
    source, peaks, root = random.Random(6), {}, str(tmp_path / "job")
    for n in range(3):
        new = []
        for name in ("A", "B", "C") if n < 2 else ("A",):  # B and C fall silent
            for hour in range(n * 12, n * 12 + 12):
                if source.random() > 0.35:
                    temps = [float(source.choice([10, 26, 28, 33, 35])) for _ in range(source.choice([1, 3]))]
                    peaks.setdefault(name, {})[hour] = max(temps)
                    new += [(name, at(0), at(hour + source.randrange(0, 59) / 60), t) for t in temps]
        run(start_spells(fetches(spark, tmp_path / "landing", new), root, delay="1 minute", once=True))
        newest = max(f for _, _, f, _ in new)
        mark = (newest - at(0) - timedelta(minutes=1)) / timedelta(hours=1)
        found = read_history(spark, root, streams.SPELLS)
        hours = [((r.opened - at(0)) / timedelta(hours=1), (r.last_hour - at(0)) / timedelta(hours=1)) for r in found.collect()]
        shown = [(r.name, int(a), int(b), r.n_hours, r.peak, r.closed_by) for r, (a, b) in zip(found.collect(), hours)]
        assert sorted(shown, key=repr) == spells_by_hand(peaks, mark)
    assert {r[-1] for r in shown} == {"calm", "quiet"}


def test_spells_run_in_a_session_without_rocksdb(spark, tmp_path):
    before = spark.conf.get(PROVIDER_KEY)
    new = [("A", at(0), at(h), t) for h, t in enumerate([33.0, 28.0, 10.0, 10.0, 10.0])]
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(PROVIDER_KEY, default)
    try:
        run(start_spells(fetches(spark, tmp_path / "landing", new), str(tmp_path / "job"), delay="1 minute", once=True))
        assert spark.conf.get(PROVIDER_KEY) == default  # as it was, for other streams of the session
    finally:
        spark.conf.set(PROVIDER_KEY, before)
    found = read_history(spark, str(tmp_path / "job"), streams.SPELLS)
    assert rows(found, "name", "opened", "last_hour", "closed_by") == [("A", at(0), at(1), "calm")]


def test_one_read_serves_trend_alerts_and_damage(spark, landing, tmp_path):
    root = str(tmp_path / "job")
    (landing / "broken.json").write_text('[{"location": 3}, {"location": {"name": "C0"}}]')
    (landing / "cut.json").write_text('[{"location": ')

    def go():
        judged = stream_judged(spark, str(landing), arrays=True, max_files=2)
        run(streams.start_shared(judged, root, once=True))

    go()
    land(landing, "later", cycle(9))
    go()  # goes on from its checkpoint
    sound = flatten(read_documents(spark, str(landing), arrays=True, skip_damaged=True))
    expected = trend(sound)
    assert rows(streams.shared_trend(spark, root), *expected.columns) == rows(expected)
    found = read_group(spark, root, streams.SHARED, streams.EXTREME)
    assert rows(found.drop("batch_id")) == rows(extreme(sound)) and found.select("batch_id").distinct().count() > 2
    damaged = read_group(spark, root, streams.SHARED, streams.DAMAGED)
    assert rows(damaged, "fault", "text") == [("location is of another type", '{"location":3}'), ("not one array", '[{"location": ')]
    counts = group_counts(spark, root, streams.SHARED).collect()
    assert sum(r.counts[streams.DAMAGED] for r in counts) == 2
    assert sum(r.counts[streams.EXTREME] for r in counts) == found.count()


def test_a_batch_counts_once_all_its_results_are_there(spark, landing, tmp_path):
    root = tmp_path / "job"
    judged = stream_judged(spark, str(landing), arrays=True)
    run(streams.start_shared(judged, str(root), once=True))
    before = read_group(spark, str(root), streams.SHARED, streams.EXTREME).count()
    half = root / streams.SHARED / streams.EXTREME / "history" / "batch_id=000000000007"
    read_group(spark, str(root), streams.SHARED, streams.EXTREME).drop("batch_id").write.parquet(str(half))
    assert read_group(spark, str(root), streams.SHARED, streams.EXTREME).count() == before > 0
    write_group({streams.EXTREME: spark.range(5)}, 0, str(root), streams.SHARED)  # complete: not written again
    assert read_group(spark, str(root), streams.SHARED, streams.EXTREME).count() == before


def test_a_stream_goes_on_after_its_history_is_compacted(spark, landing, tmp_path):
    root = str(tmp_path / "job")
    run(streams.start_alerts(stream(spark, landing, max_files=1), root, once=True))
    assert compact(spark, root, streams.EXTREME, keep_last=0) == 0
    for n in (9, 11):
        land(landing, f"later{n}", cycle(n))
        run(streams.start_alerts(stream(spark, landing), root, once=True))
        compact(spark, root, streams.EXTREME)
        expire(spark, root, streams.EXTREME)
    found = read_history(spark, root, streams.EXTREME)
    assert rows(found.drop("batch_id")) == rows(extreme(batch(spark, landing)))
    assert found.select("batch_id").distinct().count() == 6
