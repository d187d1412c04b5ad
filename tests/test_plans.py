"""Physical plans keep the shape they were designed for."""

import os

import pytest

from hyetos.operators.revisions import latest_revision
from hyetos.operators.trends import trend
from hyetos.params import TrendParams
from hyetos.plans.queries import QUERIES, STREAM_KEYS
from hyetos.sources.events import forecast_view, read_events

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAM_KEYS))
def test_no_python_no_cross_join_no_window_over_a_group(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "NestedLoop", "CartesianProduct", "WindowExec", "collect_list"):
        assert operator not in text
    # Only a set-returning sort or aggregate may gather, never into one partition.
    assert "SinglePartition" not in text


def test_trend_hashes_raw_rows_and_combines_before_the_shuffle(spark):
    text = plan(trend(forecast_view(read_events(spark, SF_DIR)), TrendParams(decimals=2)))
    lines = [line for line in text.splitlines() if "Aggregate(" in line or "Exchange" in line]
    kinds = [line.strip(" +-:*").split("(")[0].split(" ")[0] for line in lines]
    assert kinds == ["SortAggregate", "Exchange", "SortAggregate", "HashAggregate", "Exchange", "HashAggregate"]
    assert "forecast_date" not in text and "event_id" not in text


def test_latest_revision_shuffles_one_row_per_key_and_task(spark):
    text = plan(latest_revision(forecast_view(read_events(spark, SF_DIR))))
    assert text.count("Exchange") == 1
    assert text.index("partial_max") > text.index("Exchange")


def test_slice_reaches_the_scan(spark):
    text = plan(QUERIES["hourly_slice"](spark, SF_DIR))
    pushed = text.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_scans_read_only_what_is_used(spark):
    for name, columns in {"distinct_cities": "user_id:bigint", "timestamp_parse": "event_id:bigint,ts:timestamp_ntz,event_type:string"}.items():
        text = plan(QUERIES[name](spark, SF_DIR))
        assert text.split("ReadSchema: struct<")[1].split(">")[0] == columns
