"""The registered queries and their SQL."""

import os

import pytest

import __spark_entry__ as entry
from checks import all_queries
from checks.compare import connect, oracle_rows, rows_of
from checks.views_sql import with_views

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are absent")
CHECKED = [
    "a04_hourly_volume_by_corridor", "a26_quarterly_avg", "c01_counts_hour", "e03_green_time", "m01_uptime_signal", "q03_before_after",
    "v03_travel_time_metrics", "w05_alert_streaks", "x02_tuesday_of_week",
]


def test_every_query_has_its_sql():
    assert set(all_queries.QUERIES) == set(all_queries.ORACLES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_views_come_before_their_users():
    sql = with_views("SELECT * FROM cycles")
    assert sql.index("event_log_day AS") < sql.index("green_pairs AS") < sql.index("gyr AS") < sql.index("cycles AS")


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, name):
    got = rows_of(entry.queries()[name](spark, SMALL))
    assert got == oracle_rows(connect(SMALL), entry.oracle_sql()[name])
    assert got[1]


@needs_data
def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["Zone_Group", "Corridor", "Hour", "vph", "ones", "delta"]
