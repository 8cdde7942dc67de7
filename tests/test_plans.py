"""Facts about physical plans that matter at scale."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from compare import SF

from segment_hours.operators.slices import SLICE
from segment_hours.plans.queries import QUERIES

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="given tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["modelling_frame", "weather_features", "hourly_train_count", "nearest_segment", "nearest_station", "schedule_hops",
     "incident_dataset", "map_lookup_last_wins", "missing_partitions", "rolling_rows"],
)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["weather_features", "rolling_range_features", "backfill", "hourly_train_count", "schedule_hops"])
def test_row_windows_are_sliced(spark, name):
    """Every window runs over (key, slice), or over the one-row-per-slice summaries."""
    text = plan(QUERIES[name](spark, SF))
    windows = re.findall(r"Window \[.*\], \[([^\]]*)\], \[([^\]]*)\]", text)
    assert windows
    for keys, order in windows:
        assert SLICE in keys or SLICE in order


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["collapse_schedule"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"}
    assert "PushedFilters: [IsNotNull(ts)" in plan(QUERIES["filter_time_range"](spark, SF))


def test_rolling_frames_share_one_shuffle(spark):
    text = plan(QUERIES["rolling_flags"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*_slice", text)) == 1


def test_timetable_text_is_built_once(spark):
    """The lines are read from their stage; headers, which have no place, do not enter the join with the codes."""
    text = plan(QUERIES["timetable_lines_to_hops"](spark, SF))
    assert "lineitem" not in text and "l_orderkey" not in text
    assert len(re.findall(r"FileScan", text)) <= 6
    assert not re.findall(r"tiploc[^\n]*LeftOuter", text)
