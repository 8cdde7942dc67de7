"""Ranges of hours and periods come from the whole tables."""

from __future__ import annotations

import datetime as dt

from segment_hours.plans import fixtures as fx
from segment_hours.plans.queries import QUERIES

LOW, HIGH = dt.datetime(2023, 12, 30, 5, 40), dt.datetime(2024, 2, 2, 7, 10)


def test_hours_and_periods_reach_over_the_whole_tables(spark, tmp_path):
    def write(name, rows):
        spark.createDataFrame(rows, fx.SCHEMAS[name]).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    write("events", [(1, LOW, 3, "view", 2.0, '{"k": 3}'), (2, HIGH, 3, "view", 4.0, '{"k": 3}')])
    order = (1, 5, "O", 1.0)
    days = [dt.datetime(1990, 5, 1), dt.datetime(2004, 5, 1)]
    write("orders", [(*order, day, "5-LOW") for day in days])
    sf = str(tmp_path)
    hours = int((HIGH.replace(minute=0) - LOW.replace(minute=0)).total_seconds() // 3600) + 1
    for name in ("hourly_spine", "chunked_equals_full", "modelling_frame"):
        rows = QUERIES[name](spark, sf).select("year", "month", "day", "hour").collect()
        assert len(rows) == len(set(rows)) == hours, name
        assert tuple(min(rows)) == (2023, 12, 30, 5) and tuple(max(rows)) == (2024, 2, 2, 7), name
    frame = QUERIES["modelling_frame"](spark, sf)
    assert frame.where("INCIDENT_R3 > 0").count() == 2
    codes = {r.code for r in QUERIES["missing_partitions"](spark, sf).collect()}
    # 14 periods from April to March; the two with an order are there
    assert "199091_P01" not in codes and "199091_P03" in codes and "200304_P14" in codes
