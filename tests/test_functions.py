from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from segment_hours.functions import geo, text, time


def values(spark, items, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_hhmm(spark):
    given = ["0800", " 830 ", "5", "59", "60", "2360", "2400", "12059", "12123", "123456", "8:30", "", "0915H", None]
    wanted = ["0800", "0830", "0005", "0059", None, None, None, "1259", None, None, None, None, None, None]
    assert values(spark, given, "string", text.hhmm) == wanted


def test_hhmm_minutes_with_lost_zeros(spark):
    assert values(spark, ["0905", "905", "5", "x"], "string", text.hhmm_minutes) == [545, 545, 5, None]


def test_segment_id_floors(spark):
    given = [0.0, 7.9, 8.0, -1.0, -8.5, None]
    made = values(spark, given, "double", lambda c: text.segment_id(F.lit("ABC"), c))
    assert made == ["ABC_0", "ABC_0", "ABC_8", "ABC_-8", "ABC_-8", "ABC_0"]


def test_rotate_mask_and_prefix(spark):
    assert values(spark, ["1000000", "0000001"], "string", text.rotate_mask) == ["0100000", "1000000"]
    assert values(spark, ["123:456", "9", "x:1", None], "string", text.split_prefix_int) == [123, 9, None, None]


@pytest.mark.parametrize(
    ("name", "season", "period"),
    [
        ("Transparency 2023-24 P01.zip", "202324", "P01"),
        ("all-202324_P13.ZIP", "202324", "P13"),
        ("x 23-24p02.zip", "202324", "P02"),
        ("notes.zip", None, None),
        ("2023-24 P01.csv", None, None),
    ],
)
def test_period_name(spark, name, season, period):
    assert values(spark, [name], "string", text.parse_period_name)[0] == (season, period)


def test_round_hour_ties_go_to_even(spark):
    day = dt.datetime(2024, 1, 1)
    given = [
        day + dt.timedelta(minutes=30),
        day + dt.timedelta(minutes=90),
        day + dt.timedelta(minutes=29, seconds=59, microseconds=999999),
        day + dt.timedelta(minutes=30, microseconds=1),
        day + dt.timedelta(hours=23, minutes=30),
    ]
    wanted = [day, day + dt.timedelta(hours=2), day, day + dt.timedelta(hours=1), day + dt.timedelta(days=1)]
    assert values(spark, given, "timestamp_ntz", time.round_hour) == wanted


def test_dates(spark):
    assert values(spark, ["240229", "230229", " 991231", None], "string", time.yymmdd) == [
        dt.date(2024, 2, 29), None, dt.date(2099, 12, 31), None,
    ]
    given = ["01-APR-2024 07:05", "01/04/2024 07:05", "01/Apr/2024 07:05", "2024-04-01", None]
    stamp = dt.datetime(2024, 4, 1, 7, 5)
    assert values(spark, given, "string", time.parse_dayfirst) == [stamp, stamp, stamp, None, None]


def test_business_periods(spark):
    given = [dt.datetime(2024, 4, 1), dt.datetime(2024, 4, 29), dt.datetime(2025, 3, 31, 23), dt.datetime(2024, 3, 31)]
    assert values(spark, given, "timestamp_ntz", time.business_period) == [
        "202425_P01", "202425_P02", "202425_P14", "202324_P14",
    ]
    assert time.business_year_start(dt.date(2025, 3, 31)) == dt.date(2024, 4, 1)
    codes = time.period_calendar(spark, "2024-04-01", "2024-05-01").select("code").collect()
    assert sorted(r[0] for r in codes) == ["202425_P01", "202425_P02"]
    with pytest.raises(ValueError):
        time.period_calendar(spark, "2024-05-01", "2024-04-01")


def test_timetable_seasons(spark):
    assert time.timetable_seasons("2024-04-30", "2024-12-01") == ["202324_DEC", "202425_MAY", "202425_DEC"]
    given = [dt.datetime(2024, 4, 30), dt.datetime(2024, 5, 1), dt.datetime(2024, 12, 1)]
    assert values(spark, given, "timestamp_ntz", time.timetable_season) == ["202324_DEC", "202425_MAY", "202425_DEC"]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 5, 6, 7),)], "ts timestamp_ntz")
    assert time.with_date_parts(df, "ts", None).drop("ts").first() == (2024, 1, 7, 5, 6, 7, 6)
    with pytest.raises(ValueError):
        time.with_date_parts(df, "ts", ["century"])


def test_hour_index_is_independent_of_the_session_zone(spark):
    stamp = dt.datetime(2024, 3, 31, 1, 15)  # an hour that London skips
    df = spark.createDataFrame([(stamp,)], "ts timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/London")
        floored = df.select(time.hour_floor(F.col("ts")), time.hour_index(F.col("ts"))).first()
        assert values(spark, ["31/03/2024 01:15"], "string", time.parse_dayfirst) == [stamp]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(floored) == (dt.datetime(2024, 3, 31, 1), time.hour_index_literal(stamp))


def test_as_datetime():
    assert time.as_datetime("2024-01-02") == time.as_datetime(dt.date(2024, 1, 2)) == dt.datetime(2024, 1, 2)
    with pytest.raises(TypeError):
        time.as_datetime(20240102)


def test_grid_to_degrees(spark):
    # worked example of the national grid guide (52 39 28.8 N, 1 42 57.8 E)
    df = spark.createDataFrame([(651409.903, 313177.270)], "e double, n double")
    lat, lon = geo.osgb_to_wgs84(df, "e", "n").select("Latitude", "Longitude").first()
    assert lat == pytest.approx(52.65798, abs=5e-5)
    assert lon == pytest.approx(1.71605, abs=5e-5)
