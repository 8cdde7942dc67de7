from __future__ import annotations

import datetime as dt

import pytest

from segment_hours.config import HOUR_KEYS, PARTITION_KEYS
from segment_hours.operators.weather import station_links
from segment_hours.plans import features
from segment_hours.streaming.incidents import latest_counts, run_chunks, stream_incident_counts


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for table, column in (("TD", "min_air_temp"), ("RH", "prcp_amt")):
        rows = ["src_id,meto_stmp_time," + column]
        for day in (30, 31):
            rows += [f"7,2023-12-{day} {h:02d}:10:00,{h - 5}" for h in range(0, 24, 6)]
        (root / f"{table}_2023.csv").write_text("\n".join(rows))
        rows = ["src_id,meto_stmp_time," + column] + [f"7,2024-01-01 {h:02d}:10:00,{h}" for h in range(0, 24, 6)]
        (root / f"{table}_2024.csv").write_text("\n".join(rows))
    (root / "delay_202324_P10.csv").write_text(
        "EVENT_DATETIME,INCIDENT_REASON,SECTION_CODE\n2024-01-01 03:30:00,R1,11:1\n2024-01-01 05:00:00,R1,11:1\n2024-01-09 05:00:00,R2,11:1\n"
    )
    (root / "delay_202324_P01.csv").write_text("EVENT_DATETIME,INCIDENT_REASON,SECTION_CODE\n2023-04-01 03:30:00,R7,11:1\n")
    return root


def build(spark, root, out, **layout):
    start, end = "2024-01-01 00:00:00", "2024-01-01 23:00:00"
    segment_map = spark.createDataFrame([(11, "A_0", 0)], "STANOX long, ELR_MIL string, pos int")
    hops = spark.createDataFrame(
        [("T1", "S", 11, "x", "1111111", "905", "231201", "240201")],
        "train_id string, train_service_id string, stanox_dep long, stanox_arr string, daysofweek string, dep_time string, start_date string, end_date string",
    )
    stations = spark.createDataFrame([("A_0", "2023", 7, 7), ("A_0", "2024", 7, 7)], "loc_id string, year string, src_id_TD int, src_id_RH int")
    schemas = {
        "TD": "src_id int, meto_stmp_time string, min_air_temp double",
        "RH": "src_id int, meto_stmp_time string, prcp_amt double",
    }
    rolling = [features.WEATHER_ROLLING[0], features.WEATHER_ROLLING[2]]
    weather = features.build_weather(spark, root, stations, schemas, start, end, rolling=rolling, flags=features.WEATHER_FLAGS[:1])
    incidents = features.build_incidents(spark, root, segment_map, start, end, schema="EVENT_DATETIME string, INCIDENT_REASON string, SECTION_CODE string")
    features.create_datasets(spark, out, segment_map, hops, incidents, weather, start, end, **layout)
    return features.build_modelling_frame(spark, out)


def test_feature_tables_end_to_end(spark, inputs, tmp_path):
    out = f"{tmp_path}/features"
    wide = build(spark, str(inputs), out)
    found = wide.collect()
    rows = {r["hour"]: r for r in found}
    assert len(rows) == 24 and wide.columns[:5] == HOUR_KEYS
    assert rows[3]["INCIDENT_R1"] == 1 and rows[5]["INCIDENT_R1"] == 0  # one event per reason and period
    assert "INCIDENT_R7" not in wide.columns
    assert rows[9]["train_count"] == 1 and rows[8]["train_count"] == 0
    assert rows[0]["min_air_temp_min_48h"] == -5.0  # reaches back into the year before
    assert rows[0]["flag_freeze"] == 1
    assert rows[2]["prcp_amt_sum_6h"] == 13 * 4 + 0 * 3  # 20:00-23:00 carry 13, then 0
    again = build(spark, str(inputs), out)  # replaces the same partitions
    assert sorted(map(str, again.collect())) == sorted(map(str, found))
    one = features.build_modelling_frame(spark, out, segment="A_0", time_filter={"year": 2024, "day": [1]})
    assert one.count() == 24
    by_day = build(spark, str(inputs), f"{tmp_path}/by_day", keys=PARTITION_KEYS)
    assert sorted(map(str, by_day.select(*wide.columns).collect())) == sorted(map(str, found))


def test_station_map_of_segments(spark):
    located = spark.createDataFrame(
        [("A_0", 651400.0, 313100.0), ("A_0", 651420.0, 313254.0), ("B_0", 400000.0, 300000.0)],
        "ELR_MIL string, EASTING double, NORTHING double",
    )
    east = spark.createDataFrame([(1, 2024, 52.6, 1.7), (2, 2024, 52.5, -2.0)], "src_id long, year int, lat double, lon double")
    made = features.build_station_map(located, {"TD": east, "RH": east.where("src_id = 2")}, [2024])
    assert sorted(map(tuple, made.collect())) == [("A_0", "2024", 1, 2), ("B_0", "2024", 2, 2)]


def test_station_links_skip_missing_stations(spark):
    stations = spark.createDataFrame([("A", "2024", 1, None)], "loc_id string, year string, src_id_TD int, src_id_RH int")
    assert [tuple(r) for r in station_links(stations, ["TD", "RH"]).collect()] == [("A", 2024, "TD", 1)]


def incident_batch(spark, rows):
    return spark.createDataFrame(rows, "ELR_MIL string, EVENT_DATETIME timestamp_ntz, INCIDENT_REASON string")


def test_stream_over_several_batches_equals_batch_counts(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{n}" for n in ("source", "out", "state"))
    at = dt.datetime(2024, 1, 1, 5)
    rows = [("A", at + dt.timedelta(minutes=20 * i), f"R{i % 2}") for i in range(12)]
    schema = incident_batch(spark, rows).schema

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        stream_incident_counts(stream, out, state).awaitTermination()

    incident_batch(spark, rows[:5]).coalesce(1).write.mode("append").parquet(source)
    run()
    incident_batch(spark, rows[5:9]).coalesce(1).write.mode("append").parquet(source)
    incident_batch(spark, rows[9:]).coalesce(1).write.mode("append").parquet(source)
    run()  # goes on where the first run ended
    got = {(r["ts"], r["INCIDENT_REASON"]): r["n"] for r in latest_counts(spark, out).collect()}
    wanted = {}
    for _, ts, reason in rows:
        key = (ts.replace(minute=0), reason)
        wanted[key] = wanted.get(key, 0) + 1
    assert got == wanted


def test_run_chunks_in_order():
    seen = []
    run_chunks(lambda a, b: seen.append((a, b)), [(1, 2), (3, 4)])
    assert seen == [(1, 2), (3, 4)]
