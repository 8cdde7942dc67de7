"""Keys that must not repeat, names of a formula, stamps with offsets, and counts of late rows."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pytest

from segment_hours.functions.time import utc_ntz
from segment_hours.operators import frame, model, weather
from segment_hours.streaming import incidents


def test_key_that_repeats_in_a_table_is_an_error(spark):
    a = spark.createDataFrame([("x", 1, 1.0), ("y", 1, None)], "k string, h int, a double")
    b = spark.createDataFrame([("x", 1, 2.0), ("z", 2, 3.0)], "k string, h int, b double")
    got = weather.outer_tables([a, b], ["k", "h"])
    assert got.columns == ["k", "h", "a", "b"]
    assert sorted(map(tuple, got.collect())) == [("x", 1, 1.0, 2.0), ("y", 1, None, None), ("z", 2, None, 3.0)]
    twice = weather.outer_tables([a, b.union(b.where("k = 'z'"))], ["k", "h"])
    with pytest.raises(Exception, match="not unique on k=z, h=2"):
        twice.select("k").collect()  # also where no value is asked for


def test_segment_with_two_stations_of_a_table_is_an_error(spark):
    seen = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5), 1.0), (2, dt.datetime(2024, 1, 1, 5), 9.0)], "src_id int, meto_stmp_time timestamp_ntz, a double")
    links = spark.createDataFrame([("A", "2024", 1), ("A", "2024", 2)], "loc_id string, year string, src_id_TD int")
    assert weather.raw_weather({"TD": seen}, links.limit(1)).count() == 1
    with pytest.raises(Exception, match="not unique on ELR_MIL=A"):
        weather.raw_weather({"TD": seen}, links).collect()


def test_frame_checks_keys_without_a_shuffle(spark):
    keys = "ELR_MIL string, year int, month int, day int, hour int"
    rows = [("A", 2024, 1, 1, h) for h in range(3)]
    main = spark.createDataFrame(rows, keys)
    sky = spark.createDataFrame([(*r, 1.5) for r in rows], keys + ", t double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plans = [frame.modelling_frame(main, sky, sky.withColumnRenamed("t", "u"), check_unique=c)._jdf.queryExecution().executedPlan().toString() for c in (False, True)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].count("Exchange") == plans[1].count("Exchange")
    with pytest.raises(Exception, match="hour=1"):
        frame.modelling_frame(main.union(main.where("hour = 1")), sky, sky.withColumnRenamed("t", "u")).select("t").collect()


def test_formula_of_any_names(spark):
    rows = [(float(i), float(i % 3), i % 2, "u" if i % 2 else "v", i) for i in range(40)]
    df = spark.createDataFrame(rows, "`a-b` double, x0 double, `1 y` int, `k.l` string, y int")
    with pytest.raises(ValueError, match="a-b"):
        model.build_formula(df)
    made = model.apply_formula(df)
    assert made.columns == [*df.columns, "features", "label"]
    # The numbers, and one column for each of two levels but one (unknown values get one of their own).
    assert made.first()["features"].size >= 4
    assert {float(r["features"][0]) for r in made.collect()} >= set(map(float, range(40))) or any(
        len({float(r["features"][i]) for r in made.collect()}) == 40 for i in range(made.first()["features"].size)
    )


@pytest.mark.parametrize("zone", ["UTC", "Europe/London", "America/New_York"])
def test_stamps_with_offsets(spark, zone):
    stamps = {
        "2024-07-01 10:30": dt.datetime(2024, 7, 1, 10, 30),
        "2024-03-31 01:30:00": dt.datetime(2024, 3, 31, 1, 30),  # not there on a London clock
        "2024-07-01T10:30:00Z": dt.datetime(2024, 7, 1, 10, 30),
        "2024-07-01 10:30:00.25+01:00": dt.datetime(2024, 7, 1, 9, 30, 0, 250_000),
        "2024-01-01 00:30:00-0530": dt.datetime(2024, 1, 1, 6),
        "2024-01-01 00:30:00 +02": dt.datetime(2023, 12, 31, 22, 30),
        "1931-05-01 12:00:00+01:00": dt.datetime(1931, 5, 1, 11),
        "2024-07-01": dt.datetime(2024, 7, 1),
        "2024-13-01 00:00": None,
        "soon": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(s,) for s in stamps], "s string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r["s"]: r["t"] for r in df.select("s", utc_ntz(df["s"]).alias("t")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == stamps


def _batch(spark, rows):
    return spark.createDataFrame(rows, "ELR_MIL string, EVENT_DATETIME timestamp_ntz, INCIDENT_REASON string")


def test_counts_of_rows_a_year_late_without_state(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{n}" for n in ("source", "out", "state"))
    rng, first = random.Random(3), dt.datetime(2024, 6, 1)
    rows = [(rng.choice("AB"), first + dt.timedelta(days=-365 * rng.choice((0, 0, 1)), minutes=rng.randrange(300)), rng.choice(("R1", None))) for _ in range(60)]
    rows.append(("A", None, "R1"))
    schema = _batch(spark, rows).schema

    def run(folder):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = incidents.stream_incident_parts(stream, folder, state)
        query.awaitTermination()
        assert all(not p["stateOperators"] for p in query.recentProgress)

    for at in range(0, 30, 10):
        _batch(spark, rows[at : at + 10]).coalesce(1).write.mode("append").parquet(source)
    run(out)
    assert not Path(state, "state").exists()
    merged = incidents.merge_parts(spark, out, f"{tmp_path}/merged")
    _batch(spark, rows[30:]).coalesce(1).write.mode("append").parquet(source)
    run(merged)
    got = {(r["ELR_MIL"], r["ts"], r["INCIDENT_REASON"]): r["n"] for r in incidents.summed_counts(spark, merged).collect()}
    want = {}
    for segment, ts, reason in rows:
        if ts is not None:
            key = (segment, ts.replace(minute=0), reason)
            want[key] = want.get(key, 0) + 1
    assert got == want
