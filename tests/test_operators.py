from __future__ import annotations

import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from segment_hours.config import HOUR_KEYS, Flag, Rolling
from segment_hours.operators import basics, frame, incidents, model, schedule, spatial, spine, weather
from segment_hours.operators.slices import SLICE, carry, last_known, next_known, next_larger, sum_so_far

T0 = dt.datetime(2024, 1, 1)


def hours(n):
    return T0 + dt.timedelta(hours=n)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# ---- slices --------------------------------------------------------------------------------------


@pytest.mark.parametrize("width", [1, 2, 7, 1000])
def test_carries_do_not_depend_on_the_slice_width(spark, width):
    rng = random.Random(width)
    rows = []
    for key, n in (("hot", 60), ("cold", 3)):
        for at in sorted(rng.sample(range(200), n)):
            rows.append((key, at, rng.choice([None, rng.randint(1, 9)]), rng.randint(-3, 3)))
    df = spark.createDataFrame(rows, "k string, t long, v long, d long").withColumn(SLICE, F.expr(f"t div {width}"))
    got = carry(
        df,
        ["k"],
        ["t"],
        {
            "last": last_known(F.col("v"), ["t"]),
            "before": last_known(F.col("v"), ["t"], current=False),
            "next": next_known(F.col("v"), ["t"]),
            "later": next_larger("t"),
            "total": sum_so_far("d"),
        },
    ).select("k", "t", "last", "before", "next", "later", "total")
    wanted = []
    for key, at, _, _ in rows:
        mine = [r for r in rows if r[0] == key]
        known = [r for r in mine if r[2] is not None]
        wanted.append(
            (
                key,
                at,
                next((r[2] for r in reversed(known) if r[1] <= at), None),
                next((r[2] for r in reversed(known) if r[1] < at), None),
                next((r[2] for r in known if r[1] >= at), None),
                next((r[1] for r in mine if r[1] > at), None),
                sum(r[3] for r in mine if r[1] <= at),
            )
        )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)


# ---- weather -------------------------------------------------------------------------------------


def test_hourly_fill_carries_whole_rows(spark):
    rows = [
        (1, hours(0), 5.0, 1.0),
        (1, hours(0) + dt.timedelta(minutes=20), 6.0, None),
        (1, hours(3), 7.0, 2.0),
        (2, hours(5000), 1.0, 1.0),
        (2, None, 9.0, 9.0),
    ]
    df = spark.createDataFrame(rows, "src_id long, at timestamp_ntz, a double, b double")
    filled = weather.hourly_fill(df, "at", ["src_id"]).select("src_id", "at", "a", "b")
    assert sorted(map(tuple, filled.collect()), key=str) == [
        (1, hours(0), 6.0, None),
        (1, hours(1), 6.0, None),
        (1, hours(2), 6.0, None),
        (1, hours(3), 7.0, 2.0),
        (2, hours(5000), 1.0, 1.0),
    ]
    capped = weather.hourly_fill(df, "at", ["src_id"], max_gap_hours=1)
    assert capped.where("src_id = 1").count() == 3


def test_fill_across_slices(spark):
    df = spark.createDataFrame([(1, hours(0), 1.0), (1, hours(2500), 2.0)], "src_id long, at timestamp_ntz, a double")
    filled = weather.hourly_fill(df, "at", ["src_id"])
    assert filled.count() == 2501
    assert filled.where("a = 2").count() == 1


@pytest.mark.parametrize("collapse", [False, True])
def test_rolling_matches_brute_force_over_slice_borders(spark, collapse):
    rng = random.Random(7)
    times = sorted(rng.sample(range(300), 120))
    rows = [("A", i, hours(t), float(rng.randint(-5, 5))) for i, t in enumerate(times)]
    if collapse:
        rows += [("A", 1000 + i, hours(t), float(rng.randint(-5, 5))) for i, t in enumerate(times[::3])]
    df = spark.createDataFrame(rows, "ELR_MIL string, i long, ts timestamp_ntz, v double")
    rolling = [Rolling("v", "min", 5), Rolling("v", "max", 3), Rolling("v", "sum", 4), Rolling("v", "mean", 2)]
    flags = [Flag("low", "v", "le", 6, -4.0), Flag("high", "v", "ge", 1, 5.0)]
    got = {r["i"]: r for r in weather.rolling_features(df, rolling, flags, collapse=collapse).collect()}
    assert len(got) == len(rows)
    for _, i, ts, _ in rows:

        def near(span, ts=ts):
            return [v for _, _, t, v in rows if ts - dt.timedelta(hours=span) <= t <= ts]

        assert got[i]["v_min_5h"] == min(near(5)) and got[i]["v_max_3h"] == max(near(3))
        assert got[i]["v_sum_4h"] == sum(near(4))
        assert got[i]["v_mean_2h"] == pytest.approx(sum(near(2)) / len(near(2)))
        assert got[i]["flag_low"] == int(min(near(6)) <= -4) and got[i]["flag_high"] == int(max(near(1)) >= 5)


def test_weather_features_of_one_row(spark):
    raw = spark.createDataFrame(
        [("A", 2024, 1, 1, 0, 5.0, 8.0, 0.1, 0.0, "RA")],
        "ELR_MIL string, year int, month int, day int, hour int, min_air_temp double, max_air_temp double, "
        "prcp_amt double, snow_depth double, weather_code string",
    )
    row = weather.weather_features(raw).first().asDict()
    assert "min_air_temp" not in row and row["weather_code"] == "RA"
    assert row["min_air_temp_min_48h"] == 5.0 and row["flag_freeze"] == 0 and row["flag_heatwave"] == 0


def test_backfill_within_chunks(spark):
    rows = [("A", 0, hours(0), None), ("A", 0, hours(1), 1.0), ("A", 0, hours(2), None), ("A", 1, hours(3), 2.0)]
    df = spark.createDataFrame(rows, "ELR_MIL string, chunk int, ts timestamp_ntz, v double")
    by_time = [r["v"] for r in weather.backfill(df, ["v"]).orderBy("ts").collect()]
    assert by_time == [1.0, 1.0, 2.0, 2.0]
    chunked = [r["v"] for r in weather.backfill(df, ["v"], chunk="chunk").orderBy("ts").collect()]
    assert chunked == [1.0, 1.0, None, 2.0]


def test_outer_tables_equal_full_joins(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None)], "k int, a double")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "k int, b double")
    once = weather.outer_tables([a, b], ["k"]).select("k", "a", "b")
    joined = weather.outer_tables([a, b], ["k"], unique=False).select("k", "a", "b")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, joined.collect()))


# ---- schedule ------------------------------------------------------------------------------------


def test_run_days_step_by_weeks(spark):
    df = spark.createDataFrame(
        [("t", dt.date(2024, 1, 3), dt.date(2024, 1, 24), "1010000"), ("u", dt.date(2024, 1, 6), dt.date(2024, 1, 5), "1111111")],
        "train_id string, start_date date, end_date date, daysofweek string",
    )
    days = [r["run_date"].day for r in schedule.explode_run_days(df).orderBy("run_date").collect()]
    assert days == [3, 8, 10, 15, 17, 22, 24]  # Mondays and Wednesdays


def test_occupancy_matches_expansion(spark):
    rng = random.Random(3)
    trips = [("hot" if rng.random() < 0.8 else "cold", t, t + rng.randint(0, 30), rng.randint(1, 3)) for t in rng.choices(range(2000), k=80)]
    df = spark.createDataFrame(trips, "ELR_MIL string, first_hour long, last_hour long, n long")
    got = {(r["ELR_MIL"], r["run_hour"]): r["train_count"] for r in schedule.hourly_occupancy(df, weight="n").collect()}
    low, high = min(t[1] for t in trips), max(t[2] for t in trips)
    epoch = dt.datetime(1970, 1, 1)
    wanted = {
        (key, epoch + dt.timedelta(hours=h)): sum(n for k, a, b, n in trips if k == key and a <= h <= b)
        for key in ("hot", "cold")
        for h in range(low, high + 1)
    }
    assert got == wanted


def test_train_counts_of_a_timetable(spark):
    hops = spark.createDataFrame(
        [
            ("t1", "11", "0805", dt.date(2024, 1, 1), dt.date(2024, 1, 14), "1000000"),
            ("t1", "12", "0955", dt.date(2024, 1, 1), dt.date(2024, 1, 14), "1000000"),
            ("t2", "11", "0900", dt.date(2023, 12, 1), dt.date(2024, 3, 1), "1000000"),
            ("t3", "99", "0900", dt.date(2024, 1, 1), dt.date(2024, 1, 14), "1111111"),
        ],
        "train_id string, stanox_dep string, dep_time string, start_date date, end_date date, daysofweek string",
    )
    stations = spark.createDataFrame([("11", "X_0", 1), ("11", "A_0", 2), ("12", "A_0", 3)], "STANOX string, ELR_MIL string, pos int")
    counts = schedule.hourly_train_counts(hops, stations, dt.date(2024, 1, 1), dt.date(2024, 1, 10))
    busy = rows_of(counts.where("train_count > 0").select("ELR_MIL", "day", "hour", "train_count"))
    assert busy == [("A_0", 1, 8, 1), ("A_0", 1, 9, 2), ("A_0", 8, 8, 1), ("A_0", 8, 9, 2)]
    assert counts.count() == 7 * 24 + 2


# ---- incidents -----------------------------------------------------------------------------------


def incident_rows(spark):
    rows = [
        ("p1", "R1", hours(1), "1:9", 1),
        ("p1", "R1", hours(0), "2:9", 1),
        ("p1", "R2", hours(0), "1:9", 2),
        ("p1", None, hours(0), "1:9", 3),
        ("p2", "R1", hours(5), "x:9", 4),
        ("p2", "R1", hours(6), "1:9", 5),
    ]
    log = spark.createDataFrame(
        rows, "period string, INCIDENT_REASON string, EVENT_DATETIME timestamp_ntz, SECTION_CODE string, INCIDENT_NUMBER int"
    )
    places = spark.createDataFrame([(1, "A_0", 0), (2, "B_0", 1)], "STANOX long, ELR_MIL string, pos int")
    return log, places


def test_incident_counts_by_dedup_mode(spark):
    log, places = incident_rows(spark)

    def counted(**options):
        wide = incidents.incident_counts(log, places, **options)
        assert wide.columns == [*HOUR_KEYS, "INCIDENT_R1", "INCIDENT_R2"]
        return rows_of(wide.select("ELR_MIL", "hour", "INCIDENT_R1", "INCIDENT_R2"))

    # one event per reason and period; the one of the second period has no segment
    assert counted() == [("A_0", 0, 0, 1), ("B_0", 0, 1, 0)]
    assert counted(dedup=None) == [("A_0", 0, 0, 1), ("A_0", 1, 1, 0), ("A_0", 6, 1, 0), ("B_0", 0, 1, 0)]
    assert counted(dedup=("INCIDENT_NUMBER",)) == [("A_0", 0, 0, 1), ("A_0", 6, 1, 0), ("B_0", 0, 1, 0)]
    limited = incidents.incident_counts(log, places, dedup=None, codes=["R2", "R9"], start=hours(0), end=hours(0))
    assert limited.columns == [*HOUR_KEYS, "INCIDENT_R2", "INCIDENT_R9"]
    assert rows_of(limited.select("ELR_MIL", "INCIDENT_R2", "INCIDENT_R9")) == [("A_0", 1, 0), ("B_0", 0, 0)]
    with pytest.raises(ValueError):
        incidents.incident_counts(log, places, codes=[])


# ---- spatial -------------------------------------------------------------------------------------


def polyline_distance(p, line):
    best = math.inf
    pieces = list(zip(line, line[1:], strict=False)) or [(line[0], line[0])]
    for (x1, y1), (x2, y2) in pieces:
        length2 = (x2 - x1) ** 2 + (y2 - y1) ** 2
        a = 0 if length2 == 0 else max(0.0, min(1.0, ((p[0] - x1) * (x2 - x1) + (p[1] - y1) * (y2 - y1)) / length2))
        best = min(best, math.dist(p, (x1 + a * (x2 - x1), y1 + a * (y2 - y1))))
    return best


@pytest.mark.parametrize("scale", [20, 400, 4000])
def test_nearest_lines_match_brute_force(spark, scale):
    rng = random.Random(scale)
    lines = []
    for i in range(60):
        x, y = rng.uniform(-5000, 5000), rng.uniform(-5000, 5000)
        line = [(x, y)]
        for _ in range(rng.randint(0, 4)):
            step = rng.choice([(rng.uniform(-scale, scale), 0.0), (0.0, rng.uniform(-scale, scale)), (rng.uniform(-scale, scale), rng.uniform(-scale, scale))])
            line.append((line[-1][0] + step[0], line[-1][1] + step[1]))
        lines.append((f"L{i}", float(i), line))
    points = [(i, rng.gauss(0, 2500), rng.gauss(0, 2500)) for i in range(150)]
    points += [(1000 + i, *lines[i][2][0]) for i in range(20)]  # exactly on a vertex
    places = spark.createDataFrame(points, "STANOX long, EASTING double, NORTHING double")
    track = spark.createDataFrame(lines, "ELR string, START double, geometry array<struct<x: double, y: double>>")
    got = {(r["EASTING"], r["NORTHING"]): r for r in spatial.nearest_lines(places, track, "EASTING", "NORTHING", "geometry").collect()}
    for _, x, y in points:
        distance, name = min((polyline_distance((x, y), line), n) for n, _, line in lines)
        if distance > 1000:
            assert (x, y) not in got
        else:
            assert got[x, y]["ELR"] == name and got[x, y]["DIST_M"] == pytest.approx(distance, abs=1e-6)


def test_crowded_points_meet_few_lines(spark, monkeypatch):
    rng = random.Random(5)

    points = [(rng.uniform(0, 4000), rng.uniform(0, 4000)) for _ in range(4000)]
    points = spark.createDataFrame(points, "EASTING double, NORTHING double")
    lines = [(i, [(-20000.0, rng.uniform(0, 4000)), (24000.0, rng.uniform(0, 4000))]) for i in range(300)]
    lines = spark.createDataFrame(lines, "ELR long, geometry array<struct<x: double, y: double>>")
    seen, search = [], spatial._search

    def spy(spots, identity, passes, cells_of_points, cover, *rest):
        grids = [p if isinstance(p, tuple) else (p,) for p in passes]
        seen.extend(cells_of_points(spots, g[-1]).join(cover(*g), ["_i", "_j"] if len(g) > 1 else "_cell").count() for g in grids[:1])
        return search(spots, identity, passes, cells_of_points, cover, *rest)

    monkeypatch.setattr(spatial, "_search", spy)
    nearest = spatial.nearest_lines(points, lines, "EASTING", "NORTHING", "geometry")
    assert nearest.select("EASTING", "NORTHING").distinct().count() == 4000
    assert seen[0] < 4000 * 300 / 5


def test_ties_and_copies_of_a_line(spark):
    def track(*rows):
        return spark.createDataFrame(list(rows), "ELR string, START double, geometry array<struct<x: double, y: double>>")

    meet = (100.1, 0.3)
    lines = track(
        ("A", 3.0, [(0.0, 0.0), meet]),
        ("B", 9.5, [meet, (200.7, 0.9)]),
        ("B", 9.5, [meet, (200.7, 0.9)]),
        ("C", None, [(0.0, 900.0), (1.0, 900.0)]),
        (None, 1.0, [(5000.0, 0.0), (5001.0, 0.0)]),
    )
    places = spark.createDataFrame(
        [("s1", 100.1, 50.0), ("s2", 100.1, 50.0), ("far", 9000.0, 0.0), ("up", 0.0, 910.0), ("none", 5000.0, 1.0), ("x", None, 1.0)],
        "STANOX string, EASTING double, NORTHING double",
    )
    near = spark.createDataFrame([("v", 100.1, 0.3)], "STANOX string, EASTING double, NORTHING double")
    assert rows_of(spatial.link_locations(near, lines).select("ELR_MIL")) == [("A_0",), ("B_8",), ("B_8",)]
    got = rows_of(spatial.link_locations(places, lines, ties=False).select("STANOX", "ELR_MIL"))
    assert [r for r in got if r[0] == "up"] == [("up", "C_0")]
    assert {r[0] for r in got} == {"s1", "s2", "up"}


def test_nearest_station_far_and_near(spark):
    rng = random.Random(5)
    sites = [(i, 2024, rng.uniform(50, 58), rng.uniform(-6, 1)) for i in range(50)] + [(99, 2023, 51.0, 0.0), (98, 2023, 51.0, 0.0)]
    places = [(f"p{i}", rng.uniform(50, 58), rng.uniform(-6, 1)) for i in range(40)] + [("nz", -41.0, 174.0), ("us", 40.0, -100.0)]
    stations = spark.createDataFrame(sites, "src_id long, year int, lat double, lon double")
    df = spark.createDataFrame(places, "loc_id string, lat double, lon double")
    got = {(r["loc_id"], r["year"]): r for r in spatial.nearest_stations(df, stations, [2023, 2024]).collect()}
    assert len(got) == 2 * len(places)

    def km(a, b):
        la, lb = math.radians(a[0]), math.radians(b[0])
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(h))

    for name, lat, lon in places:
        distance, station = min((km((lat, lon), s[2:]), s[0]) for s in sites if s[1] == 2024)
        assert got[name, 2024]["src_id"] == station
        assert got[name, 2024]["distance_km"] == pytest.approx(distance, rel=1e-6)
        assert got[name, 2023]["src_id"] == 98  # the smaller id of the two at one place


def _pairs_with(spark, sites, places):
    rows = spatial._on_sphere(spark.createDataFrame([(i, 2024, *p) for i, p in enumerate(sites)], "src_id long, year int, lat double, lon double"))
    spots = spatial._on_sphere(spark.createDataFrame([(i, 2024, *p) for i, p in enumerate(places)], "loc_id long, year int, lat double, lon double"))
    nodes, leaves = spatial.station_index(rows)
    assert leaves.count() == len(sites)  # each station is in one leaf
    return spatial.nearby_leaves(spots, nodes, ["loc_id"]).join(leaves, ["year", "level", "cell"]).count()


@pytest.mark.parametrize("spread", [1e-3, 1.0, 20.0])
def test_far_and_dense_stations_make_few_pairs(spark, spread):
    """Places near, beside and on the far side of a dense cluster meet a few of its stations, not all."""
    rng = random.Random(7)
    sites = [(10 + rng.uniform(-spread, spread), 20 + rng.uniform(-spread, spread)) for _ in range(8_000)]
    places = [(rng.uniform(-60, 60), rng.uniform(-179, 179)) for _ in range(40)] + [(10.0, 20.0 + spread * f) for f in (0, 1, 1.1, 2, 5)]
    assert _pairs_with(spark, sites, places) < len(places) * 8_000 * 0.05
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "loc_id long, lat double, lon double")
    stations = spark.createDataFrame([(i, 2024, *p) for i, p in enumerate(sites)], "src_id long, year int, lat double, lon double")
    got = {r["loc_id"]: r for r in spatial.nearest_stations(df, stations, [2024]).collect()}
    for i, (lat, lon) in enumerate(places):
        chord = [math.dist(_unit(lat, lon), _unit(*s)) for s in sites]
        assert chord[got[i]["src_id"]] == pytest.approx(min(chord), rel=1e-9, abs=1e-15)


def _unit(lat, lon):
    lat, lon = math.radians(lat), math.radians(lon)
    return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)


def test_stations_at_one_point_and_none(spark):
    """Equal positions are one; positions closer than the finest cell still give the nearest."""
    sites = [(5, 2024, 1.0, 2.0), (3, 2024, 1.0, 2.0)] + [(10 + i, 2024, 1.0 + i * 1e-9, 2.0) for i in range(1, 60)]
    stations = spark.createDataFrame(sites, "src_id long, year int, lat double, lon double")
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 2.0, 2.0), ("c", None, 2.0), (None, 1.0, 2.0)], "loc_id string, lat double, lon double")
    got = {(r["loc_id"], r["year"]): r["src_id"] for r in spatial.nearest_stations(df, stations, [2023, 2024]).collect()}
    assert got == {("a", 2024): 3, ("b", 2024): 69}
    assert spatial.nearest_stations(df, stations.limit(0), [2024]).count() == 0


# ---- spine, frame and small steps ----------------------------------------------------------------


def test_spine_values(spark):
    segments = spark.createDataFrame([("A_0",), ("B_8",)], "ELR_MIL string")
    made = spine.hourly_spine(segments, "2023-12-31 22:00:00", "2024-01-01 01:00:00")
    assert made.count() == 8
    first = made.where("ELR_MIL = 'A_0' and hour = 22").first()
    assert (first["year"], first["month"], first["day"], first["day_of_week"]) == (2023, 12, 31, 0)  # a Sunday
    assert first["sin_hod"] == pytest.approx(math.sin(2 * math.pi * 22 / 24))
    assert first["cos_doy"] == pytest.approx(math.cos(2 * math.pi * 365 / 365.25))
    with pytest.raises(ValueError):
        spine.hourly_spine(segments, "2024-01-02", "2024-01-01")


def test_modelling_frame_fills_and_filters(spark):
    def table(rows, columns):
        return spark.createDataFrame(rows, f"ELR_MIL string, year int, month int, day int, hour int, {columns}")

    main = spine.hourly_spine(spark.createDataFrame([("A_0",), ("B_0",)], "ELR_MIL string"), hours(0), hours(30))
    sky = table([("A_0", 2024, 1, 1, 5, 2.5, "RA")], "rain double, code string")
    trains = table([("B_0", 2024, 1, 2, 1, 4)], "train_count long")
    wide = frame.modelling_frame(main, sky, trains)
    assert wide.count() == 62 and wide.where("rain > 0 and code = 'RA'").count() == 1
    assert wide.where("code = '0'").count() == 61 and wide.where("train_count = 4").count() == 1
    one = frame.modelling_frame(main, sky, trains, segment="B_0", time_filter={"day": [2]}, columns=["train_count"])
    assert one.columns == [*HOUR_KEYS, "train_count"] and one.count() == 7
    with pytest.raises(Exception, match="not unique"):
        frame.modelling_frame(main, sky.union(sky), trains).collect()
    assert frame.modelling_frame(main, sky.union(sky), trains, check_unique=False).count() > wide.count()


def test_small_steps(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (2.0, 3.0), (float("-inf"), 1.0), (None, 1.0)], "a double, b double")
    assert basics.finite_rows(df, ["a", "b"]).collect() == [(2.0, 3.0)]
    assert basics.swap_columns(df, "a", "b").columns == ["b", "a"] and basics.swap_columns(df, "a", "z").columns == ["a", "b"]
    with pytest.raises(ValueError):
        basics.rename_positional(df, ["x"])
    with pytest.raises(ValueError):
        basics.split_xy(df)
    with pytest.raises(KeyError):
        spatial.centroids(df)
    at = spark.createDataFrame([(hours(h),) for h in range(5)], "ts timestamp_ntz")
    assert basics.time_range(at, "ts", hours(1), hours(3)).count() == 3
    assert basics.time_range(at, "ts", hours(2), hours(2), buffer=dt.timedelta(hours=1)).count() == 3
    dated = at.select("ts", F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"), F.hour("ts").alias("hour"))
    assert basics.stored_time_range(dated, hours(1), hours(3)).count() == 3


def test_dates_are_made_once_a_day_and_keys_sorted_by_a_number(spark):
    """Date columns stand below the unfolding of hours, and the joins of the frame sort a hash of the keys first."""
    hours = spine.hourly_spine(spark.createDataFrame([("A",), ("B",)], "ELR_MIL string"), "2024-02-28", "2024-03-01 23:00")
    text = hours._jdf.queryExecution().executedPlan().toString()
    assert text.index("Generate explode(sequence(greatest") < text.index("dayofyear")
    assert hours.where("year = 2024 and month = 2 and day = 29").count() == 48
    table = hours.select(*HOUR_KEYS, F.lit(1).alias("n"))
    wide = frame.modelling_frame(hours, table.hint("merge"), table.withColumnRenamed("n", "m").hint("merge"))
    assert "Sort [_key" in wide._jdf.queryExecution().executedPlan().toString()
    assert "_key" not in wide.columns and wide.where("n = 1 and m = 1").count() == wide.count() == 144


def test_split_of_the_frame_by_predictors_alone(spark):
    """Dates of the unfolded hours stay where a filter needs them, though no predictor does."""
    grid = spine.hourly_spine(spark.createDataFrame([("A",), ("B",)], "ELR_MIL string"), "2024-02-28", "2024-03-01 23:00")
    sky = grid.select(*HOUR_KEYS, (F.col("day") * 100 + F.col("hour")).cast("double").alias("t"))
    wide = frame.modelling_frame(grid, sky, sky.withColumnRenamed("t", "INCIDENT_A")).drop("day_of_week")
    rows, _, columns, names = model.design(wide, keys=tuple(HOUR_KEYS))
    kept = model.hash_split(rows, HOUR_KEYS).where("part != 0")
    seen = kept.agg(*[f(c).alias(f"{f.__name__}_{n}") for c, n in zip(columns, names, strict=True) for f in (F.count, F.sum)]).first()
    keys = [(s, 2024, m, d, h) for s in "AB" for m, d in ((2, 28), (2, 29), (3, 1)) for h in range(24)]
    own = [k for k in keys if int(hashlib.md5("|".join(map(str, k)).encode()).hexdigest()[:8], 16) % 5]
    assert {seen[f"count_{n}"] for n in names} == {len(own)}
    assert seen["sum_t"] == sum(k[3] * 100 + k[4] for k in own)
    assert seen["sum_sin_doy"] == pytest.approx(sum(math.sin(2 * math.pi * (dt.date(*k[1:4]).timetuple().tm_yday) / 365.25) for k in own))
