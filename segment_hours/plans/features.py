"""End-to-end pipelines: raw feeds to reference tables, feature tables and the modelling frame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from segment_hours.config import HOUR_KEYS, MONTH_KEYS, WEATHER_FLAGS, WEATHER_ROLLING
from segment_hours.functions.text import hhmm
from segment_hours.functions.time import as_range, ntz, period_calendar, timetable_seasons, utc_ntz, yymmdd
from segment_hours.operators.basics import segments, time_range, valid_locations
from segment_hours.operators.frame import modelling_frame
from segment_hours.operators.incidents import incident_counts
from segment_hours.operators.schedule import hourly_train_counts, schedule_hops
from segment_hours.operators.spatial import centroids_wgs84, link_locations, nearest_stations
from segment_hours.operators.spine import hourly_spine
from segment_hours.operators.weather import raw_weather, weather_features
from segment_hours.session import cut_lineage
from segment_hours.sources.archives import read_delay_archives, unread
from segment_hours.sources.feeds import (
    combine_station_maps,
    delays_of_archives,
    read_locations,
    read_timetable_lines,
)
from segment_hours.sources.tables import (
    read_period_files,
    read_year_tables,
    write_partitioned,
    write_window,
)
from segment_hours.sources.versions import scan_versions


def build_segment_map(spark, locations_path, track, **options):
    """Segment map of location records and track lines."""
    return link_locations(valid_locations(read_locations(spark, locations_path)), track, **options)


def build_station_map(segment_map, stations, years):
    """Nearest station of each weather table to each segment's centroid: loc_id, year, src_id_<table>.

    ``stations`` maps a table to its stations (src_id, year, lat, lon).
    """
    places = centroids_wgs84(segment_map).toDF("loc_id", "lat", "lon")
    maps = []
    for name, sites in stations.items():
        nearest = nearest_stations(places, sites, years)
        station = F.col("src_id").alias(f"src_id_{name}")
        maps.append(nearest.select("loc_id", F.col("year").cast("string").alias("year"), station))
    return combine_station_maps(maps)


def build_hops(spark, root, start=None, end=None, **options):
    """Hop table of the timetable archives, of the seasons a window touches if one is given."""
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    seasons = timetable_seasons(start, end) if start is not None else None
    # unpacked once: the lines are read several times below, and an archive is slow to read again
    lines = cut_lineage(read_timetable_lines(spark, root, seasons=seasons), "timetable")
    return schedule_hops(lines, **options)


def build_delays(spark, root, out, periods=None, unread_path=None, **options):
    """Writes the archived delay logs as a table partitioned by season and period.

    ``periods`` (season, period) opens the listed ones only; they are fetched, 13 a year. ``unread_path`` gets a table of the archives and members
    that could not be read. Options are those of ``read_delay_archives``.
    """
    if periods is not None:
        options["periods"] = [tuple(r) for r in periods.select("season", "period").dropna().distinct().collect()]
    raw = read_delay_archives(spark, root, **options)
    if unread_path is not None:
        raw = cut_lineage(raw, "delays")  # unpacked once for both tables
        unread(raw).write.mode("overwrite").parquet(unread_path)
    table = delays_of_archives(raw)
    write_partitioned(table, out, ["season", "period"])
    return spark.read.schema(table.schema).parquet(out)


def build_weather(
    spark, root, station_map, tables, start, end, form="csv", rolling=WEATHER_ROLLING, flags=WEATHER_FLAGS
):
    """Weather features for [start, end] from year files: {table: schema}.

    Reads back as far as the widest frame and a day more, for the observation before the first hour.
    """
    start, end = as_range(start, end)
    widest = max(s.hours for s in [*rolling, *flags])
    first = start - dt.timedelta(hours=widest)
    day = dt.timedelta(days=1)
    loaded = {}
    for name, schema in tables.items():
        table = read_year_tables(spark, root, name, form, schema, years=((first - day).year, (end + day).year))
        typed = table.withColumn("meto_stmp_time", utc_ntz(F.col("meto_stmp_time")))
        loaded[name] = time_range(typed.drop("file_year"), "meto_stmp_time", first, end, buffer=day)
    raw = raw_weather(loaded, station_map, bounds=(ntz(first), ntz(end)))
    return weather_features(raw, rolling, flags, bounds=(ntz(start), ntz(end)))


def typed_hops(hops):
    """Text hops with dates and padded times, also where leading zeros were lost on the way."""
    return hops.withColumns(
        {"start_date": yymmdd(F.col("start_date")), "end_date": yymmdd(F.col("end_date")), "dep_time": hhmm(F.col("dep_time"))}
    )


def build_incidents(spark, root, segment_map, start, end, form="csv", schema=None, **options):
    """Incident counts of the period files that meet the window."""
    log = read_period_files(spark, root, form, schema, period_calendar(spark, start, end))
    log = log.withColumn("EVENT_DATETIME", F.col("EVENT_DATETIME").cast("timestamp_ntz"))
    log = log.withColumn("period", F.concat_ws("_", "season", "period"))
    return incident_counts(log, segment_map, start=start, end=end, **options)


def create_datasets(spark, out, segment_map, hops, incidents, weather, start, end, keys=tuple(MONTH_KEYS)):
    """Writes the hours ``start`` to ``end`` of all four feature tables under ``out``; running it again replaces them.

    Windows may share a partition: stored hours outside the window stay.

    ``keys`` is the folder layout. Rows of a partition are sorted by the remaining hour keys, segment
    first, so that a scan of one segment skips row groups where the segment is not a folder.
    """
    start, end = as_range(start, end)
    spine = hourly_spine(segments(segment_map), start, end)
    trains = hourly_train_counts(typed_hops(hops), segment_map, start.date(), end.date())
    rest = [k for k in HOUR_KEYS if k not in keys]
    for name, table in {"main": spine, "weather": weather, "timetable": trains, "incidents": incidents}.items():
        write_window(table, f"{out}/{name}", start, end, keys, sort=rest)


def build_modelling_frame(spark, root, **options):
    """Modelling frame of the tables written by :func:`create_datasets`; of one segment or some dates only their files are listed."""
    wanted = {k: options.get(k) for k in ("segment", "time_filter")}
    tables = [scan_versions(spark, f"{root}/{name}", **wanted) for name in ("main", "weather", "timetable", "incidents")]
    return modelling_frame(*tables, **options)
