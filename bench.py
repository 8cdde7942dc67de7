"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` set the tables and the cores. ``--duckdb`` adds the time of the
reference SQL per query, ``--all`` runs every query, further arguments name queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from segment_hours.plans.oracles import ORACLES
from segment_hours.plans.queries import QUERIES
from segment_hours.session import build_session

HEADLINE = [
    "hourly_spine",
    "asof_hourly_fill",
    "weather_raw",
    "weather_features",
    "rolling_range_features",
    "rolling_rows",
    "backfill",
    "dedup_last",
    "dedup_first",
    "incident_pivot",
    "incident_dataset",
    "collapse_schedule",
    "explode_day_mask",
    "schedule_hops",
    "timetable_lines_to_hops",
    "hourly_train_count",
    "hourly_occupancy",
    "map_lookup_last_wins",
    "nearest_segment",
    "nearest_station",
    "osgb_to_wgs84",
    "profile_columns",
    "modelling_frame",
]


def spark_seconds(spark, name, sf):
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def duckdb_seconds(name, sf, cpus):
    import duckdb

    con = duckdb.connect(config={"threads": cpus})
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    start = time.perf_counter()
    con.execute(f"CREATE TEMP TABLE answer AS {ORACLES[name]}")
    return time.perf_counter() - start


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    options = [a for a in sys.argv[1:] if a.startswith("--")]
    names = [a for a in sys.argv[1:] if not a.startswith("--")]
    names = names or (list(QUERIES) if "--all" in options else HEADLINE)
    spark = build_session(
        "segment-hours-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark_seconds(spark, "time_bounds", sf)  # starts the executors and loads the classes of a scan
    times = {name: round(spark_seconds(spark, name, sf), 3) for name in names}
    line = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(Path(sf).name.removeprefix("sf") or 0),
    }
    if "--duckdb" in options:
        line["duckdb"] = {n: round(duckdb_seconds(n, sf, cpus), 3) for n in names if n in ORACLES}
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
