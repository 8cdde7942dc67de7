"""One query per operator over the given tables: ``QUERIES[name](spark, sf_dir)`` returns a DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from segment_hours.config import DATE_KEYS, HOUR_KEYS, PARTITION_KEYS, SEGMENT, WEATHER_FLAGS, WEATHER_ROLLING, Rolling
from segment_hours.functions import geo, text, time
from segment_hours.operators import basics, boosting, frame, incidents, levels, model, schedule, spatial, spine, weather
from segment_hours.operators.slices import SLICE, carry, in_order
from segment_hours.plans import fixtures as fx
from segment_hours.session import cut_lineage, scratch_path
from segment_hours.sources import feeds, tables
from segment_hours.streaming import incidents as streaming

QUERIES = {}

_MIDDLE = ("2024-01-08 06:00:00", "2024-01-20 18:30:00")
_PERIODS = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
REASONS = [f"R{i}" for i in range(7)]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df, digits=4, columns=None):
    """Doubles rounded, since sums depend on the order of addition."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in names}) if names else df


def _event_hours(spark, sf):
    """First and last hour of all events; any equal pair where there are none, as then there are no segments either."""
    bounds = fx.table(spark, sf, "events").agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    low, high = bounds.select(time.hour_floor(F.col("low")), time.hour_floor(F.col("high"))).first()
    none = dt.datetime(1970, 1, 1)
    return low or none, high or none


def _dates_as_text(df):
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


def _publish(spark, df, root, key, name):
    """Writes ``df`` once, split by ``key``, and names each folder ``name(value)``."""
    df.write.partitionBy(key).format("csv").option("header", True).save(root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = path(root)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        part = entry.getPath().getName()
        if part.startswith(f"{key}="):
            files.rename(entry.getPath(), path(f"{root}/{name(part.split('=', 1)[1])}"))


# ---- sources and sinks ---------------------------------------------------------------------------


@query
def scan_formats(spark, sf):
    customers = fx.table(spark, sf, "customer")
    root = scratch_path(spark, "formats")
    read = []
    for name in ("customer.csv.gz", "customer.json", "customer.parquet"):
        tables.write_table(customers, f"{root}/{name}")
        back = tables.read_table(spark, f"{root}/{name}", customers.schema)
        read.append(back.withColumn("fmt", F.lit(tables.table_format(name))))
    return basics.union_tables(read)


@query
def scan_partitioned(spark, sf):
    rows = time.with_date_parts(fx.table(spark, sf, "events"), "ts").withColumnRenamed("event_type", SEGMENT)
    root = scratch_path(spark, "evolving")
    for column in ("value", "user_id"):
        tables.append_rows(rows.select("event_id", column, *HOUR_KEYS), root, PARTITION_KEYS)
    return tables.scan_partitioned(spark, root).select("event_id", "value", "user_id", *PARTITION_KEYS)


@query
def scan_pruned(spark, sf):
    rows = time.with_date_parts(fx.table(spark, sf, "events"), "ts").withColumnRenamed("event_type", SEGMENT)
    root = scratch_path(spark, "pruned")
    tables.append_rows(rows.select("event_id", "value", *HOUR_KEYS), root, PARTITION_KEYS)
    found = tables.scan_segment(spark, root, "view", {"month": 1, "day": [3, 9, 17, 26]})
    return found.select("event_id", "value", *HOUR_KEYS)


@query
def write_partitioned(spark, sf):
    rows = time.with_date_parts(fx.table(spark, sf, "events"), "ts").withColumnRenamed("event_type", SEGMENT)
    rows = rows.select("event_id", "value", *HOUR_KEYS)
    root = scratch_path(spark, "written")
    for _ in range(2):  # the second run replaces the partitions of the first
        tables.write_partitioned(rows, root, PARTITION_KEYS, sort=["hour"])
    return spark.read.parquet(root).select("event_id", "value", *HOUR_KEYS)


@query
def scan_year_tables(spark, sf):
    orders = fx.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("prcp_amt"), "o_orderdate"
    )
    root = scratch_path(spark, "years")
    _publish(
        spark, orders.withColumn("y", F.year("o_orderdate")).drop("o_orderdate"), root, "y", "RH_{}.csv".format
    )
    schema = "o_orderkey bigint, prcp_amt double"
    return tables.read_year_tables(spark, root, "RH", "csv", schema, years=(1996, 1999))


@query
def scan_period_files(spark, sf):
    code = time.business_period(F.col("o_orderdate"))
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", code.alias("code"))
    root = scratch_path(spark, "periods")
    _publish(spark, orders, root, "code", "delay_{}.csv".format)
    calendar = time.period_calendar(spark, "1996-04-10", "1999-06-30")
    return tables.read_period_files(spark, root, "csv", "o_orderkey bigint, o_totalprice double", calendar)


@query
def normalise_delay_csv(spark, sf):
    log = fx.incident_log(spark, sf)
    stamp = F.upper(F.date_format("EVENT_DATETIME", "dd-MMM-yyyy HH:mm"))
    given = {
        "INCIDENT_NUMBER": F.col("INCIDENT_NUMBER"),
        "SECTION_CODE": F.col("SECTION_CODE"),
        "INCIDENT_REASON": F.col("INCIDENT_REASON"),
        "INCIDENT_START_DATETIME": stamp,
        "PLANNED_ORIGIN_WTT_DATETIME": F.when(F.col("event_id") % 11 != 0, stamp),
        "EVENT_DATETIME": stamp,
        "EVENT_TYPE": F.split_part("SECTION_CODE", F.lit(":"), F.lit(2)),
        "PFPI_MINUTES": F.col("PFPI_MINUTES"),
    }
    # the log as delivered: lower-case headers, one column more, two columns in the other order
    names = ["REACT_TRAIN", *[c for c in feeds.DELAY_COLUMNS if c != "INCIDENT_RESP_TRAIN"], "SPARE"]
    renamed = {
        "PLANNED_ORIGIN_WTT_DATETIME": "PLANNED_ORIG_WTT_DATETIME_AFF",
        "PLANNED_ORIGIN_GBTT_DATETIME": "PLANNED_ORIG_GBTT_DATETIME_AFF",
    }
    cells = [given.get(c, F.lit(c)).cast("string").alias(renamed.get(c, c).lower()) for c in names]
    at = {c: i for i, c in enumerate(names)}
    first, second = at["PLANNED_ORIGIN_WTT_DATETIME"], at["PLANNED_ORIGIN_GBTT_DATETIME"]
    cells[first], cells[second] = cells[second], cells[first]
    path = f"{scratch_path(spark, 'delays')}/delay.csv.gz"
    tables.write_table(log.select(*cells), path)
    layout = [c for c in feeds.DELAY_COLUMNS if c != "INCIDENT_RESP_TRAIN"] + ["SPARE"]
    return feeds.normalise_delays(tables.read_table(spark, path), layout)


@query
def parse_tab_records(spark, sf):
    documents = fx.table(spark, sf, "documents")
    name = F.regexp_replace("text", r"[\t\r\n]+", " ")
    kind = F.when(F.col("lang") == "en", "REF").otherwise("LOC")
    fields = [kind, F.lit("A"), F.concat(F.lit("T"), "doc_id"), name, F.lit(""), F.lit(""), F.col("n_chars"), F.col("doc_id")]
    lines = documents.select(F.concat_ws("\t", *fields).alias("value"))
    root = scratch_path(spark, "locations")
    lines.write.option("compression", "gzip").text(root)
    records = feeds.read_locations(spark, root)
    return records.select(
        "TIPLOC", F.md5("LOC_NAME").alias("name_md5"), F.length("LOC_NAME").alias("name_length"), "EASTING", "NORTHING", "STANOX"
    )


@query
def flatten_json_array(spark, sf):
    """One JSON document per 64 customers, each with an array of records, a document per line."""
    record = F.struct("c_custkey", "c_name", "c_nationkey")
    customers = fx.table(spark, sf, "customer").groupBy(F.floor(F.col("c_custkey") / 64).alias("part"))
    document = F.to_json(F.struct(F.collect_list(record).alias("TIPLOCDATA"))).alias("value")
    root = scratch_path(spark, "corpus")
    customers.agg(document).select("value").write.text(root)
    entry = T.StructType.fromDDL("c_custkey bigint, c_name string, c_nationkey int")
    return feeds.read_json_records(spark, root, feeds.corpus_schema(entry), "TIPLOCDATA", multi_line=False)


# ---- projections and filters ---------------------------------------------------------------------


@query
def rename_positional(spark, sf):
    items = fx.table(spark, sf, "lineitem")
    renamed = basics.rename_positional(items, [f"C{i:02d}" for i in range(len(items.columns))])
    return basics.swap_columns(renamed, "C04", "C05")


@query
def filter_valid_points(spark, sf):
    number = F.round("EASTING").cast("bigint").cast("string")
    easting = (
        F.when(F.col("label") == 1, "999999").when(F.col("label") == 2, "0").when(F.col("label") == 3, "n/a").otherwise(number)
    )
    code = F.when(F.col("label") == 0, "  ").otherwise(F.col("label").cast("string"))
    raw = fx.points(spark, sf).select(
        "vec_id", code.alias("STANOX"), easting.alias("EASTING"), F.round("NORTHING").cast("bigint").alias("NORTHING")
    )
    return basics.valid_locations(raw)


@query
def filter_time_range(spark, sf):
    return basics.time_range(fx.table(spark, sf, "events"), "ts", *_MIDDLE).select("event_id", "ts")


@query
def filter_interval_overlap(spark, sf):
    low, high = F.lit(dt.date(1997, 3, 1)), F.lit(dt.date(1998, 2, 28))
    return _dates_as_text(basics.overlapping(fx.validity(spark, sf), "start_date", "end_date", low, high))


@query
def clamp_interval(spark, sf):
    low, high = F.lit(dt.date(1997, 3, 1)), F.lit(dt.date(1998, 2, 28))
    rows = basics.overlapping(fx.validity(spark, sf), "start_date", "end_date", low, high)
    return _dates_as_text(basics.clamp_interval(rows, "start_date", "end_date", low, high))


@query
def filter_finite(spark, sf):
    ratio = F.when(F.col("l_tax") == 0, F.lit(float("inf"))).otherwise(F.try_divide("l_extendedprice", "l_tax"))
    share = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.try_divide("l_quantity", "l_discount"))
    rows = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", ratio.alias("ratio"), share.alias("share")
    )
    return _rounded(basics.finite_rows(rows, ["ratio", "share"]))


@query
def split_xy(spark, sf):
    wide = incident_pivot(spark, sf)
    _, targets = basics.split_xy(wide, keys=HOUR_KEYS)
    return targets


# ---- joins ---------------------------------------------------------------------------------------


def _station_hours(spark, sf):
    """Hours of the stations of all tables, each with the last value at or before it."""
    return weather.hourly_fill(fx.all_observations(spark, sf).drop("event_type"), "meto_stmp_time", ["_table", "src_id"])


@query
def join_station_fanout(spark, sf):
    links = weather.station_links(fx.station_map(spark, sf), ["TD", "RH", "WH", "WM"]).withColumn("station_table", F.col("_table"))
    return _rounded(weather.to_segments(_station_hours(spark, sf), links, "meto_stmp_time", ["_table", "src_id"]))


@query
def join_outer_tables(spark, sf):
    hours = time.with_date_parts(fx.events(spark, sf), "ts").withColumn("segment", F.floor(F.col("user_id") / 8))
    keys = ["segment", *DATE_KEYS]
    sides = [
        hours.where(F.col("event_type") == kind).groupBy(*keys).agg(F.max("value").alias(kind))
        for kind in ("view", "click", "purchase", "signup", "error")
    ]
    return weather.outer_tables(sides, keys)


@query
def map_lookup_last_wins(spark, sf):
    items = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (F.col("l_suppkey") % 40).alias("code")
    )
    # several suppliers share a code (the highest key wins) and some codes are unknown
    known = fx.supplier_segments(spark, sf).withColumn("STANOX", F.col("STANOX") % 37)
    return basics.lookup_last_wins(items, "code", known, "STANOX", SEGMENT, "pos")


@query
def nearest_segment(spark, sf):
    places = fx.points(spark, sf).withColumnRenamed("vec_id", "STANOX")
    return _rounded(spatial.link_locations(places, fx.track_lines(spark, sf)))


@query
def nearest_station(spark, sf):
    places = fx.degrees(spark, sf, 8).withColumnRenamed("vec_id", "loc_id")
    sites = fx.degrees(spark, sf, 12).withColumnRenamed("vec_id", "src_id").withColumn(
        "year", F.lit(2023) + (F.col("src_id") % 2).cast("int")
    )
    return _rounded(spatial.nearest_stations(places, sites, [2023, 2024]), 3)


@query
def hourly_spine(spark, sf):
    segments = basics.segments(fx.event_segments(spark, sf))
    return _rounded(spine.hourly_spine(segments, *_event_hours(spark, sf)), 6)


@query
def asof_hourly_fill(spark, sf):
    return _rounded(_station_hours(spark, sf).withColumnRenamed("_table", "station_table"))


@query
def missing_partitions(spark, sf):
    """Business periods without an order, per customer bucket: 1995 to 2001, and on to the first and last order where they lie outside."""
    table = fx.table(spark, sf, "orders")
    low, high = table.agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    low, high = min(low or _PERIODS[0], _PERIODS[0]), max(high or _PERIODS[1], _PERIODS[1])
    orders = table.select(
        F.floor(F.col("o_custkey") / 16).alias("bucket"), time.business_period(F.col("o_orderdate")).alias("code")
    )
    existing = orders.distinct()
    periods = time.period_calendar(spark, low, high).select("code")
    codes = [row["code"] for row in periods.collect()]  # 14 a year
    required = existing.select("bucket").distinct().select(
        "bucket", F.explode(F.array(*[F.lit(c) for c in codes])).alias("code")
    )
    return basics.missing_partitions(required, existing, ["bucket", "code"])


@query
def business_period_of(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", time.business_period(F.col("o_orderdate")).alias("code"))


# ---- aggregation and de-duplication --------------------------------------------------------------


@query
def segment_centroid(spark, sf):
    located = fx.points(spark, sf).withColumn(SEGMENT, F.concat(F.lit("L"), "label"))
    return _rounded(spatial.centroids(located))


@query
def osgb_to_wgs84(spark, sf):
    """Embedding points placed in the middle of the national grid."""
    placed = fx.points(spark, sf).select(
        "vec_id", (F.lit(400000) + F.col("EASTING") * 3).alias("E"), (F.lit(500000) + F.col("NORTHING") * 8).alias("N")
    )
    return _rounded(geo.osgb_to_wgs84(placed, "E", "N").select("vec_id", "Latitude", "Longitude"), 6)


@query
def collapse_schedule(spark, sf):
    stops = fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("train_id"),
        text.segment_id(F.lit("S"), F.col("l_suppkey")).alias(SEGMENT),
        text.minutes_hhmm(fx.dep_minute()).alias("dep_time"),
    )
    collapsed = schedule.collapse_schedule(stops, ["train_id", SEGMENT])
    times = [text.minutes_hhmm(F.col(f"{c}_minute")).alias(f"{c}_time") for c in ("dep", "arr")]
    return collapsed.select("train_id", SEGMENT, *times)


@query
def incident_pivot(spark, sf):
    log = time.with_date_parts(fx.incident_log(spark, sf), "EVENT_DATETIME")
    return incidents.incident_pivot(log, REASONS)


@query
def distinct_codes(spark, sf):
    return basics.distinct_codes(fx.incident_log(spark, sf), "INCIDENT_REASON")


@query
def time_bounds(spark, sf):
    stored = time.with_date_parts(fx.table(spark, sf, "events"), "ts").select(*DATE_KEYS)
    return basics.time_bounds(stored)


@query
def dedup_last(spark, sf):
    rows = fx.table(spark, sf, "events").select((F.col("user_id") % 15).alias("src_id"), "ts", "event_id", "value")
    last = weather.dedup_last(rows, ["src_id"], "ts")
    return last.select("src_id", time.index_hour(F.col("_hour")).alias("hour_ts"), "event_id", "value")


@query
def dedup_first(spark, sf):
    log = fx.incident_log(spark, sf).withColumn("period", time.business_period(F.col("EVENT_DATETIME")))
    first = incidents.dedup_first(log, ["period", "INCIDENT_REASON"], "EVENT_DATETIME")
    return first.select("period", "INCIDENT_REASON", "EVENT_DATETIME", SEGMENT, "event_id")


@query
def hourly_train_count(spark, sf):
    counts = schedule.hourly_train_counts(fx.hop_rows(spark, sf), fx.nation_segments(spark, sf))
    return counts.select(SEGMENT, "run_hour", "train_count")


@query
def hourly_occupancy(spark, sf):
    return schedule.hourly_occupancy(fx.trips(spark, sf)).select(*HOUR_KEYS, "train_count")


@query
def profile_columns(spark, sf):
    return model.profile_table(fx.table(spark, sf, "lineitem"), force_numeric=())


@query
def label_totals(spark, sf):
    wide = incident_pivot(spark, sf)
    return model.label_totals(wide, [c for c in wide.columns if c.startswith("INCIDENT_")])


# ---- windows -------------------------------------------------------------------------------------


@query
def rolling_range_features(spark, sf):
    mean = Rolling("prcp_amt", "mean", 12)
    return _rounded(weather.rolling_features(fx.hourly_events(spark, sf), [*WEATHER_ROLLING, mean], []), 8)


@query
def rolling_rows(spark, sf):
    """Rolling features of the event rows themselves, several of which may share an hour."""
    rows = fx.events(spark, sf).select(SEGMENT, "event_id", time.hour_floor(F.col("ts")).alias("ts"), "value")
    wanted = [Rolling("value", action, 24) for action in ("min", "max", "sum", "mean")]
    return _rounded(weather.rolling_features(rows, wanted, [], collapse=True), 8)


@query
def rolling_flags(spark, sf):
    return weather.rolling_features(fx.hourly_events(spark, sf), [], WEATHER_FLAGS)


@query
def backfill(spark, sf):
    hours = fx.hourly_events(spark, sf)
    gaps = hours.select(SEGMENT, "ts", F.when(F.col("prcp_amt") > 60, F.col("prcp_amt")).alias("prcp_amt"))
    return _rounded(weather.backfill(gaps, ["prcp_amt"]))


@query
def schedule_hops(spark, sf):
    """Line items as stops of a train; some have no departure, some no arrival."""
    minute = fx.dep_minute()
    header = F.struct(
        F.col("l_orderkey").cast("string").alias("train_id"),
        F.lit("").alias("train_service_id"),
        fx.day_mask(F.col("l_orderkey")).alias("daysofweek"),
        F.lit("").alias("start_date"),
        F.lit("").alias("end_date"),
    )
    # monotone in the stop order, so that no train is bound to one task
    place = F.col("l_linenumber").cast("bigint") * 1_000_000_000 + F.floor(F.col("l_partkey") / 50_000)
    stops = fx.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        place.alias(SLICE),
        header.alias("header"),
        F.col("l_suppkey").cast("string").alias("stanox"),
        F.when(F.col("l_linestatus") == "F", text.minutes_hhmm((minute + 1435) % 1440)).alias("arr"),
        F.when(F.col("l_returnflag") != "N", text.minutes_hhmm(minute)).alias("dep"),
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    placed = carry(stops, ["l_orderkey"], order, {"_before": schedule.stop_before(order)})
    return schedule.hops_of_stops(placed).select("train_id", "stanox_dep", "stanox_arr", "daysofweek", "dep_time")


# Widths of the train, place and station fields of the timetable text below.
_TRAIN, _PLACE, _STATION = 6, 6, 5


@query
def timetable_lines_to_hops(spark, sf):
    """Fixed-width timetable text of all orders and line items, parsed back to hops; their codes become keys again."""
    hops = schedule.schedule_hops(_timetable_lines(spark, sf))
    train = text.code_number(F.col("train_id"), _TRAIN)
    stations = [text.code_number(F.col(f"stanox_{c}"), _STATION).cast("string").alias(f"stanox_{c}") for c in ("dep", "arr")]
    return hops.select(
        F.lpad(train.cast("string"), F.greatest(F.lit(_TRAIN), F.length(train.cast("string"))), F.lit("0")).alias("train_id"),
        *stations,
        "daysofweek",
        "dep_time",
        "start_date",
        "end_date",
    )


def _timetable_lines(spark, sf):
    """Places, then schedules in order, each with its stops by their whole keys. Keys are sorted, text is built behind the shuffle."""

    def entries(df, schedule, line, part, supplier, *more):
        keys = {"schedule": schedule, "l_linenumber": line, "l_partkey": part, "supplier": supplier}
        return df.select(*[c.cast("bigint").alias(n) for n, c in keys.items()], *more)

    none = F.lit(0)
    order = ["schedule", "l_linenumber", "l_partkey", "supplier"]
    places = entries(fx.table(spark, sf, "supplier"), F.lit(-1), none, none, F.col("s_suppkey"))
    heads = entries(fx.validity(spark, sf), F.col("o_orderkey"), none, none, none, "start_date", "end_date", "daysofweek")
    calls = entries(
        fx.table(spark, sf, "lineitem"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    )
    rows = heads.unionByName(places, allowMissingColumns=True).unionByName(calls, allowMissingColumns=True)

    supplier, stop, minute = F.col("supplier"), F.col("l_linenumber"), fx.dep_minute()
    code = F.when(supplier % 10 == 0, 0).otherwise(supplier + 10000)
    place = F.concat(F.lit("T"), text.fixed_code(supplier, _PLACE))
    insert = F.concat(F.lit("TI"), place, F.lit(" " * 35), text.fixed_code(code, _STATION))
    head = F.concat(
        F.lit("BSN"),
        text.fixed_code(F.col("schedule"), _TRAIN),
        F.date_format("start_date", "yyMMdd"),
        F.date_format("end_date", "yyMMdd"),
        "daysofweek",
        F.lit(" " * 13),
        F.lit("SERVICE1"),
    )
    dep, arr = text.minutes_hhmm(minute), text.minutes_hhmm((minute + 1435) % 1440)
    kind = F.when(stop == 1, "LO").when(stop == 7, "LT").otherwise("LI")
    times = F.when(stop == 1, dep).when(stop == 7, arr).otherwise(F.concat(arr, F.lit(" "), dep))
    line = F.when(F.col("schedule") == -1, insert).when(stop == 0, head).otherwise(F.concat(kind, place, F.lit(" "), times))
    return in_order(rows, order, "line_no", [F.lit("all.zip").alias("archive"), line.alias("line")], "timetable")


# ---- sorting and sets ----------------------------------------------------------------------------


@query
def sort_nulls_last(spark, sf):
    wide = incident_pivot(spark, sf)
    marked = wide.withColumn("first_reason", F.when(F.col("INCIDENT_R0") > 0, "R0").when(F.col("INCIDENT_R1") > 0, "R1"))
    return basics.sort_nulls_last(marked.select(*HOUR_KEYS, "first_reason"), "first_reason", *HOUR_KEYS)


@query
def first_segment(spark, sf):
    return basics.first_segment(fx.event_segments(spark, sf))


@query
def union_by_name(spark, sf):
    customers = fx.table(spark, sf, "customer").select("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    suppliers = fx.table(spark, sf, "supplier").select("s_name", "s_nationkey", "s_acctbal")
    return basics.union_tables(
        [customers.toDF("name", "nationkey", "acctbal", "mktsegment"), suppliers.toDF("name", "nationkey", "acctbal")]
    )


# ---- scalar expressions --------------------------------------------------------------------------


@query
def fixed_width_slice(spark, sf):
    body = F.col("text")
    return fx.table(spark, sf, "documents").select(
        "doc_id",
        F.md5(text.fixed(body, 3, 7)).alias("code_md5"),
        F.length(F.trim(text.fixed(body, 45, 5))).alias("trimmed"),
        F.length(F.substring(body, 11, F.length(body))).alias("rest"),
    )


@query
def normalise_hhmm(spark, sf):
    raw = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit("H"))).otherwise(
        F.concat(F.lit(" "), (F.col("p_partkey") * 7 % 12000).cast("string"), F.lit("  "))
    )
    return fx.table(spark, sf, "part").select("p_partkey", text.hhmm(raw).alias("hhmm"))


@query
def split_prefix_int(spark, sf):
    log = fx.incident_log(spark, sf)
    odd = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("x"), "SECTION_CODE")).otherwise(F.col("SECTION_CODE"))
    return log.select("event_id", text.split_prefix_int(odd).alias("section"))


@query
def segment_bucket(spark, sf):
    start = F.when(F.col("event_id") % 6 != 0, F.col("user_id") - 40 + F.col("value") / 1000)
    rows = fx.table(spark, sf, "events").select("event_id", text.segment_id(F.col("event_type"), start).alias(SEGMENT))
    return rows


@query
def parse_period_name(spark, sf):
    """Archive names of several styles built from the page ids."""
    styles = F.array(
        F.lit("Delay 2023-24 P"), F.lit("all_202324_P"), F.lit("x 23-24 p"), F.lit("x_2023 P"), F.lit("notes ")
    )
    number = F.lpad((F.col("page_id") % 13 + 1).cast("string"), 2, "0")
    name = F.concat(F.element_at(styles, (F.col("page_id") % 5 + 1).cast("int")), number, F.lit(".zip"))
    return fx.table(spark, sf, "pages").select("page_id", text.parse_period_name(name).alias("p")).select("page_id", "p.*")


@query
def parse_yymmdd(spark, sf):
    raw = F.when(F.col("o_orderkey") % 7 == 0, "991399").otherwise(F.date_format("o_orderdate", "yyMMdd"))
    parsed = time.yymmdd(raw)
    return fx.table(spark, sf, "orders").select("o_orderkey", parsed.cast("string").alias("day"))


@query
def parse_dayfirst(spark, sf):
    stamp = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    styled = (
        F.when(F.col("o_custkey") % 4 == 0, F.date_format(stamp, "dd/MM/yyyy HH:mm"))
        .when(F.col("o_custkey") % 4 == 1, F.upper(F.date_format(stamp, "dd-MMM-yyyy HH:mm")))
        .when(F.col("o_custkey") % 4 == 2, F.date_format(stamp, "dd/MMM/yyyy HH:mm"))
        .otherwise(F.date_format(stamp, "yyyy"))
    )
    return fx.table(spark, sf, "orders").select("o_orderkey", time.parse_dayfirst(styled).alias("parsed"))


@query
def round_half_even_hour(spark, sf):
    half = time.hour_floor(F.col("ts")) + F.expr("interval 30 minutes")
    ts = F.when(F.col("event_id") % 2 == 0, half).otherwise(F.col("ts"))
    return fx.table(spark, sf, "events").select("event_id", time.round_hour(ts).alias("hour_ts"))


@query
def date_parts(spark, sf):
    rows = fx.table(spark, sf, "events").select("event_id", "ts")
    return time.with_date_parts(rows, "ts", None).drop("ts")


@query
def timetable_season_of(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", time.timetable_season(F.col("o_orderdate")).alias("season"))


@query
def explode_day_mask(spark, sf):
    runs = schedule.explode_run_days(fx.validity(spark, sf))
    return runs.select("o_orderkey", F.col("run_date").cast("string").alias("run_date"))


@query
def rotate_day_mask(spark, sf):
    return fx.validity(spark, sf).select("o_orderkey", text.rotate_mask(F.col("daysofweek")).alias("mask"))


# ---- incremental ---------------------------------------------------------------------------------


@query
def stream_incident_counts(spark, sf):
    stored = fx.table(spark, sf, "events")
    stream = spark.readStream.schema(stored.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    k = F.get_json_object("props", "$.k").cast("int")
    log = stream.select(
        text.segment_id(F.col("event_type"), F.col("user_id")).alias(SEGMENT),
        F.col("ts").alias("EVENT_DATETIME"),
        F.concat(F.lit("R"), (k % 7).cast("string")).alias("INCIDENT_REASON"),
    )
    root = scratch_path(spark, "stream")
    running = streaming.stream_incident_counts(log, f"{root}/counts", f"{root}/state")
    running.awaitTermination()
    return streaming.latest_counts(spark, f"{root}/counts")


@query
def stream_incident_parts(spark, sf):
    """Counts of the stored events by a stream that keeps no state."""
    stored = fx.table(spark, sf, "events")
    stream = spark.readStream.schema(stored.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    k = F.get_json_object("props", "$.k").cast("int")
    log = stream.select(
        text.segment_id(F.col("event_type"), F.col("user_id")).alias(SEGMENT),
        F.col("ts").alias("EVENT_DATETIME"),
        F.concat(F.lit("R"), (k % 7).cast("string")).alias("INCIDENT_REASON"),
    )
    root = scratch_path(spark, "parts")
    streaming.stream_incident_parts(log, f"{root}/counts", f"{root}/state").awaitTermination()
    return streaming.summed_counts(spark, f"{root}/counts")


@query
def utc_stamps(spark, sf):
    """Event times as text with all kinds of offsets, back in UTC."""
    rows = fx.table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("plain"))
    offsets = F.array(*[F.lit(o) for o in ("", "Z", "+01:00", "-0530", " +02", "?")])
    stamp = F.concat("plain", F.element_at(offsets, (F.col("event_id") % 6 + 1).cast("int")))
    return rows.select("event_id", time.utc_ntz(stamp).alias("utc"))


@query
def chunked_equals_full(spark, sf):
    """Spine written a week at a time into months; the table is the same as from one run over the whole range."""
    # read by every window
    segments = cut_lineage(basics.segments(fx.event_segments(spark, sf)), "segments")
    root = scratch_path(spark, "chunks")

    def write(start, end):
        tables.write_window(spine.hourly_spine(segments, start, end), root, start, end)

    streaming.run_chunks(write, streaming.weekly_windows(*_event_hours(spark, sf)))
    return tables.scan_partitioned(spark, root).select(*HOUR_KEYS, "day_of_week")


# ---- models --------------------------------------------------------------------------------------


@query
def one_hot_drop_first(spark, sf):
    rows = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    coded = model.one_hot(rows)
    return coded.toDF(*[c.replace("-", "_").replace(" ", "_") for c in coded.columns])


@query
def encode_levels(spark, sf):
    """Features of orders: priority, status, and as many customers as there are."""
    rows = fx.table(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").cast("string").alias("customer"),
    )
    coded = levels.encode_levels(rows, ["priority", "status", "customer"])
    return coded.withColumn("indices", F.array_join("indices", ","))


def _regression_rows(spark, sf):
    """Events per segment and hour with one binary predictor."""
    hours = incident_pivot(spark, sf)
    night = (F.col("hour") < 6).cast("double").alias("night")
    return hours.select(night, *[c for c in hours.columns if c.startswith("INCIDENT_")])


@query
def poisson_fit(spark, sf):
    models, names = model.train_counts_model(_regression_rows(spark, sf))
    return _rounded(model.coefficient_table(spark, models, names), 3)


@query
def glm_score(spark, sf):
    items = fx.table(spark, sf, "lineitem")
    scored = model.glm_score(items, -1.5, {"l_discount": 4.0, "l_tax": -2.0, "l_quantity": 0.03})
    return _rounded(scored.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "mean_count"))


@query
def hash_split(spark, sf):
    return model.hash_split(fx.table(spark, sf, "events").select("event_id", "user_id"), ["event_id"])


@query
def gbt_auc(spark, sf):
    """AUC per incident reason over the hours with events, from the weather columns and the hour."""
    wide = modelling_frame(spark, sf).drop("day_of_week")
    _, aucs = model.train_boosted(wide, HOUR_KEYS)
    return _rounded(aucs, 6)


@query
def rank_auc(spark, sf):
    """How well the whole part of an event's value tells its reason 0, by event type."""
    events = fx.table(spark, sf, "events")
    hit = (F.get_json_object("props", "$.k").cast("int") % 7 == 0).cast("int").alias("hit")
    return _rounded(boosting.rank_auc(events.select(F.col("event_type").alias("label"), hit, F.floor("value").alias("score"))), 9)


# ---- pipelines -----------------------------------------------------------------------------------


@query
def weather_raw(spark, sf):
    raw = weather.raw_weather(fx.observations(spark, sf), fx.station_map(spark, sf))
    return _rounded(raw)


@query
def weather_features(spark, sf):
    raw = weather.raw_weather(fx.observations(spark, sf), fx.station_map(spark, sf))
    bounds = [time.ntz(v) for v in _MIDDLE]
    return _rounded(weather.weather_features(raw, bounds=bounds))


def _incident_input(spark, sf):
    log = fx.incident_log(spark, sf).drop(SEGMENT)
    return log.withColumn("period", time.business_period(F.col("EVENT_DATETIME")))


@query
def incident_dataset(spark, sf):
    return incidents.incident_counts(
        _incident_input(spark, sf), fx.supplier_segments(spark, sf), start=_MIDDLE[0], end=_MIDDLE[1]
    )


@query
def incident_dataset_by_number(spark, sf):
    return incidents.incident_counts(
        _incident_input(spark, sf), fx.supplier_segments(spark, sf), REASONS, dedup=("INCIDENT_NUMBER",)
    )


@query
def modelling_frame(spark, sf):
    """Spine of all segments with weather features, trains present and incidents of each hour."""
    main = spine.hourly_spine(basics.segments(fx.event_segments(spark, sf)), *_event_hours(spark, sf))
    weather_table = time.with_date_parts(weather.rolling_features(fx.hourly_events(spark, sf)), "ts").drop("ts")
    trains = schedule.hourly_occupancy(fx.trips(spark, sf)).drop("run_hour")
    return _rounded(frame.modelling_frame(main, weather_table, trains, incident_pivot(spark, sf)), 4)
