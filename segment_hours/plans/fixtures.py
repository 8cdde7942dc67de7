"""Roles of the engine's inputs played by the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from segment_hours.config import SEGMENT
from segment_hours.functions.text import minutes_hhmm, segment_id
from segment_hours.functions.time import hour_floor, hour_index


# Given schemas, so that opening a table starts no job.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark, sf, name):
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def events(spark, sf):
    """Events with their segment: event type and user bucket."""
    return table(spark, sf, "events").withColumn(SEGMENT, segment_id(F.col("event_type"), F.col("user_id")))


def event_segments(spark, sf):
    return events(spark, sf).select(SEGMENT)


def hourly_events(spark, sf):
    """One row per segment and hour, in the columns of the weather features."""
    hours = events(spark, sf).groupBy(SEGMENT, hour_floor(F.col("ts")).alias("ts"))
    return hours.agg(
        (F.min("value") - 50).alias("min_air_temp"),
        (F.max("value") - 50).alias("max_air_temp"),
        F.sum("value").alias("prcp_amt"),
        F.max("value").alias("snow_depth"),
    )


# The station table of each event type; all other types are gusts.
STATION_TABLES = {"view": "TD", "click": "RH", "purchase": "WH"}


def all_observations(spark, sf):
    """Every event as an observation (_table, src_id, meto_stmp_time, value): user_id % 15 is the station."""
    name = F.lit("WM")
    for kind, of in STATION_TABLES.items():
        name = F.when(F.col("event_type") == kind, of).otherwise(name)
    return table(spark, sf, "events").select(
        name.alias("_table"), (F.col("user_id") % 15).alias("src_id"), F.col("ts").alias("meto_stmp_time"), "event_type", "value"
    )


def observations(spark, sf):
    """Station tables of all events; sign-ups are gust speeds and errors gust directions."""
    rows = all_observations(spark, sf)

    def of(name, **values):
        picked = rows.where(F.col("_table") == name)
        return picked.select("src_id", "meto_stmp_time", *[v.alias(c) for c, v in values.items()])

    value, kind = F.col("value"), F.col("event_type")
    return {
        "TD": of("TD", min_air_temp=value - 50, max_air_temp=value + 50),
        "RH": of("RH", prcp_amt=value),
        "WH": of("WH", snow_depth=value),
        "WM": of("WM", max_gust_speed=F.when(kind == "signup", value), max_gust_dir=F.when(kind == "error", value)),
    }


def station_map(spark, sf):
    key = F.col("n_nationkey").cast("bigint")
    return table(spark, sf, "nation").select(
        key.cast("string").alias("loc_id"),
        (key % 15).alias("src_id_TD"),
        ((key + 7) % 15).alias("src_id_RH"),
        ((key + 3) % 15).alias("src_id_WH"),
        ((key + 11) % 15).alias("src_id_WM"),
        F.lit("2024").alias("year"),
    )


def incident_log(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    return events(spark, sf).select(
        SEGMENT,
        F.col("event_id"),
        F.col("ts").alias("EVENT_DATETIME"),
        F.concat(F.lit("R"), (k % 7).cast("string")).alias("INCIDENT_REASON"),
        F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("SECTION_CODE"),
        F.floor(F.col("event_id") / 2).alias("INCIDENT_NUMBER"),
        F.col("value").alias("PFPI_MINUTES"),
    )


def day_mask(number):
    return F.lpad(F.bin(number % 128), 7, "0")


def validity(spark, sf):
    """Orders as schedules: start and end date and day mask."""
    start = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        start.alias("start_date"),
        F.date_add(start, (F.col("o_orderkey") % 45).cast("int")).alias("end_date"),
        day_mask(F.col("o_custkey")).alias("daysofweek"),
    )


def dep_minute():
    return (F.col("l_partkey") * 7 + F.col("l_linenumber") * 13) % 1440


def hop_rows(spark, sf):
    """Line items as hops of their order's schedule."""
    stops = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_suppkey").alias("stanox_dep"), minutes_hhmm(dep_minute()).alias("dep_time")
    )
    return stops.join(validity(spark, sf), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("train_id"), "stanox_dep", "dep_time", "start_date", "end_date", "daysofweek"
    )


def supplier_segments(spark, sf, size=8):
    """Supplier to segment map; the key is also the position."""
    line = F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("STANOX"),
        segment_id(line, F.col("s_suppkey"), size).alias(SEGMENT),
        F.col("s_suppkey").alias("pos"),
    )


def nation_segments(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("STANOX"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias(SEGMENT),
        F.col("s_suppkey").alias("pos"),
    )


def _coordinate(i):
    return F.col("embedding")[i].cast("double") * 1e5


def points(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", _coordinate(0).alias("EASTING"), _coordinate(1).alias("NORTHING")
    )


def track_lines(spark, sf):
    """Every embedding as a polyline of three vertices."""
    vertices = [F.struct(_coordinate(i).alias("x"), _coordinate(i + 1).alias("y")) for i in (2, 4, 6)]
    return table(spark, sf, "embeddings").select(
        F.concat(F.lit("L"), F.col("label").cast("string")).alias("ELR"),
        (F.col("vec_id") % 40).cast("double").alias("START"),
        F.array(*vertices).alias("geometry"),
    )


def degrees(spark, sf, first):
    """Embedding components as positions around the British Isles."""
    part = F.col("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id",
        (F.lit(54.0) + part[first].cast("double") * 10).alias("lat"),
        (F.lit(-2.0) + part[first + 1].cast("double") * 10).alias("lon"),
    )


def trips(spark, sf):
    """Events as trips of up to five hours."""
    first = hour_index(F.col("ts"))
    return events(spark, sf).select(
        SEGMENT, first.alias("first_hour"), (first + F.col("user_id") % 5).alias("last_hour")
    )
