"""Incremental incident counts per segment, hour and reason."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from segment_hours.config import SEGMENT
from segment_hours.functions.time import as_range


def count_incidents(stream, event="EVENT_DATETIME", reason="INCIDENT_REASON", delay=None):
    """Running counts per hour, of all rows however late they come; every hour stays in the state for good.

    With a ``delay`` rows further behind the newest event are left out, and hours before that leave the state. To count late
    rows and keep no state see :func:`stream_incident_parts`.

    Event times are zone-free; a watermark needs a zoned column, and the session zone is UTC.
    """
    timed = stream.withColumn("_event", F.col(event).cast("timestamp"))
    timed = timed.withWatermark("_event", delay) if delay else timed
    grouped = timed.groupBy(F.window("_event", "1 hour"), SEGMENT, reason)
    counts = grouped.agg(F.count("*").alias("n"))
    return counts.select(SEGMENT, F.col("window.start").cast("timestamp_ntz").alias("ts"), reason, "n")


def stream_incident_counts(stream, out, checkpoint, **options):
    """Starts the query on what is available: every batch writes the counts it changed.

    A batch replaces only its own folder ``batch=N``, so a batch that is run again after a failure
    leaves the same files. The newest batch of a key is its count (:func:`latest_counts`).
    """

    def write(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(out)

    counts = count_incidents(stream, **options)
    writer = counts.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_counts(spark, out, reason="INCIDENT_REASON"):
    """Current counts of the written batches."""
    written = spark.read.parquet(out)
    return written.groupBy(SEGMENT, "ts", reason).agg(F.max_by("n", "batch").alias("n"))


def stream_incident_parts(stream, out, checkpoint, event="EVENT_DATETIME", reason="INCIDENT_REASON"):
    """Starts the query on what is available: every batch writes the counts of its own rows, however late these are.

    Nothing is kept between batches: counts add up, so the current count of an hour is the sum of its parts
    (:func:`summed_counts`). A batch replaces only its own folder ``batch=N``, so running one again after a failure counts its rows once.
    """

    def write(batch, number):
        hour = F.date_trunc("hour", F.col(event).cast("timestamp_ntz")).alias("ts")
        parts = batch.where(F.col(event).isNotNull()).groupBy(SEGMENT, hour, reason).agg(F.count("*").alias("n"))
        parts.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(out)

    writer = stream.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def summed_counts(spark, out, reason="INCIDENT_REASON"):
    """Current counts of the parts that :func:`stream_incident_parts` wrote, and of :func:`merge_parts`."""
    return spark.read.parquet(out).groupBy(SEGMENT, "ts", reason).agg(F.sum("n").alias("n"))


def merge_parts(spark, out, merged, reason="INCIDENT_REASON"):
    """Writes the sums of all parts as one part (batch -1) of a new folder ``merged``, which then stands for ``out``.

    Run it between two runs of the query; the query goes on in the new folder with the same checkpoint.
    """
    summed_counts(spark, out, reason).withColumn("batch", F.lit(-1).cast("long")).write.partitionBy("batch").parquet(merged)
    return merged


def weekly_windows(start, end):
    """Windows (first hour, last hour) that cover start to end, a new one each Sunday at midnight."""
    start, end = as_range(start, end)
    while start <= end:
        days = 7 - (start.isoweekday() % 7)
        following = dt.datetime.combine(start.date() + dt.timedelta(days=days), dt.time())
        yield start, min(end, following - dt.timedelta(hours=1))
        start = following


def run_chunks(write_range, windows):
    """Backfill: the same batch operator over a list of (start, end) windows, one after the other.

    With a sink that replaces only the hours of the window (``sources.tables.write_window``), windows may share a
    partition, and each can be run again at any time.
    """
    for start, end in windows:
        write_range(start, end)
