"""Contiguous shards of equal bytes by global prefix sums."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from segment_hours.llm.common import stage

SHARDS = 16


def prefix_sums(rows, order, size, partitions=None):
    """Adds ``before`` (sum of ``size`` of the rows before) and ``idx`` (rows before) in the order of ``order``.

    Rows are dealt into ranges of the order and stored; each range has its totals, the few totals are
    summed up, and rows add what lies before them in their own range.
    """
    spark = rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id())
    ranged = stage(ranged, "ranges")
    totals = ranged.groupBy("range").agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    base = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base_rows"),
    )
    within = Window.partitionBy("range").orderBy(*order)
    summed = ranged.withColumns(
        {
            "before": F.sum(size).over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size),
            "idx": F.row_number().over(within).cast("long") - 1,
        }
    )
    # One row per range: bounded by the number of partitions, not by the data.
    return summed.join(F.broadcast(base), "range").select(
        *rows.columns,
        (F.col("before") + F.col("base_bytes")).alias("before"),
        (F.col("idx") + F.col("base_rows")).alias("idx"),
    )


def balanced_shards(docs, shards=SHARDS, partitions=None):
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): documents by doc_id, cut at equal byte targets.

    Size is the UTF-8 bytes of the text plus 1 (null text: 1). A document goes to the shard in which its
    middle byte falls, so a shard misses its target by half a document at each end at most. ``slot`` counts within
    the shard. Equal ids are ordered by size and checksum; null ids come first. Texts are not moved: only ids,
    sizes and checksums are shuffled. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    placed = stage(prefix_sums(rows, ["doc_id", "size", "text_crc32"], "size", partitions), "placed")
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(1))).first()[0]  # one number
    cut = F.expr(f"cast((before * 2 + size) * {shards}L div {total * 2}L as int)")  # whole numbers up to 2**57 bytes
    cut_rows = placed.withColumn("shard", F.least(cut, F.lit(shards - 1)))
    first = cut_rows.groupBy("shard").agg(F.min("idx").alias("first"))  # one row per shard
    return cut_rows.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("idx") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
