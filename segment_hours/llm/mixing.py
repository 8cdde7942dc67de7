"""Mixing sources to target weights by weighted sampling with exponential keys."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from segment_hours.llm.common import WORD, fresh, stage, table

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
# Sampling weight of a document by its quality label.
QUALITY = {1: 2.0, 0: 0.5}
UNLABELLED = 1.0
ROWS_PER_SLICE = 50_000
SEED = 20


def source_targets(sizes, weights=WEIGHTS, most=MOST_EPOCHS):
    """Adds ``weight`` and ``target`` to (source, source_size, ...): one row per source.

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... and share the sum of all sizes. A target stops at
    ``most`` times its source; the excess is shared again by weight. That ends where every open source has
    ``level * weight``: sources are capped in the order of ``most * size / weight`` until the level of the others
    fits under the next cap. The windows run over the table of sources, one row each.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    named = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("weight", named[(F.row_number().over(order) - 1) % len(weights)])
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(most))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    total = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # Level if this source and all after it stay open; the first source under its cap sets the level.
    levels = ranked.withColumn("level", rest / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    levels = levels.withColumn("level", F.first(fits, ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return levels.withColumn("target", target).drop("cap", "level")


def sized(docs):
    """(rid, doc_id, source, size): words per document, without the text."""
    return docs.select(
        F.xxhash64("doc_id", "text", "source").alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def mix(docs, labels, weights=WEIGHTS, most=MOST_EPOCHS, rows_per_slice=ROWS_PER_SLICE, seed=SEED):
    """(rid, doc_id, source, size, source_size, target, taken): the words that the mix takes of every document.

    A source with target t and size S is taken whole floor(t / S) times. For the rest documents come in the order
    of Efraimidis-Spirakis keys ``-ln(u) / quality weight`` (u from a hash of the row, so reruns agree) until their prefix
    sum reaches the budget; the document on the border is taken if at least half of it fits, so a source
    misses its target by half a document at most. ``labels`` (doc_id, quality) gives the weights; None or no label: 1.

    Sources are cut into slices of about ``rows_per_slice`` rows by key, so that no task sorts a whole source.
    Null text and empty text have size 0 and are taken 0. Null source is a source of its own, named last.
    Repeated rows count each; they tie in their keys. An empty table gives an empty result.
    """
    rows = sized(docs)
    quality = F.lit(UNLABELLED)
    if labels is not None:
        # Of several labels the best counts.
        marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
        rows = rows.join(marks, "doc_id", "left")
        for value, weight in QUALITY.items():
            quality = F.when(F.col("quality") == value, F.lit(weight)).otherwise(quality)
    u = (F.pmod(F.xxhash64("rid", F.lit(seed)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    keyed = rows.withColumn("quality", quality).select("rid", "doc_id", "source", "size", "quality", (-F.log(u) / F.col("quality")).alias("key"))
    keyed = stage(keyed, "sized")
    classes = sorted({UNLABELLED, *QUALITY.values()})
    alike = [F.count_if(F.col("quality") == w).alias(f"n_{i}") for i, w in enumerate(classes)]
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"), *alike)
    sources = stage(source_targets(sizes, weights, most), "sources")
    known = keyed.select("rid", "doc_id", F.col("source").alias("own"), "size", "key")
    joined = known.join(sources, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    parts = F.ceil(F.col("n_rows") / rows_per_slice)
    # The keys of weight w are exponential with rate w: their share below a key, summed over the weights, is even over the rows of
    # the source and rises with the key, so slices are of about one size whatever the weights.
    share = sum(F.col(f"n_{i}") * (1 - F.exp(-F.col("key") * w)) for i, w in enumerate(classes)) / F.col("n_rows")
    sliced = joined.withColumn("slice", F.floor(share * parts)).drop(*[f"n_{i}" for i in range(len(classes))])
    totals = sliced.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        F.col("source").alias("own"), F.col("slice").alias("part"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("source", "slice").orderBy("key", "rid").rowsBetween(Window.unboundedPreceding, 0)
    summed = sliced.withColumn("upto", F.sum("size").over(within))
    # Every slice has its row. Outer, so that the rows are not the side that is broadcast when they are done first: a rerun
    # gives them in the same order.
    placed = summed.join(base, F.col("source").eqNullSafe(F.col("own")) & (F.col("slice") == F.col("part")), "left")
    before = F.col("base") + F.col("upto") - F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    extra = F.when(before + F.col("size") / 2 <= budget, 1).otherwise(0)
    times = F.least(F.col("epochs") + extra, F.lit(most))
    placed = placed.withColumn("epochs", epochs)
    return placed.select("rid", "doc_id", "source", "size", "source_size", "target", (times * F.col("size")).alias("taken"), times.alias("times"))


def repeat_to_mix(docs, labels, **options):
    """The rows of ``docs`` with all their columns, each as often as the mix takes it (documents without words: once)."""
    taken = mix(docs, labels, **options).withColumn("times", F.when(F.col("size") == 0, 1).otherwise(F.col("times")))
    taken = taken.groupBy("rid").agg(F.max("times").alias("times"))
    rid, times, copy = fresh(docs, "_rid"), fresh(docs, "_times"), fresh(docs, "_copy")
    taken = taken.select(F.col("rid").alias(rid), F.col("times").alias(times))
    rows = docs.withColumn(rid, F.xxhash64("doc_id", "text", "source")).join(taken.where(F.col(times) > 0), rid)
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times).cast("long")))).select(*docs.columns)


def mix_documents(spark, sf):
    return mix(table(spark, sf, "documents"), table(spark, sf, "labels"))
