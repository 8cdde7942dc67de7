"""Levels of text columns as a table, and rows encoded by it as sparse 0/1 features.

Where a column has few values, :func:`segment_hours.operators.model.one_hot` gives each its own column. Here neither the
driver nor the plan holds the levels, so their number may grow with the data.
"""

from __future__ import annotations

import functools

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Window
from pyspark.sql import functions as F

from segment_hours.session import cut_lineage

# A level with at least this share of a column's rows is looked up by broadcast: a column has no more than 1,000 of them.
HOT_SHARE = 1e-3
# Cells over which rows spread that need no lookup.
_SALTS = 4096


def numbered(df, order, name="idx", ranges=None):
    """Adds the place of each row (from 0) in the order of the columns ``order``, without one task seeing all rows.

    Rows are dealt into ranges and stored; a row counts the rows of earlier ranges and those before it in its own.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    ranged = cut_lineage(ranged, "ranges")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    base = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    base = base.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_range").orderBy(*order)
    placed = ranged.withColumn("_own", F.row_number().over(within))
    return placed.join(F.broadcast(base), "_range").select(*df.columns, (F.col("_base") + F.col("_own") - 1).cast("long").alias(name))


def level_table(df, columns, drop_first=True, ranges=None):
    """(column, level, n, idx): values of the text columns ``columns``, their rows, and their place among all features.

    Features follow the order of column names and values. The first level of a column has no feature (``idx`` null) unless
    ``drop_first`` is false. Null is no level. A column without values has no rows; so has an empty table.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns]))
    counts = df.select(cells.alias("_cell")).select("_cell.*").dropna().groupBy("column", "level").agg(F.count("*").alias("n"))
    counts = cut_lineage(counts, "levels")
    if not drop_first:
        return numbered(counts, ["column", "level"], ranges=ranges)
    first = counts.groupBy("column").agg(F.min("level").alias("_first"))  # one row per column
    marked = counts.join(F.broadcast(first), "column")
    kept = numbered(marked.where("level <> _first").drop("_first"), ["column", "level"], ranges=ranges)
    return kept.unionByName(marked.where("level = _first").drop("_first").withColumn("idx", F.lit(None).cast("long")))


def encode_levels(df, columns, levels=None, drop_first=True, name="indices", ranges=None):
    """The other columns of ``df`` and ``name``: the ascending numbers of the features that are 1 (``array<int>``).

    Null, unknown values and first levels have no feature. Without ``levels`` they come from ``df`` itself. Rows
    are kept as they are, repeated ones too. Frequent levels are broadcast, as only so many can be frequent; the others join by value, where
    rows that need no lookup are spread. The input is read once for the levels and once for the rows.
    """
    if not columns:
        return df.withColumn(name, F.array().cast("array<int>"))
    clash = {c for c in df.columns if c not in columns} & {name}
    if clash:
        raise ValueError(f"a column is named like the result: {name}")
    levels = cut_lineage(level_table(df, columns, drop_first, ranges) if levels is None else levels, "level_table")
    totals = levels.groupBy("column").agg(F.sum("n").alias("_total"))  # one row per column
    frequent = F.col("n") >= F.col("_total") * HOT_SHARE
    sized = levels.join(F.broadcast(totals), "column").withColumn("_frequent", frequent).drop("_total", "n")
    keep = [c for c in df.columns if c not in columns]
    rows = df.select(F.struct(*keep).alias("_kept") if keep else F.lit(0).alias("_kept"), *[F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(columns)])
    values = [f"_v{i}" for i in range(len(columns))]
    for i, c in enumerate(columns):
        value, idx = values[i], f"_i{i}"
        own = sized.where(F.col("column") == c)
        hot = own.where("_frequent").select(F.col("level").alias(value), F.col("idx").alias("_hot"), F.lit(True).alias("_known"))
        rare = own.where("not _frequent and idx is not null")
        rare = rare.select(F.col("level").alias(value), F.lit(0).cast("long").alias("_salt"), F.col("idx").alias("_rare"))
        rows = rows.join(F.broadcast(hot), value, "left")
        settled = F.col("_known").isNotNull() | F.col(value).isNull()
        rows = rows.withColumn("_salt", F.when(settled, F.pmod(F.xxhash64("_kept", *values), F.lit(_SALTS)) + 1).otherwise(F.lit(0)).cast("long"))
        rows = rows.join(rare, [value, "_salt"], "left").withColumn(idx, F.coalesce("_hot", "_rare")).drop("_salt", "_hot", "_rare", "_known")
    found = F.array_compact(F.array(*[F.col(f"_i{i}").cast("int") for i in range(len(columns))]))
    return rows.select(*(["_kept.*"] if keep else []), F.array_sort(found).alias(name))


def feature_count(levels):
    """Number of features of a level table."""
    return levels.agg(F.count("idx")).first()[0]


def _sparse(size, indices):
    return SparseVector(size, indices, [1.0] * len(indices))


def sparse_vectors(df, size, indices="indices", features="features"):
    """``indices`` replaced by a sparse vector of ``size`` for Spark ML; null gives an empty vector."""
    made = F.udf(functools.partial(_sparse, size), VectorUDT())
    known = F.coalesce(F.col(indices), F.array().cast("array<int>"))
    return df.withColumn(features, made(known)).drop(*([indices] if indices != features else []))
