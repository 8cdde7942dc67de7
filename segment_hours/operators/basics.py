"""Small relational steps shared by the pipelines."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F
from pyspark.sql import types as T

from segment_hours.config import DATE_KEYS, SEGMENT
from segment_hours.functions.text import blank_to_null, number_or_null
from segment_hours.functions.time import as_range, hour_of_parts, ntz


def rename_positional(df, names):
    """All columns renamed by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def swap_columns(df, first, second):
    """The two columns change places; unchanged where one of them is missing."""
    if first not in df.columns or second not in df.columns:
        return df
    swap = {first: second, second: first}
    return df.select(*[swap.get(c, c) for c in df.columns])


def valid_locations(df, code="STANOX", easting="EASTING", northing="NORTHING"):
    """Rows with a non-blank code and a usable easting; coordinates become doubles."""
    typed = df.withColumns(
        {
            code: blank_to_null(F.col(code)),
            easting: number_or_null(F.col(easting)),
            northing: number_or_null(F.col(northing)),
        }
    )
    # fixed values: 0 and 999999 stand for "no coordinate"
    return typed.where(F.col(code).isNotNull() & F.col(easting).isNotNull() & ~F.col(easting).isin(0.0, 999999.0))


def time_range(df, ts, start, end, buffer=None):
    """Rows within [start, end], both inclusive, widened on both sides by a ``timedelta``."""
    start, end = as_range(start, end)
    if buffer is not None:
        start, end = start - buffer, end + buffer
    return df.where(F.col(ts).between(ntz(start), ntz(end)))


def stored_time_range(df, start, end):
    """:func:`time_range` on the stored date parts, with a predicate that prunes year partitions."""
    start, end = as_range(start, end)
    years = F.col("year").between(start.year, end.year)
    months = F.col("year") * 12 + F.col("month")
    pruned = df.where(years & months.between(start.year * 12 + start.month, end.year * 12 + end.month))
    return pruned.where(hour_of_parts(*DATE_KEYS).between(ntz(start), ntz(end)))


def overlapping(df, low, high, start, end):
    """Rows whose interval [low, high] meets the window."""
    return df.where((F.col(low) <= end) & (F.col(high) >= start))


def clamp_interval(df, low, high, start, end):
    """Interval columns cut to the window; a null bound leaves that side alone."""
    return df.withColumns({low: F.greatest(F.col(low), start), high: F.least(F.col(high), end)})


def finite_rows(df, columns):
    """Rows where every listed column is a finite number (null is not)."""
    limit = F.lit(float("inf"))
    tests = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c).cast("double")) < limit) for c in columns]
    return df.where(functools.reduce(lambda a, b: a & b, tests))


def split_xy(df, prefix="INCIDENT_", keys=()):
    """Predictors and targets by column prefix; both carry ``keys``."""
    targets = [c for c in df.columns if c.startswith(prefix)]
    if not targets:
        raise ValueError(f"no column starts with {prefix!r}")
    others = [c for c in df.columns if c not in targets and c not in keys]
    return df.select(*keys, *others), df.select(*keys, *targets)


def fill_zero(df):
    """Nulls of every column become 0 (``"0"`` in text columns)."""
    numeric = df.na.fill(0)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return numeric.na.fill("0", subset=text) if text else numeric


def segments(df, key=SEGMENT):
    """Distinct non-null segment ids."""
    return df.select(key).dropna().distinct()


def first_segment(df, key=SEGMENT):
    return df.agg(F.min(key).alias(key))


def time_bounds(df, ts=None):
    """First and last hour of the data, from a timestamp column or the stored date parts."""
    value = F.col(ts) if ts else hour_of_parts()
    return df.agg(F.min(value).alias("min_ts"), F.max(value).alias("max_ts"))


def distinct_codes(df, column):
    """Distinct non-null values."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def sort_nulls_last(df, *columns):
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def union_tables(tables):
    """Concatenation by column name; columns missing in a table are null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def missing_partitions(required, existing, keys):
    """Required key combinations that are not there yet."""
    return required.join(existing, keys, "left_anti")


def lookup_last_wins(df, column, mapping, key, value, position, name=None):
    """Adds ``value`` of the mapping row with the highest ``position`` per key; null where unmatched."""
    name = name or value
    latest = (
        mapping.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max_by(value, position).alias(name))
    )
    return df.join(latest, F.col(column) == F.col("_key"), "left").drop("_key")
