"""Tables in CSV, JSON and Parquet, partitioned feature tables, and build-once caching."""

from __future__ import annotations

import datetime as dt
import uuid
from pathlib import PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segment_hours.config import MONTH_KEYS, PARTITION_KEYS, SEGMENT
from segment_hours.functions.time import as_range, ntz
from segment_hours.sources import files, versions
from segment_hours.sources.files import path_exists

_FORMATS = ("csv", "json", "parquet")
_WRITE_MODES = ("append", "overwrite", "ignore")
# A window of at most so many months is dealt to so many writers, each with a file a month; Spark merges or splits them by size.
_FEW_MONTHS = 2
_WRITERS = 16


def table_format(path):
    """Format from the suffix; with several suffixes the last but one counts (``x.csv.gz`` is csv)."""
    suffixes = PurePosixPath(str(path)).suffixes
    if not suffixes:
        raise ValueError(f"no format suffix in {path}")
    found = (suffixes[-1] if len(suffixes) == 1 else suffixes[-2]).lstrip(".").lower()
    if found not in _FORMATS:
        raise ValueError(f"unsupported format {found!r} of {path}; use one of {_FORMATS}")
    return found


def is_complete(spark, path):
    """Whether a table was written to its end: a single file, or a folder with the mark of a finished write."""
    return path_exists(spark, path) and (files.is_file(spark, path) or path_exists(spark, f"{path}/_SUCCESS"))


def read_table(spark, path, schema=None, **options):
    """Table in the format of its suffix. Without a schema every CSV column stays text."""
    form = table_format(path)
    if not path_exists(spark, path):
        raise FileNotFoundError(str(path))
    reader = spark.read.options(**options)
    if form == "csv":
        reader = reader.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).format(form).load(str(path))


def write_table(df, path, mode="overwrite", as_text=False, **options):
    """Writes in the format of the suffix; ``.gz`` compresses, ``as_text`` makes all columns strings."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    form = table_format(path)
    if as_text:
        df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    writer = df.write.mode(mode).format(form).options(**options)
    if form == "csv":
        writer = writer.option("header", True)
    if str(path).endswith(".gz") and form != "parquet":
        writer = writer.option("compression", "gzip")
    writer.save(str(path))


def get_or_build(spark, path, build, schema=None):
    """Reads the table if it is there, else writes what ``build()`` returns and reads that.

    The table is written aside and renamed when it is whole, so a write that fails leaves nothing under ``path`` and is done again. A folder
    without the mark of a finished write is not ours, and an error.
    """
    if not path_exists(spark, path):
        built = build()
        schema = schema or built.schema
        folder, _, name = str(path).rpartition("/")
        aside = f"{folder}{'/' * bool(folder)}_building-{uuid.uuid4().hex}-{name}"
        write_table(built, aside, mode="errorifexists")
        files.move(spark, aside, path)
    elif not is_complete(spark, path):
        raise ValueError(f"{path} has no mark of a finished write; it is left as it is")
    return read_table(spark, path, schema)


def write_partitioned(
    df, root, keys=tuple(MONTH_KEYS), mode="overwrite", sort=(), codec="snappy", rows_per_file=None, deal=None
):
    """Hive-partitioned Parquet; by default only the partitions present in ``df`` are replaced.

    Rows are brought together by partition first, so that a task keeps one writer open at a time and a
    partition is not scattered over one file per task. ``sort`` orders the rows of a partition, which
    lets a scan skip row groups; ``rows_per_file`` splits large partitions, and ``deal`` (a column) deals the rows of a
    partition to tasks, so that several write one large partition.
    """
    if mode not in _WRITE_MODES:
        raise ValueError(f"mode must be one of {_WRITE_MODES}, not {mode!r}")
    # rebalance (unlike repartition) lets AQE split a partition that holds a large share of the rows
    if deal is None:
        balanced = df.hint("rebalance", *[F.col(k) for k in keys])
    else:
        balanced = df.withColumn("_writer", deal).hint("rebalance", *[F.col(k) for k in keys], F.col("_writer")).drop("_writer")
    if sort:
        balanced = balanced.sortWithinPartitions(*keys, *sort)
    writer = balanced.write.mode(mode).option("compression", codec)
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(*keys).parquet(str(root))


def write_window(df, root, start, end, keys=tuple(MONTH_KEYS), **options):
    """Writes the hours ``start`` to ``end`` of a feature table; hours outside stay as they are. Returns the version number.

    The window is replaced as a whole: hours and segments without a new row have none afterwards. Windows need not fit
    the partitions. The input runs once, nothing stored is read or written again, and nothing of the
    write counts before its last step; a write that fails leaves the table as it was. See :mod:`segment_hours.sources.versions`.
    """
    spark = df.sparkSession
    versions.check_dates(df)
    first, last = as_range(start, end)
    hour = F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0))
    months = (last.year - first.year) * 12 + last.month - first.month + 1
    if months <= _FEW_MONTHS and SEGMENT in df.columns and set(keys) <= set(MONTH_KEYS):
        options.setdefault("deal", F.pmod(F.hash(SEGMENT), F.lit(_WRITERS)))
    name, folder = versions.new_write(spark, root, df.schema, keys)
    write_partitioned(df.where((hour >= ntz(first)) & (hour <= ntz(last))), folder, keys, mode="append", **options)
    return versions.publish(spark, root, name, df.schema, keys, (start, end))


def append_rows(df, root, keys=tuple(MONTH_KEYS), **options):
    """Adds rows to a table of :func:`write_window`, also with new columns; they stay until a window replaces their hours."""
    spark = df.sparkSession
    name, folder = versions.new_write(spark, root, df.schema, keys)
    write_partitioned(df, folder, keys, mode="append", **options)
    return versions.publish(spark, root, name, df.schema, keys)


def compact(spark, root, **options):
    """Stores the rows of a table that count as one write; an error if another write is published meanwhile."""
    version = versions.read_version(spark, root)
    windows = [w["window"] for w in version["writes"]]
    if len(windows) < 2 or None in windows:
        raise ValueError("only a table of several windows can be compacted")
    df = versions.scan_versions(spark, root, number=version["number"])
    name, folder = versions.new_write(spark, root, df.schema, version["keys"])
    write_partitioned(df, folder, version["keys"], mode="append", **options)
    span = [dt.datetime(1970, 1, 1) + dt.timedelta(hours=h) for h in (min(w[0] for w in windows), max(w[1] for w in windows))]
    return versions.publish(spark, root, name, df.schema, version["keys"], span, base=version["number"])


def scan_partitioned(spark, root, merge=True):
    """Partitioned table with the union of its files' columns. A table of versions is read by its index, without footers."""
    if versions.is_versioned(spark, root):
        return versions.scan_versions(spark, root)
    return spark.read.option("mergeSchema", merge).parquet(str(root))


def scan_segment(spark, root, segment, time_filter=None):
    """One segment's partitions, optionally of some years, months or days."""
    from segment_hours.operators.frame import partition_filter

    if versions.is_versioned(spark, root):
        return versions.scan_versions(spark, root, segment, time_filter)
    return partition_filter(scan_partitioned(spark, root), segment, time_filter)


def first_file_rows(df, keys=tuple(PARTITION_KEYS), feature_prefix="features_"):
    """Rows of one file per partition: the first name among raw files, or among all where none is raw.

    The choice is an aggregate over (partition, file) pairs, joined back to the rows.
    """
    named = df.withColumn("_file", F.col("_metadata.file_name"))
    files = named.select(*keys, "_file").distinct()
    rank = F.struct(F.col("_file").startswith(feature_prefix).alias("is_feature"), F.col("_file").alias("name"))
    chosen = files.groupBy(*keys).agg(F.min(rank)["name"].alias("_file"))
    return named.join(chosen, [*keys, "_file"], "left_semi").select(*df.columns)


def _load_named(spark, path, form, schema):
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if form == "csv":
        reader = reader.option("header", True)
    return reader.format(form).load(path)


def read_year_tables(spark, root, table, form="csv", schema=None, years=None, fill=True):
    """All ``{table}_{yyyy}.{form}`` files or folders, with the year of the name as ``file_year``.

    ``years`` (first, last) only opens the files of those years. Nulls become 0 unless told not to.
    """
    wanted = "*" if years is None else "{" + ",".join(str(y) for y in range(years[0], years[1] + 1)) + "}"
    df = _load_named(spark, f"{root}/{table}_{wanted}.{form}", form, schema)
    pattern = "/" + table + r"_(\d{4})\.[^/]*(?:/[^/]*)?$"
    year = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("int")
    df = df.withColumn("file_year", year).where(F.col("file_year").isNotNull())
    return df.na.fill(0) if fill else df


def read_period_files(spark, root, form="csv", schema=None, calendar=None):
    """All ``delay_YYYYYY_Pnn.{form}`` files or folders with their season and period.

    ``calendar`` (season, period) keeps the listed periods only: no other file is listed or opened. It is fetched to name the files; a
    year has 13 periods.
    """
    wanted = "delay_*"
    if calendar is not None:
        named = calendar.select("season", "period").dropna().distinct().collect()
        there = set(files.names(spark, root))
        found = sorted(n for n in {f"delay_{r[0]}_{r[1]}" for r in named} if f"{n}.{form}" in there)
        wanted = "{" + ",".join(found) + "}"
        if not found:
            if schema is None:
                raise FileNotFoundError(f"no period of the calendar under {root}, and no schema")
            empty = spark.createDataFrame([], T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
            return empty.select(F.lit("").alias("season"), F.lit("").alias("period"), "*")
    df = _load_named(spark, f"{root}/{wanted}.{form}", form, schema)
    path = F.col("_metadata.file_path")
    pattern = r"/delay_(\d{6})_([A-Z0-9]{3})\." + form + r"(?:/[^/]*)?$"
    named = {"season": F.regexp_extract(path, pattern, 1), "period": F.regexp_extract(path, pattern, 2)}
    rows = df.withColumns(named).where(F.col("season") != "")
    return rows if calendar is None else rows.select("season", "period", *df.columns)
