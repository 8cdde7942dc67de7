"""Reference-data and delay feeds: tab records, nested JSON, zipped lines and delay logs."""

from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segment_hours.functions.time import parse_dayfirst
from segment_hours.operators.basics import rename_positional, swap_columns
from segment_hours.session import spread
from segment_hours.sources.archives import DELAY_COLUMNS, DELAY_DATES, DELAY_KEPT, DELAY_SWAPPED, DELAY_VARIANTS, open_archive

# Fixed format: fields of a location record.
LOCATION_FIELDS = (
    "RECORD_TYPE", "ACTION_CODE", "TIPLOC", "LOC_NAME", "START_DATE", "END_DATE", "EASTING",
    "NORTHING", "TIMING_POINT_TYPE", "ZONE", "STANOX", "OFF_NETWORK", "LPB",
)

_TIMETABLE_SUFFIXES = (".mca", ".cfa", ".cif")
_ROWS_PER_BATCH = 50_000
_MEMBER_STRIDE = 10**10


def tab_records(lines, fields=LOCATION_FIELDS, marker="LOC", column="value"):
    """Tab-separated fields of the lines that start with ``marker``; absent fields are null."""
    parts = F.split(F.col(column), "\t")
    kept = lines.where(F.col(column).startswith(marker))
    return kept.select(*[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(fields)])


def read_locations(spark, path):
    """Location records of plain or gzipped text files."""
    return tab_records(spark.read.text(str(path)))


def flatten_records(df, path):
    """Rows of the array of records at a dotted path."""
    return df.select(F.explode(F.col(path)).alias("_record")).select("_record.*")


def read_json_records(spark, path, schema, field=None, encoding=None, multi_line=True):
    """Rows of an array of records in a JSON document: at ``field``, or under its only key.

    A file is one document, or with ``multi_line=False`` one per line.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    if encoding:
        reader = reader.option("encoding", encoding)
    df = reader.json(str(path))
    if field is None:
        if len(df.columns) != 1:
            raise ValueError(f"name the field to unwrap; found {df.columns}")
        field = f"`{df.columns[0]}`"
    return flatten_records(df, field)


def corpus_schema(record):
    return T.StructType([T.StructField("TIPLOCDATA", T.ArrayType(record))])


_HOLIDAYS = "`england-and-wales` struct<events: array<struct<title: string, date: date, notes: string, bunting: boolean>>>"


def read_holidays(spark, path):
    """Public holidays of England and Wales."""
    return read_json_records(spark, path, _HOLIDAYS, "`england-and-wales`.events")


def read_station_map(spark, path, tables):
    """Station map rows: loc_id, year as text and one station id per weather table."""
    ids = ", ".join(f"src_id_{t} string" for t in tables)
    return spark.read.schema(f"loc_id string, year string, {ids}").json(str(path))


def combine_station_maps(maps):
    """Station maps joined column-wise on (loc_id, year)."""
    combined = maps[0]
    for other in maps[1:]:
        combined = combined.join(other, ["loc_id", "year"], "full")
    return combined


def normalise_delays(df, names=DELAY_COLUMNS, keep=DELAY_KEPT, dates=DELAY_DATES, carry=()):
    """Delay log in its kept columns: positional names, rows without a date dropped, dates parsed.

    ``carry`` names trailing columns that are not part of the log and are kept as they are.
    """
    log = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in carry], *carry)
    upper = [c.upper() for c in log.columns[: len(log.columns) - len(carry)]]
    log = log.toDF(*upper, *carry).drop(*DELAY_VARIANTS)
    body = [c for c in log.columns if c not in carry][: len(names)]
    log = swap_columns(log.select(*[F.col(f"`{c}`") for c in body], *carry), *DELAY_SWAPPED)
    named = rename_positional(log, [*names, *carry]).select(*carry, *keep)
    present = named.dropna(subset=list(dates))
    return present.withColumns({c: parse_dayfirst(F.col(c)) for c in dates})


def archive_members(spark, root, pattern="*.zip"):
    """(archive, name) of the zip files under ``root``, without reading them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(str(root))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"))


def _list_members(batches):
    """(path, name, member, rank) of the timetable members in name order."""
    for batch in batches:
        rows = []
        for path, name in zip(batch["path"], batch["name"], strict=True):
            with open_archive(path) as archive:
                members = sorted(m for m in archive.namelist() if m.lower().endswith(_TIMETABLE_SUFFIXES))
            rows.extend((path, name, member, rank) for rank, member in enumerate(members))
        yield pd.DataFrame(rows, columns=["path", "name", "member", "rank"])


def _line_frames(stream, encoding):
    """Frames of (line_no, line), a batch at a time."""
    rows = []
    for number, line in enumerate(io.TextIOWrapper(stream, encoding=encoding)):
        rows.append((number, line.rstrip("\r\n")))
        if len(rows) == _ROWS_PER_BATCH:
            yield pd.DataFrame(rows, columns=["line_no", "line"])
            rows = []
    if rows:
        yield pd.DataFrame(rows, columns=["line_no", "line"])


def read_timetable_lines(spark, root, pattern="*.zip", encoding="latin-1", seasons=None):
    """Timetable lines in archive order: (archive, line_no, line).

    Archives are listed first, then each member is unpacked by a task of its own, a batch at a time.
    Line numbers rise through the members of an archive in name order. ``seasons`` keeps the archives
    named after the given season codes.
    """
    archives = archive_members(spark, root, pattern)
    if seasons is not None:
        archives = archives.where(F.regexp_replace("name", r"\.zip$", "").isin(list(seasons)))

    def read_all(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                with open_archive(row.path) as archive, archive.open(row.member) as stream:
                    for lines in _line_frames(stream, encoding):
                        lines["line_no"] += row.rank * _MEMBER_STRIDE
                        lines.insert(0, "archive", row.name)
                        yield lines

    listed = spread(archives, "path").mapInPandas(_list_members, "path string, name string, member string, rank long")
    todo = spread(listed, "path", "member")
    return todo.mapInPandas(read_all, "archive string, line_no long, line string")


def delays_of_archives(raw, dates=DELAY_DATES):
    """Delay rows of :func:`segment_hours.sources.archives.read_delay_archives`, with season and period: rows without a date dropped, dates parsed."""
    rows = raw.where(F.col("problem").isNull()).drop("archive", "member", "row", "problem")
    present = rows.dropna(subset=list(dates))
    return present.withColumns({c: parse_dayfirst(F.col(c)) for c in dates})
