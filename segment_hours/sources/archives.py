"""Archived delay logs as a data source: one partition a period file, whatever its layout.

    spark.dataSource.register(DelayArchives)
    spark.read.format("delay_archives").option("periods", "202425_P01").load(folder)
"""

from __future__ import annotations

import codecs
import csv
import fnmatch
import io
import json
import re
import sys
import zipfile
import zlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from segment_hours.functions.text import PERIOD_NAME

# Fixed format: the 37 columns of a delay log by position, and those that are kept.
DELAY_COLUMNS = (
    "FINANCIAL_YEAR_PERIOD", "ORIGIN_DEPARTURE_DATE", "TRUST_TRAIN_ID", "PLANNED_ORIGIN_LOCATION_CODE",
    "PLANNED_ORIGIN_WTT_DATETIME", "PLANNED_ORIGIN_GBTT_DATETIME", "PLANNED_DEST_LOCATION_CODE",
    "PLANNED_DEST_WTT_DATETIME", "PLANNED_DEST_GBTT_DATETIME", "TRAIN_SERVICE_CODE", "SERVICE_GROUP_CODE",
    "TOC_CODE", "ENGLISH_DAY_TYPE", "APPLICABLE_TIMETABLE_FLAG", "TRAIN_SCHEDULE_TYPE", "TRACTION_TYPE",
    "TRAILING_LOAD", "TIMING_LOAD", "UNIT_CLASS", "INCIDENT_NUMBER", "INCIDENT_CREATE_DATE",
    "INCIDENT_START_DATETIME", "INCIDENT_END_DATETIME", "SECTION_CODE", "NR_LOCATION_MANAGER",
    "RESPONSIBLE_MANAGER", "INCIDENT_REASON", "ATTRIBUTION_STATUS", "INCIDENT_EQUIPMENT",
    "INCIDENT_DESCRIPTION", "REACT_REASON", "INCIDENT_RESP_TRAIN", "EVENT_TYPE", "START_STANOX",
    "END_STANOX", "EVENT_DATETIME", "PFPI_MINUTES",
)
DELAY_KEPT = (
    "INCIDENT_START_DATETIME", "INCIDENT_NUMBER", "SECTION_CODE", "INCIDENT_REASON",
    "PLANNED_ORIGIN_WTT_DATETIME", "EVENT_DATETIME", "EVENT_TYPE", "TRAIN_SERVICE_CODE", "REACT_REASON",
    "START_STANOX", "END_STANOX", "PFPI_MINUTES",
)
# Fixed format: dates, columns that only some layouts have, and two that some layouts swap.
DELAY_DATES = ("INCIDENT_START_DATETIME", "PLANNED_ORIGIN_WTT_DATETIME", "EVENT_DATETIME")
DELAY_VARIANTS = ("INCIDENT_RESPONSIBLE_TRAIN", "INCIDENT_RESP_TRAIN", "REACT_TRAIN")
DELAY_SWAPPED = ("PLANNED_ORIG_GBTT_DATETIME_AFF", "PLANNED_ORIG_WTT_DATETIME_AFF")

# What opening a damaged or truncated archive raises.
CORRUPT = (zipfile.BadZipFile, pa.ArrowInvalid, zlib.error, EOFError, NotImplementedError)
_ROWS_PER_BATCH = 20_000
_LISTING_THREADS = 16
_PLACES = ("season", "period", "archive", "member")


def uri_of(path):
    """A path as Spark or Hadoop gives it, as a URI that names its file system."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path[5:]
    return quote(path, safe="/:@")


def open_archive(path):
    filesystem, inner = pyarrow.fs.FileSystem.from_uri(uri_of(path))
    return zipfile.ZipFile(filesystem.open_input_file(inner))


def period_of(name):
    """(season, period) of an archive's name, as ``functions.text.parse_period_name``; (None, None) where it names none."""
    found = re.search(PERIOD_NAME, name, re.ASCII)
    if not found:
        return None, None
    season = re.sub("[-_ ]", "", found[1])
    return season if len(season) >= 6 else f"20{season}", f"P{found[2]}"


def layout_of(header, names, variants=DELAY_VARIANTS, swapped=DELAY_SWAPPED):
    """Places of the ``names`` in a file with this header: variants are left out, swapped ones put in order, then positions count."""
    upper = [h.upper() for h in header]
    places = [i for i, h in enumerate(upper) if h not in variants][: len(names)]
    if len(places) < len(names):
        raise ValueError(f"{len(places)} columns, not {len(names)}")
    order = [upper[i] for i in places]
    if all(order.count(c) == 1 for c in swapped):
        a, b = (order.index(c) for c in swapped)
        places[a], places[b] = places[b], places[a]
    return dict(zip(names, places, strict=True))


@dataclass
class PeriodFile(InputPartition):
    """A period archive: a file, or a member of one. With a ``problem`` it is not to be read."""

    archive: str
    member: str | None
    season: str | None
    period: str | None
    problem: str | None = None


class DelayReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = schema.names
        self.kept = [c for c in schema.names if c not in (*_PLACES, "row", "problem")]
        self.root = options.get("path")
        self.pattern = options.get("pattern", "*.zip")
        self.encoding = options.get("encoding", "utf-8")
        self.names = json.loads(options["names"]) if "names" in options else list(DELAY_COLUMNS)
        self.periods = set(options["periods"].split(",")) if "periods" in options else None

    def _wanted(self, part):
        return self.periods is None or part.season is None or f"{part.season}_{part.period}" in self.periods

    def _members(self, path):
        """The period files of an archive, by its directory only."""
        name = path.rsplit("/", 1)[-1]
        own = PeriodFile(path, None, *period_of(name))
        if own.season is not None and not self._wanted(own):
            return []
        try:
            with open_archive(path) as archive:
                inner = sorted(m for m in archive.namelist() if m.lower().endswith(".zip"))
        except CORRUPT as error:
            own.problem = f"damaged: {error}"
            return [own]
        if own.season is not None:
            return [own]
        if not inner:
            own.problem = "neither a period nor a year of periods"
            return [own]
        parts = [PeriodFile(path, m, *period_of(m.rsplit("/", 1)[-1])) for m in inner]
        for part in parts:
            part.problem = "no period by its name" if part.season is None else None
        return [p for p in parts if self._wanted(p)]

    def partitions(self):
        filesystem, inner = pyarrow.fs.FileSystem.from_uri(uri_of(self.root))
        found = filesystem.get_file_info(pyarrow.fs.FileSelector(inner))
        names = sorted(f.base_name for f in found if f.is_file and fnmatch.fnmatch(f.base_name, self.pattern))
        with ThreadPoolExecutor(_LISTING_THREADS) as pool:
            listed = pool.map(self._members, [f"{self.root.rstrip('/')}/{n}" for n in names])
            return [part for parts in listed for part in parts]

    def _batch(self, part, numbers, columns, problem=None):
        values = {"season": part.season, "period": part.period, "archive": part.archive.rsplit("/", 1)[-1], "member": part.member, "problem": problem}
        n = len(numbers)
        arrays = []
        for c in self.columns:
            if c == "row":
                arrays.append(pa.array(numbers, pa.int64()))
            else:
                arrays.append(pa.array([values[c]] * n if c in values else columns.get(c, [None] * n), pa.string()))
        return pa.RecordBatch.from_arrays(arrays, self.columns)

    def _rows(self, archive, part):
        member = next((m for m in archive.namelist() if m.lower().endswith(".csv")), None)
        if member is None:
            raise ValueError("no CSV")
        # A period counts whole or not at all: damage shows at the end, so it is read once before a row is given out.
        decoder = codecs.getincrementaldecoder(self.encoding)()
        with archive.open(member) as stream:
            while block := stream.read(1 << 20):
                decoder.decode(block)
        decoder.decode(b"", final=True)
        csv.field_size_limit(sys.maxsize)
        with archive.open(member) as stream:
            rows = csv.reader(io.TextIOWrapper(stream, encoding=self.encoding, newline=""))
            header = next(rows, [])
            layout = layout_of([h.lstrip("﻿") for h in header], self.names)
            places = [layout[c] for c in self.kept]
            numbers, found = [], []
            for number, row in enumerate(rows):
                if not row:
                    continue
                row += [""] * (len(header) - len(row))
                numbers.append(number)
                found.append([row[i] or None for i in places])
                if len(found) == _ROWS_PER_BATCH:
                    yield self._batch(part, numbers, dict(zip(self.kept, zip(*found, strict=True), strict=True)))
                    numbers, found = [], []
            if found:
                yield self._batch(part, numbers, dict(zip(self.kept, zip(*found, strict=True), strict=True)))

    def read(self, partition):
        if not isinstance(partition, PeriodFile):  # none was found
            return
        problem = partition.problem
        if problem is None:
            try:
                with open_archive(partition.archive) as outer:
                    if partition.member is None:
                        yield from self._rows(outer, partition)
                        return
                    with outer.open(partition.member) as packed, zipfile.ZipFile(packed) as inner:
                        yield from self._rows(inner, partition)
                        return
            except CORRUPT as error:
                problem = f"damaged: {error}"
            except (ValueError, csv.Error) as error:  # a layout, an encoding
                problem = str(error)
        yield self._batch(partition, [None], {}, problem)


class DelayArchives(DataSource):
    """Format ``delay_archives``: rows of the first CSV of every period archive of a folder, and a row for each that cannot be read.

    Options: ``path``; ``pattern`` of file names; ``periods`` (``202425_P01,...``): other periods are not opened; ``encoding``;
    ``names`` (JSON list): columns by position.
    """

    @classmethod
    def name(cls):
        return "delay_archives"

    def schema(self):
        return ", ".join(f"{c} string" for c in _PLACES) + ", row long, " + ", ".join(f"{c} string" for c in DELAY_KEPT) + ", problem string"

    def reader(self, schema):
        return DelayReader(schema, self.options)


def read_delay_archives(spark, root, pattern="*.zip", periods=None, names=None, encoding="utf-8"):
    """Raw delay rows of the archives of a folder: (season, period, archive, member, row, kept columns as text, problem).

    An archive holds period archives or is one itself. Each period is a partition of one scan: its header decides its own
    layout, and quoted cells may hold line breaks. A period that is damaged, has no CSV, too few columns or no period in its
    name gives one row with a ``problem`` and nothing else; so does a damaged archive. Short rows end in nulls, empty cells
    are null, blank lines are skipped. ``periods`` ((season, period) pairs) opens the listed periods only.
    """
    spark.dataSource.register(DelayArchives)
    reader = spark.read.format("delay_archives").option("pattern", pattern).option("encoding", encoding)
    if names is not None:
        reader = reader.option("names", json.dumps(list(names)))
    if periods is not None:
        reader = reader.option("periods", ",".join(sorted(f"{s}_{p}" for s, p in periods)))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(root))
    whole = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop)
    return reader.load(whole.toString())


def unread(raw):
    """(season, period, archive, member, problem) of what could not be read."""
    return raw.where(F.col("problem").isNotNull()).select("season", "period", "archive", "member", "problem")
