"""Archived delay logs as a data source: layouts, quoted line breaks, what cannot be read, and what is not opened."""

from __future__ import annotations

import datetime as dt
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from segment_hours.functions.text import parse_period_name
from segment_hours.sources import archives, feeds

KEPT = archives.DELAY_KEPT
# A header of 37 columns: one place is called otherwise, as its own name is left out of logs.
HEADER = ["TRAIN" if c in archives.DELAY_VARIANTS else c for c in archives.DELAY_COLUMNS]


def packed(text, name="log.csv", method=zipfile.ZIP_DEFLATED):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", method) as archive:
        archive.writestr("notes.txt", "no log")
        if name:
            archive.writestr(name, text)
    return data.getvalue()


def log(rows, header=HEADER, values=None, newline="\r\n"):
    """A log whose cell of column c in row i is ``c`` and i, or what ``values`` says."""
    lines = [",".join(header)]
    lines += [",".join((values or {}).get(c, f"{c}{i}") for c in header) for i in range(rows)]
    return newline.join(lines) + newline


def collected(spark, folder, **options):
    rows = archives.read_delay_archives(spark, str(folder), **options).collect()
    return [r for r in rows if r["problem"] is None], {(r["archive"], r["member"]): r["problem"] for r in rows if r["problem"] is not None}


def test_every_layout_in_one_scan(spark, tmp_path):
    folder = tmp_path / "logs é"
    folder.mkdir()
    plain = HEADER
    more = [*plain[:5], "react_train", *plain[5:31], *plain[32:], "spare", "other"]  # a variant, a missing one, two spare
    swapped = [{"PLANNED_ORIGIN_WTT_DATETIME": "PLANNED_ORIG_GBTT_DATETIME_AFF", "PLANNED_ORIGIN_GBTT_DATETIME": "planned_orig_wtt_datetime_aff"}.get(c, c) for c in plain]
    (folder / "201920_P01.zip").write_bytes(packed("\ufeff" + log(3, [c.lower() for c in plain])))
    (folder / "delays 19-20 P02.zip").write_bytes(packed(log(2, more)))
    with zipfile.ZipFile(folder / "year.zip", "w") as outer:
        outer.writestr("in/2020-21 P05.zip", packed(log(4, swapped)))
        outer.writestr("in/2020-21 P06.zip", packed(log(0)))
    raw = archives.read_delay_archives(spark, str(folder))
    assert raw._jdf.queryExecution().toString().count("BatchScan") == 1
    assert raw.rdd.getNumPartitions() == 4
    rows, problems = collected(spark, folder)
    assert problems == {}
    found = {}
    for r in rows:
        found.setdefault((r["season"], r["period"]), []).append(r)
    assert {k: len(v) for k, v in found.items()} == {("201920", "P01"): 3, ("201920", "P02"): 2, ("202021", "P05"): 4}
    assert [found["201920", "P01"][1][c] for c in KEPT] == [f"{c.lower()}1" for c in KEPT]
    # Positions count after the variant is out: the columns behind the missing one are named by their place.
    assert found["201920", "P02"][0]["EVENT_DATETIME"] == "PFPI_MINUTES0" and found["201920", "P02"][0]["INCIDENT_REASON"] == "INCIDENT_REASON0"
    assert found["202021", "P05"][2]["PLANNED_ORIGIN_WTT_DATETIME"] == "planned_orig_wtt_datetime_aff2"


@pytest.mark.parametrize("newline", ["\r\n", "\n"])
def test_quoted_cells_keep_line_breaks(spark, tmp_path, newline):
    values = {"SECTION_CODE": '"1:2,\n""x""\r\ny"', "INCIDENT_REASON": "", "EVENT_TYPE": '""'}
    text = log(2, values=values, newline=newline) + newline + "a,b" + newline + ",".join(["z"] * 60) + newline
    (tmp_path / "201920_P01.zip").write_bytes(packed(text))
    rows, problems = collected(spark, tmp_path)
    assert problems == {} and len(rows) == 4
    assert [(r["SECTION_CODE"], r["INCIDENT_REASON"], r["EVENT_TYPE"]) for r in rows] == [('1:2,\n"x"\r\ny', None, None)] * 2 + [(None, None, None), ("z", "z", "z")]


def test_what_cannot_be_read_is_listed(spark, tmp_path):
    whole = packed(log(40_000), method=zipfile.ZIP_STORED)
    bent = bytearray(whole)
    bent[-3_000] ^= 1  # the sum over the file does not fit any more, at its very end
    (tmp_path / "201920_P01.zip").write_bytes(bytes(bent))
    (tmp_path / "201920_P02.zip").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "201920_P03.zip").write_bytes(packed("", name=None))
    (tmp_path / "201920_P04.zip").write_bytes(packed("a,b\n1,2\n"))
    (tmp_path / "201920_P05.zip").write_bytes(packed(log(1).encode() + b"\xff\xfe\n"))
    (tmp_path / "201920_P06.zip").write_bytes(packed(log(1)))
    (tmp_path / "201920_P07.zip").write_bytes(packed(""))
    (tmp_path / "readme.zip").write_bytes(packed("x"))
    (tmp_path / "notes.txt").write_text("no archive")
    with zipfile.ZipFile(tmp_path / "year.zip", "w") as outer:
        outer.writestr("201920_P08.zip", b"broken")
        outer.writestr("other.zip", packed(log(1)))
    rows, problems = collected(spark, tmp_path)
    assert {r["period"] for r in rows} == {"P06"} and len(rows) == 1
    assert {k: v.split(":")[0] for k, v in problems.items()} == {
        ("201920_P01.zip", None): "damaged",
        ("201920_P02.zip", None): "damaged",
        ("201920_P03.zip", None): "no CSV",
        ("201920_P04.zip", None): "2 columns, not 37",
        ("201920_P05.zip", None): problems["201920_P05.zip", None].split(":")[0],
        ("201920_P07.zip", None): "0 columns, not 37",
        ("readme.zip", None): "neither a period nor a year of periods",
        ("year.zip", "201920_P08.zip"): "damaged",
        ("year.zip", "other.zip"): "no period by its name",
    }
    assert "decode" in problems["201920_P05.zip", None]


def test_other_periods_are_not_opened(spark, tmp_path):
    for name in ("201920_P01.zip", "201920_P02.zip"):
        (tmp_path / name).write_bytes(packed(log(1)) if "P02" in name else b"not opened")
    rows, problems = collected(spark, tmp_path, periods=[("201920", "P02"), ("201920", "P09")])
    assert [r["period"] for r in rows] == ["P02"] and problems == {}
    assert collected(spark, tmp_path, pattern="*P07*") == ([], {})


def test_dates_of_archived_rows(spark, tmp_path):
    stamp = {c: "01-APR-2019 07:05" for c in archives.DELAY_DATES}
    (tmp_path / "201920_P01.zip").write_bytes(packed(log(2, values=stamp)))
    (tmp_path / "201920_P02.zip").write_bytes(packed(log(2, values={**stamp, "EVENT_DATETIME": ""})))
    (tmp_path / "201920_P03.zip").write_bytes(b"damaged")
    raw = archives.read_delay_archives(spark, str(tmp_path))
    table = feeds.delays_of_archives(raw)
    assert table.columns == ["season", "period", *KEPT]
    assert {(r["period"], r["EVENT_DATETIME"]) for r in table.collect()} == {("P01", dt.datetime(2019, 4, 1, 7, 5))}
    assert [tuple(r)[:4] for r in archives.unread(raw).collect()] == [("201920", "P03", "201920_P03.zip", None)]


def test_names_like_the_column_function(spark):
    rng = random.Random(4)
    parts = (("20", "", "x", "7"), ("19", "2", "24"), ("-", "_", " ", ""), ("20", "", "1"), ("", "-", " _"), ("P", "p", "Q"), ("01", "13", "2"), (".zip", ".ZIP", ""))
    names = ["".join(map(rng.choice, parts)) for _ in range(3_000)]
    names += ["2024-25 P01.zip", "delays 24-25 P02.zip", "202425_P13.ZIP", "24_25P07.zip", "2024P07.zip", "a\n201920_P01.zip"]
    rows = spark.createDataFrame([(n,) for n in names], "name string").withColumn("p", parse_period_name(F.col("name"))).collect()
    seen = 0
    for r in rows:
        if "\n" not in r["name"]:
            assert archives.period_of(r["name"]) == ((r["p"]["season"], r["p"]["period"]) if r["p"] else (None, None)), r["name"]
            seen += bool(r["p"] and r["p"]["season"])
    assert seen > 20
