"""Tables of immutable writes: reruns, failures, writers that meet, and which files a scan opens."""

from __future__ import annotations

import datetime as dt
import json
import random
from pathlib import Path

import pytest

from segment_hours.config import HOUR_KEYS, MONTH_KEYS, PARTITION_KEYS
from segment_hours.sources import files, tables, versions

SCHEMA = "ELR_MIL string, year int, month int, day int, hour int, n long"


def _rows(spark, rows):
    return spark.createDataFrame([(s, t.year, t.month, t.day, t.hour, n) for s, t, n in rows], SCHEMA)


def _stored(spark, root, **options):
    found = versions.scan_versions(spark, root, **options).select(*HOUR_KEYS, "n").collect()
    return sorted((r[0], dt.datetime(*r[1:5]), r[5]) for r in found)


JAN, FEB = dt.datetime(2024, 1, 10, 5), dt.datetime(2024, 2, 3, 7)


@pytest.mark.parametrize("keys", [MONTH_KEYS, PARTITION_KEYS])
def test_rerun_without_rows_leaves_none(spark, tmp_path, keys):
    """The second run has no row for January: the old one must be gone."""
    root, window = str(tmp_path / "t"), ("2024-01-01", "2024-02-29 23:00")
    tables.write_window(_rows(spark, [("A", JAN, 1), ("A", FEB, 2)]), root, *window, keys)
    tables.write_window(_rows(spark, [("A", FEB, 3)]), root, *window, keys)
    assert _stored(spark, root) == [("A", FEB, 3)]
    tables.write_window(_rows(spark, []), root, *window, keys)
    assert _stored(spark, root) == []
    assert len(versions.read_version(spark, root)["writes"]) == 1


def test_failed_write_changes_nothing(spark, tmp_path):
    root, window = str(tmp_path / "t"), ("2024-01-01", "2024-02-29 23:00")
    tables.write_window(_rows(spark, [("A", JAN, 1), ("A", FEB, 2)]), root, *window)
    broken = _rows(spark, [("A", JAN, 5), ("B", FEB, 6)]).selectExpr("* except (n)", "if(month = 2, raise_error('broken'), n) as n")
    with pytest.raises(Exception, match="broken"):
        tables.write_window(broken.withColumn("n", broken["n"].cast("long")), root, *window)
    assert _stored(spark, root) == [("A", JAN, 1), ("A", FEB, 2)]
    tables.write_window(_rows(spark, [("B", FEB, 7)]), root, *window)
    assert _stored(spark, root) == [("B", FEB, 7)]


def test_write_that_ends_before_its_last_step_changes_nothing(spark, tmp_path, monkeypatch):
    root, window = str(tmp_path / "t"), ("2024-01-01", "2024-02-29 23:00")
    tables.write_window(_rows(spark, [("A", JAN, 1)]), root, *window)
    with monkeypatch.context() as patch:
        patch.setattr(files, "publish_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            tables.write_window(_rows(spark, [("A", FEB, 2)]), root, *window)
    assert _stored(spark, root) == [("A", JAN, 1)]


def test_input_runs_once(spark, tmp_path):
    root, window = str(tmp_path / "t"), ("2024-01-01", "2024-02-29 23:00")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = _rows(spark, [("A", JAN, 1), ("A", FEB, 2), ("B", FEB, 2)])
    for times in (1, 2):
        tables.write_window(rows.mapInArrow(count, rows.schema), root, *window)
        assert seen.value == 3 * times


def test_random_windows_equal_a_plain_table(spark, tmp_path):
    rng, root, plain = random.Random(2), str(tmp_path / "t"), {}
    first = dt.datetime(2024, 1, 30)
    for step in range(12):
        a = rng.randrange(0, 90)
        b = a + rng.choice((0, 3, 20, 90))
        new = {(s, h): step for s in "AB" for h in range(a, b + 1) if rng.random() < 0.2}
        start, end = (first + dt.timedelta(hours=h) for h in (a, b))
        outside = [("A", end + dt.timedelta(hours=1), -1), ("A", start - dt.timedelta(hours=1), -1)]
        rows = [(s, first + dt.timedelta(hours=h), n) for (s, h), n in new.items()]
        tables.write_window(_rows(spark, rows + outside), root, start, end)
        plain = {k: n for k, n in plain.items() if not a <= k[1] <= b} | new
    want = sorted((s, first + dt.timedelta(hours=h), n) for (s, h), n in plain.items())
    assert _stored(spark, root) == want
    tables.compact(spark, root)
    assert len(versions.read_version(spark, root)["writes"]) == 1
    assert _stored(spark, root) == want
    low, high = first + dt.timedelta(hours=10), first + dt.timedelta(hours=50)
    assert _stored(spark, root, start=low, end=high) == [r for r in want if low <= r[1] <= high]


def test_writers_that_meet_both_count(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.write_window(_rows(spark, [("A", JAN, 1)]), root, "2024-01-01", "2024-01-31 23:00")
    publish = files.publish_text

    def late(session, path, text):
        monkeypatch.setattr(files, "publish_text", publish)
        tables.write_window(_rows(spark, [("B", FEB, 2)]), root, "2024-02-01", "2024-02-29 23:00")
        return publish(session, path, text)

    monkeypatch.setattr(files, "publish_text", late)
    assert tables.write_window(_rows(spark, [("C", JAN, 3)]), root, "2024-01-01", "2024-01-31 23:00") == 3
    assert _stored(spark, root) == [("B", FEB, 2), ("C", JAN, 3)]


def test_compaction_gives_way_to_another_write(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    for month, at in ((1, JAN), (2, FEB)):
        tables.write_window(_rows(spark, [("A", at, month)]), root, f"2024-0{month}-01", f"2024-0{month}-28 23:00")
    index = versions._index

    def late(*args):
        monkeypatch.setattr(versions, "_index", index)
        tables.write_window(_rows(spark, [("B", JAN, 9)]), root, "2024-01-01", "2024-01-28 23:00")
        index(*args)

    monkeypatch.setattr(versions, "_index", late)
    with pytest.raises(versions.Conflict):
        tables.compact(spark, root)
    assert _stored(spark, root) == [("A", FEB, 2), ("B", JAN, 9)]


def test_new_columns_join_and_new_types_do_not(spark, tmp_path):
    root, rows = str(tmp_path / "t"), _rows(spark, [("001", JAN, 1)])
    tables.append_rows(rows, root, PARTITION_KEYS)
    tables.append_rows(rows.withColumnRenamed("n", "extra"), root, PARTITION_KEYS)
    got = tables.scan_partitioned(spark, root)
    assert got.columns == [*HOUR_KEYS, "n", "extra"]
    assert {(r.ELR_MIL, r.n, r.extra) for r in got.collect()} == {("001", 1, None), ("001", None, 1)}
    with pytest.raises(ValueError, match="string"):
        tables.append_rows(rows.withColumn("n", rows["n"].cast("string")), root, PARTITION_KEYS)
    with pytest.raises(ValueError, match="laid out"):
        tables.append_rows(rows, root, MONTH_KEYS)
    tables.write_window(rows.limit(0), root, JAN, JAN, PARTITION_KEYS)
    assert tables.scan_partitioned(spark, root).count() == 0


def test_foreign_folder_is_refused(spark, tmp_path):
    root, rows = str(tmp_path / "t"), _rows(spark, [("A", JAN, 1)])
    rows.write.parquet(root)
    with pytest.raises(ValueError, match="no versions"):
        tables.write_window(rows, root, "2024-01-01", "2024-01-31")
    assert spark.read.parquet(root).count() == 1


@pytest.mark.parametrize("keys", [MONTH_KEYS, PARTITION_KEYS])
def test_scan_lists_and_opens_only_wanted_files(spark, tmp_path, keys):
    """Every other file is damaged, so a footer read to plan the scan would fail."""
    root = str(tmp_path / "t é%")
    months = [dt.datetime(2024, m, 2, 3) for m in (1, 2, 3)]
    for at in months:
        tables.write_window(_rows(spark, [(s, at, at.month) for s in ("A b/%+", "B")]), root, at, at, keys)
    wanted = {"segment": "A b/%+", "time_filter": {"month": [2], "day": 2}}
    opened = versions.scan_versions(spark, root, **wanted).inputFiles()
    assert len(opened) == 1 and "month=2" in opened[0]
    for path in Path(root, "_data").rglob("*.parquet"):
        if "month=2" not in str(path) or (len(keys) > 2 and "ELR_MIL=B" in str(path)):
            path.write_bytes(b"not a table")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert _stored(spark, root, **wanted) == [("A b/%+", months[1], 2)]
    assert {r[0] for r in _stored(spark, root, segment="A b/%+", start=months[1], end=months[1])} == {"A b/%+"}
    assert _stored(spark, root, segment="none" if len(keys) > 2 else "A b/%+", time_filter={"month": 7}) == []


def test_vacuum_removes_what_no_version_lists(spark, tmp_path):
    root, rows = str(tmp_path / "t"), _rows(spark, [("A", JAN, 1)])
    for _ in range(3):
        tables.write_window(rows, root, JAN, JAN)
    assert versions.vacuum(spark, root) == []  # too young
    assert len(versions.vacuum(spark, root, hours=-1)) == 2
    assert len(list(Path(root, "_data").iterdir())) == 1 and versions.version_numbers(spark, root) == [3]
    assert _stored(spark, root) == [("A", JAN, 1)]


def test_version_file_holds_no_more_than_live_windows(spark, tmp_path):
    root, rows = str(tmp_path / "t"), _rows(spark, [("A", JAN, 1)])
    for day in (1, 2, 3, 2, 3, 1):
        at = dt.datetime(2024, 1, day)
        tables.write_window(rows, root, at, at + dt.timedelta(hours=23))
    text = files.read_text(spark, f"{root}/_versions/0000000006.json")
    assert len(json.loads(text)["writes"]) == 3


def test_dead_hours():
    windows = [[0, 9], None, [5, 20], [8, 8], [0, 3], [21, 30], [0, 40], [10, 12]]
    dead = versions.dead_hours([{"window": w} for w in windows])
    assert dead == [None, [(0, 40)], None, None, None, None, [(10, 12)], []]


def test_period_files_outside_the_calendar_are_not_opened(spark, tmp_path):
    for season, period in (("202324", "P01"), ("202324", "P02"), ("202425", "P01")):
        spark.range(2).write.parquet(str(tmp_path / f"delay_{season}_{period}.parquet"))
    calendar = spark.createDataFrame([("202324", "P02"), ("209900", "P01"), (None, "P01")], "season string, period string")
    got = tables.read_period_files(spark, str(tmp_path), "parquet", "id long", calendar)
    assert {Path(f).parent.name for f in got.inputFiles()} == {"delay_202324_P02.parquet"}
    assert [tuple(r) for r in got.distinct().orderBy("id").collect()] == [("202324", "P02", 0), ("202324", "P02", 1)]
    none = tables.read_period_files(spark, str(tmp_path), "parquet", "id long", calendar.limit(0))
    assert none.columns == got.columns and none.count() == 0


def test_month_of_a_window_is_written_by_several_tasks(spark, tmp_path):
    root, name = str(tmp_path / "t"), "spark.sql.adaptive.coalescePartitions.enabled"
    rows = [(f"S{i}", JAN, i) for i in range(40)]
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        tables.write_window(_rows(spark, rows), root, "2024-01-08", "2024-01-14 23:00")
    finally:
        spark.conf.set(name, before)
    assert len(list(Path(root).glob("_data/*/year=2024/month=1/part-*.parquet"))) > 1
    assert len(list(Path(root).glob("_data/*/*/*/"))) == spark.read.parquet(f"{root}/_index").count() == 1
    assert _stored(spark, root) == sorted(rows)
