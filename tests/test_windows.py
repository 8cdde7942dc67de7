"""Windows that share a partition, damaged periods, and the shared folder."""

from __future__ import annotations

import datetime as dt
import zipfile

import pytest

from segment_hours.operators.spine import hourly_spine
from segment_hours.session import checkpoint_root
from segment_hours.sources import archives, tables
from segment_hours.streaming.incidents import run_chunks, weekly_windows


def _spine(spark, start, end):
    return hourly_spine(spark.createDataFrame([("AAA_0",)], "ELR_MIL string"), start, end)


@pytest.mark.parametrize(
    "windows",
    [
        [("2024-01-01", "2024-01-15 23:00:00"), ("2024-01-16", "2024-01-31 23:00:00")],
        list(weekly_windows("2024-01-01", "2024-01-31 23:00:00")),
    ],
)
def test_windows_of_one_month_equal_one_run(spark, tmp_path, windows):
    root = str(tmp_path / "spine")
    run_chunks(lambda a, b: tables.write_window(_spine(spark, a, b), root, a, b), windows)
    run_chunks(lambda a, b: tables.write_window(_spine(spark, a, b), root, a, b), windows[-1:])
    whole = _spine(spark, "2024-01-01", "2024-01-31 23:00:00")
    got = tables.scan_partitioned(spark, root).select(*whole.columns)
    assert got.count() == 744
    assert got.exceptAll(whole).isEmpty()


def test_weekly_windows_start_on_sundays():
    windows = list(weekly_windows("2024-01-01", "2024-01-20 05:00:00"))
    assert windows[0] == (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 6, 23))
    assert windows[1][0] == dt.datetime(2024, 1, 7)
    assert windows[-1][1] == dt.datetime(2024, 1, 20, 5)


def test_damaged_period_larger_than_a_batch_gives_no_rows(spark, tmp_path):
    names = ("201920_P01.zip", "201920_P02.zip")
    lines = "a,b\n" + "".join(f"{i},{i * 7919 % 10007}\n" for i in range(120_000))
    for name in names:
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_STORED) as archive:
            archive.writestr("period.csv", lines)
    damaged = tmp_path / names[0]
    data = bytearray(damaged.read_bytes())
    data[len(data) - 2000] ^= 1
    damaged.write_bytes(bytes(data))
    raw = archives.read_delay_archives(spark, str(tmp_path), names=[*"ab", *archives.DELAY_COLUMNS][:37])
    assert [(r["period"], r["problem"]) for r in raw.orderBy("period").collect()] == [("P01", raw.first()["problem"]), ("P02", "2 columns, not 37")]
    assert "damaged" in raw.first()["problem"]


def test_table_of_a_failed_write_is_built_again(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    with pytest.raises(Exception, match="division|DIVIDE"):
        tables.get_or_build(spark, path, lambda: spark.range(5).selectExpr("assert_true(id < 3, 'division') as x"))
    assert tables.get_or_build(spark, path, lambda: spark.range(5)).count() == 5


def test_table_of_another_tool_is_not_replaced(spark, tmp_path):
    path = tmp_path / "t.parquet"
    tables.write_table(spark.range(3), str(path))
    (path / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="left as it is"):
        tables.get_or_build(spark, str(path), lambda: spark.range(5))
    assert spark.read.parquet(str(path)).count() == 3


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError):
        checkpoint_root(Session())
