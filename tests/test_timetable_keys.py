"""Timetable text of wide keys: stops in the order of their whole keys, trains and stations kept apart."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from segment_hours.functions import text
from segment_hours.operators.slices import in_order
from segment_hours.plans import fixtures as fx
from segment_hours.plans.queries import QUERIES

DAY = dt.datetime(1997, 3, 3)
# (order, line number, part, supplier): parts around the 10,000th, suppliers above 99, keys of seven digits and more
STOPS = [
    (1_000_001, 1, 5, 1),
    (1_000_001, 2, 9_999, 2),
    (1_000_001, 2, 10_000, 3),
    (1_000_001, 3, 1, 901),
    (1_000_001, 3, 2, 1),
    (1_000_009, 1, 7, 90_001),
    (1_000_009, 2, 7, 90_002),
    (1_000_009, 3, 7, 1_000_001),
    (1_000_009, 4, 7, 1_000_002),
    (12, 1, 7, 5),
    (12, 2, 8, 6),
]
SUPPLIERS = [1, 2, 3, 5, 6, 901, 90_001, 90_002, 1_000_001, 1_000_002]


def _minute(part, line):
    return (part * 7 + line * 13) % 1440


def test_wide_keys_keep_order_and_identity(spark, tmp_path):
    def write(name, rows):
        schema = fx.SCHEMAS[name]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    write("lineitem", [(o, p, s, n, 1.0, 1.0, 0.0, 0.0, "A", "F", DAY) for o, n, p, s in reversed(STOPS)])
    write("orders", [(o, 127, "O", 1.0, DAY, "5-LOW") for o in {s[0] for s in STOPS}])
    write("supplier", [(s, f"S{s}", 1, 0.0) for s in SUPPLIERS])
    want = []
    for order in {s[0] for s in STOPS}:
        own = sorted(s for s in STOPS if s[0] == order)
        for before, here in zip(own, own[1:]):
            if here[1] != 1:
                minute = _minute(before[2], before[1])
                want.append((f"{order:06d}", str(before[3] + 10000), str(here[3] + 10000), f"{minute // 60:02d}{minute % 60:02d}"))
    got = QUERIES["timetable_lines_to_hops"](spark, str(tmp_path)).collect()
    assert sorted((r.train_id, r.stanox_dep, r.stanox_arr, r.dep_time) for r in got) == sorted(want)


def test_fixed_codes_are_unique_and_read_back(spark):
    numbers = [0, 7, 999, 1000, 1001, 1061, 1062, 5000, 52 * 62 * 62 + 999]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    coded = df.select("n", text.fixed_code(F.col("n"), 3).alias("code"))
    rows = coded.select("n", "code", text.code_number(F.col("code"), 3).alias("back")).collect()
    assert all(len(r.code) == 3 and r.n == r.back for r in rows)
    assert len({r.code for r in rows}) == len(numbers)


def test_rows_are_numbered_in_order(spark):
    rows = [(i * 37 % 1000, None if i % 50 == 0 else i % 7) for i in range(1000)] * 2
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = in_order(df, ["a", "b"], "n").orderBy("n").collect()
    assert [(r.a, r.b) for r in got] == sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1]))  # repeated rows stay, null first
    assert len({r.n for r in got}) == len(rows)
    built = in_order(df, ["a", "b"], "n", [(F.col("a") * 2).alias("twice")])
    assert built.columns == ["n", "twice"] and [r.twice for r in built.orderBy("n").collect()] == [2 * r.a for r in got]
    assert in_order(df.limit(0), ["a"], "n").count() == 0


def test_codes_make_methods_that_are_compiled(spark, capsys):
    """The JVM leaves methods of more than 8,000 bytes to its interpreter."""
    numbers = spark.range(5).select(*[text.fixed_code(F.col("id") + i, 6).alias(f"c{i}") for i in range(6)])
    numbers.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert max(sizes) < 8000
