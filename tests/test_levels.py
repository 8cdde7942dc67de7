"""Levels as a table: numbering, encoding of many, frequent, null and unknown values."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from segment_hours.operators import incidents, levels, model


def _plain(rows, columns, drop_first=True):
    """Feature numbers of rows ({column: value}) by sorting all values."""
    known = []
    for c in sorted(columns):
        own = sorted({str(r[c]) for r in rows if r[c] is not None})
        known += [(c, v) for v in own[1 if drop_first else 0 :]]
    place = {key: i for i, key in enumerate(known)}
    return [sorted(place[c, str(r[c])] for c in columns if (c, str(r[c])) in place) for r in rows]


@pytest.mark.parametrize("drop_first", [True, False])
def test_codes_like_sorted_values(spark, drop_first):
    rows = [{"id": i, "_v0": i % 4, "b": None if i % 5 == 0 else f"x{i % 7}", "a": "hot" if i % 3 else f"r{i}", "n": i % 2} for i in range(400)]
    df = spark.createDataFrame(rows, "id long, _v0 long, b string, a string, n int").repartition(5)
    columns = ["b", "a", "n"]
    got = levels.encode_levels(df, columns, drop_first=drop_first, ranges=3)
    assert got.columns == ["id", "_v0", "indices"]
    assert {r["id"]: r["indices"] for r in got.collect()} == dict(enumerate(_plain(rows, columns, drop_first)))


def test_rare_levels_take_the_shuffled_way(spark, monkeypatch):
    monkeypatch.setattr(levels, "HOT_SHARE", 0.2)  # only the value with a third of all rows is frequent
    rows = [{"id": i, "k": "hot" if i % 3 == 0 else None if i % 7 == 0 else f"r{i % 50}"} for i in range(600)]
    df = spark.createDataFrame(rows, "id long, k string")
    got = levels.encode_levels(df, ["k"])
    assert {r["id"]: r["indices"] for r in got.collect()} == dict(enumerate(_plain(rows, ["k"])))


def test_a_hundred_thousand_levels(spark):
    n = 100_000
    df = spark.range(3 * n).select("id", F.format_string("v%06d", F.col("id") % n).alias("k"), F.lit("one").alias("c"))
    table = levels.level_table(df, ["k", "c"])
    assert levels.feature_count(table) == n - 1
    got = levels.encode_levels(df, ["k", "c"], table)
    wrong = got.where(F.when(F.col("id") % n == 0, F.size("indices") != 0).otherwise(F.col("indices") != F.array((F.col("id") % n - 1).cast("int"))))
    assert got.count() == 3 * n and wrong.isEmpty()
    # The driver is not sent so many.
    with pytest.raises(ValueError, match="encode_levels"):
        model.category_levels(df, ["k"], most=1_000)


def test_unknown_repeated_and_no_rows(spark):
    train = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("c", 2)], "k string, v int")
    table = levels.level_table(train, ["k"])
    new = spark.createDataFrame([("c", 1), ("zz", 2), (None, 3), ("a", 4), ("c", 1), ("", 5)], "k string, v int")
    got = levels.encode_levels(new, ["k"], table)
    assert sorted((r["v"], r["indices"]) for r in got.collect()) == [(1, [1]), (1, [1]), (2, []), (3, []), (4, []), (5, [])]
    assert levels.encode_levels(train.limit(0), ["k"]).count() == 0
    assert levels.level_table(train.limit(0), ["k"]).count() == 0
    assert levels.encode_levels(train.select("k"), ["k"]).columns == ["indices"]
    assert [r["indices"] for r in levels.encode_levels(train, []).collect()] == [[]] * 4
    with pytest.raises(ValueError, match="named like"):
        levels.encode_levels(train, ["k"], name="v")


def test_vectors_fit_a_model(spark):
    rows = [(f"k{i % 5}", float(i % 5 == 2)) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, label double")
    table = levels.level_table(df, ["k"])
    coded = levels.sparse_vectors(levels.encode_levels(df, ["k"], table), levels.feature_count(table))
    fit = LogisticRegression(regParam=0.01).fit(coded)
    assert fit.coefficients.argmax() == 1 and coded.columns == ["label", "features"]


def test_codes_beyond_the_columns_of_a_plan_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(incidents, "MOST_COLUMNS", 2)
    log = spark.createDataFrame([(f"R{i}",) for i in range(3)], "INCIDENT_REASON string")
    with pytest.raises(ValueError, match="over 2 incident codes"):
        incidents.incident_counts(log, None)
