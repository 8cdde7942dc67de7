"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb

SF = "/root/testdata/sf0.001"


def duck(sf):
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if value != value else (round(value, 9) + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(row[c]) for c in names) for row in df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = result.fetchall()
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql):
    """None where equal, else a short description."""
    names, got = spark_rows(df)
    wanted_names, wanted = duck_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if got != wanted:
        return f"{got.total()} rows != {wanted.total()}; extra {list((got - wanted).items())[:2]}; missing {list((wanted - got).items())[:2]}"
    return None
