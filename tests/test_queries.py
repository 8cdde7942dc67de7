"""Every query against its reference SQL, and the driver contract."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import SF, difference, duck

from segment_hours.plans.oracles import ORACLES
from segment_hours.plans.queries import QUERIES

needs_tables = pytest.mark.skipif(not Path(SF).is_dir(), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_reference_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


@needs_tables
def test_classifiers_give_an_auc_per_label(spark):
    rows = QUERIES["gbt_auc"](spark, SF).collect()
    assert {r["label"] for r in rows} <= {f"INCIDENT_R{i}" for i in range(7)}
    assert rows and all(0.0 <= r["auc"] <= 1.0 for r in rows)


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
