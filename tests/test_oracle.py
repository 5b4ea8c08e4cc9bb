"""Every query with an independent SQL text, compared value by value."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from flightlake.catalog import QUERIES, Workspace
from flightlake.ml.boosting import BoostSettings
from oracle import SQL as ORACLE

SF = "/root/testdata/sf0.001"
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert ROWS_ONLY == [
        "ml_gbt_cls", "ml_gbt_reg", "ml_gbt_residuals", "ml_gbt_tiers", "ml_perm_importance", "ml_top_drivers",
        "score_with_model",
    ]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_returns_rows(spark, monkeypatch, name):
    monkeypatch.setattr(Workspace, "settings", BoostSettings(iterations=3))
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    row = entry.entry(spark).first()
    assert (row["total_flights"], row["cancelled_flights"], row["on_time_arrivals"]) == (6000, 120, 4533)
