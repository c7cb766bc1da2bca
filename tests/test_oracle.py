"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from faultline.queries import ORACLES, QUERIES
from tests.oracle_check import DATA, compare, connect

SMALL = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")

CHECKED = (
    "silver_records", "dq_profile", "dedup_latest", "monthly_kpis", "priority_summary", "team_summary",
    "dashboard_summary", "operational_kpi_summary", "daily_trends", "annual_ola", "risk_summary", "forecast_history",
    "forecast_summary", "recommendations", "filter_options", "publish_forecast", "contract_violations", "contract_report",
    "trend_weekly", "top_teams", "reconcile_report", "bench_summary", "synthetic_incidents", "trend_partitions",
    "upsert_state",
)


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SMALL) is None


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
