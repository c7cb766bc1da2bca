"""Registered queries of the package against their SQL."""

from __future__ import annotations

import os

import pytest

from faultline.llm.queries import ORACLES, QUERIES
from tests.oracle_check import DATA, compare, connect

SMALL = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SMALL), name, QUERIES[name], ORACLES[name], SMALL) is None
