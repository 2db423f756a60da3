"""Every registered query of the telemetry jobs agrees with its SQL on the whole of the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry
from registry.oracle import ORACLE
from registry.queries import QUERIES
from tests import compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees(spark, name):
    pytest.importorskip("duckdb")
    assert compare.difference(spark, name, SF_DIR) == ""
