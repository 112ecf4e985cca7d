"""Every registered query against its SQL statement, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, differences
from tierwise.plans import registry

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# The gates of these need batches of some size to let anything through.
GATED = {
    name
    for name in registry.queries()
    if name.startswith(("pipeline_", "stored_", "catalog_", "dq_pipeline")) or name == "dq_gate"
}

QUERIES = registry.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connections():
    return {sf_dir: connect(sf_dir) for sf_dir in (SMALL, LARGER)}


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connections, name):
    sf_dir = LARGER if name in GATED else SMALL
    assert differences(QUERIES[name](spark, sf_dir), connections[sf_dir], ORACLE[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
