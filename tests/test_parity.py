"""Every catalogued query against its SQL, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
import compare
from scfsweep.plans import catalog, oracles

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert compare.difference(result, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    if os.path.isdir(entry.SMOKE_DIR):
        assert entry.entry(spark).columns == ["run_id", "channel_id", "u", "n1_nf_u", "n1_nf_alpha"]
