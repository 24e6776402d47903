"""Every query against its SQL, on the smallest tables and on skewed ones with nulls."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tellerframe.registry.oracles import ORACLES
from tellerframe.registry.queries import QUERIES
from tests.check_oracles import connect, differences
from tests.skewed_tables import write_skewed

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    return write_skewed(SMALL, tmp_path_factory.mktemp("skewed"))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_skewed(spark, skewed, name):
    assert differences(QUERIES[name](spark, skewed), connect(skewed), ORACLES[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("q", "kpi", "stg", "dim", "fact", "scd2"))])
def test_given(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []
