"""The transaction join splits a hot account at run time, without losing a row."""

from __future__ import annotations

import pytest

from tellerframe.registry.bank import Bank
from tests.skewed_tables import write_skewed

# thresholds small enough for small tables; no broadcast, so that the join shuffles
TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture
def tight(spark):
    before = {key: spark.conf.get(key, None) for key in TIGHT}
    for key, value in TIGHT.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_account_is_split(tight, tmp_path):
    folder = write_skewed("/root/testdata/sf0.01", tmp_path / "skewed")
    fact = Bank(tight, folder).fact
    split = fact.collect()
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    tight.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert sorted(r.transaction_id for r in split) == sorted(r.transaction_id for r in Bank(tight, folder).fact.collect())
    finally:
        tight.conf.unset("spark.sql.adaptive.skewJoin.enabled")
