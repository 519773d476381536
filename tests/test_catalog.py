"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import pytest
from oracle_check import connect, difference

import __spark_entry__ as registry
from sluicework.operators import quality
from sluicework.plans import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()
    assert catalog.queries().items() <= registry.queries().items()


@pytest.mark.parametrize("name", catalog.queries())
def test_query_equals_sql(spark, connection, name):
    result = registry.queries()[name](spark, SF_DIR)
    _, problem = difference(result, connection, registry.oracle_sql()[name])
    assert not problem


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["q_silver_plays", "q_plays_errors", "q_dedup_lineitem_dups"])
def test_key_sets_too_big_to_broadcast(spark, connection, name, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_BYTES", 400)
    monkeypatch.setattr(quality, "HEAVY_ROWS", 2)
    result = registry.queries()[name](spark, SF_DIR)
    _, problem = difference(result, connection, registry.oracle_sql()[name])
    assert not problem


@pytest.mark.parametrize("name", ["q_silver_plays", "q_plays_errors", "q_facts_redrop"])
@pytest.mark.parametrize(("partitions", "adaptive"), [("1", "true"), ("16", "false")])
def test_result_does_not_depend_on_partitioning(spark, connection, name, partitions, adaptive):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        result = registry.queries()[name](spark, SF_DIR)
        _, problem = difference(result, connection, registry.oracle_sql()[name])
        assert not problem
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
