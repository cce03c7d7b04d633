"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from revmap.plans.oracle import ORACLE
from revmap.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    # Those of the training-data folder, if it is there, are tested beside it.
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_gives_one_row(spark):
    assert entry(spark).count() == 1


@pytest.mark.parametrize(
    "name",
    [
        "mapped_view",
        "mapped_view_month",
        "mapped_view_flags",
        "mapping_master_view",
        "mapped_inner",
        "unmapped_revenue",
        "unmapped_totals",
        "unused_mappings",
        "merged_report",
        "recon_diff",
        "manual_revenue",
        "manual_revenue_in_force",
        "missing_ids",
    ],
)
def test_query_matches_sql_without_broadcasts(spark, con, name):
    """The way large inputs go: shuffled joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
