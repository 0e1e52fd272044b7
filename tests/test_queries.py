"""Every registered query against its SQL twin; the skew-sensitive ones again with every key hot and nothing broadcast."""

import pytest
from conftest import SF
from oracle import compare, connect

from tarnwork.queries import ORACLES, QUERIES

HOT = [
    "dups_retain_one", "dups_quarantine_all", "prev_row_change", "days_in_status", "sequence_in_key", "surrogate_dense", "join_asof_latest", "join_scd2_asof", "late_arriving_fact",
    "next_in_chain", "status_history", "stg_transfers", "identity_assign", "rule_table_build", "merge_upsert", "merge_on_hash", "merge_update_only", "scd2_apply", "cdc_apply",
    "schema_evolution", "load_dispatch", "merge_partitions", "dq_rules_rowlevel", "quarantine_rows", "dim_two_branch_scd2",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_all_have_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", HOT)
def test_matches_sql_when_every_key_is_hot(spark, con, settings, name):
    settings(hotRows=3, broadcastBytes=0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")  # the share of a key that counts as hot is 1/2000 here
    try:
        df = QUERIES[name](spark, SF)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        assert compare(df, con, ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
