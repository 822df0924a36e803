"""Counts measured on the fixture views (FIXTURES.md, golden counts at sf0.001)."""

import pytest

import __spark_entry__ as E
from conftest import SF0001

GOLDEN = {
    "fact_transactions": 1000,
    "dim_clients": 38,
    "dim_accounts": 75,
    "blacklist_table": 5,
    "fraud_passport": 338,
    "fraud_contract": 287,
    "lookback_1h": 1348,
    "lookback_20m": 1348,
    "terminal_join_asof": 958,
    "terminal_join_all": 5518,
    "city_hop_rep": 294,
    "city_hop_rep_all": 2259,
    "city_hop_pair": 328,
    "city_hop_pair_all": 2979,
    "amount_guess_pattern": 7,
    "amount_guess": 0,
    "amount_guess_literal": 7,
    "scd2_history": 41,
    "scd2_new": 18,
    "scd2_resurrected": 8,
    "scd2_deleted": 11,
    "scd2_updated": 12,
}


@pytest.mark.parametrize("name,expected", sorted(GOLDEN.items()))
def test_golden_count(spark, name, expected):
    assert E.queries()[name](spark, SF0001).count() == expected


def test_tombstones_and_open(spark):
    from pyspark.sql import functions as F
    h = E.queries()["scd2_history"](spark, SF0001)
    assert h.filter(F.col("deleted_flg") == 1).count() == 11
    assert E.queries()["scd2_current"](spark, SF0001).count() == 7
