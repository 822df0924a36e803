"""Physical-plan properties the scale design relies on."""

import contextlib
import datetime as dt
import io
import re

from pyspark.sql import functions as F

from cardwatch.config import DEFAULT
from cardwatch.operators import rules
from cardwatch.operators.joins import BroadcastCheck, may_join
from cardwatch.operators.lookback import slice_of_run
from cardwatch.plans.context import Inputs
from conftest import SF0001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchanges(p: str) -> list[str]:
    return re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", p)


def test_amount_rule_shuffles_the_fact_once_by_card_and_bucket(spark):
    x = Inputs(spark, SF0001)
    p = plan(rules.amount_guess(x.tx, x.runs, DEFAULT))
    keys = exchanges(p)
    fact_keys = [k for k in keys if "card_num" in k]
    assert len(fact_keys) == 1 and "_bucket" in fact_keys[0]


def test_city_pair_window_is_split_by_bucket(spark):
    x = Inputs(spark, SF0001)
    p = plan(rules.city_hop_pair(x.tx, x.hist, x.runs, DEFAULT, True, x.hist_check))
    fact_keys = [k for k in exchanges(p) if "card_num" in k]
    assert fact_keys and all("_bucket" in k for k in fact_keys)


def test_chain_broadcast_only_under_the_bound(spark):
    x = Inputs(spark, SF0001)
    small = plan(rules.batch_joined(x.tx, x.chain_bl, True))
    assert "BroadcastHashJoin" in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan(rules.batch_joined(x.tx, x.chain_bl, False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in big or "ShuffledHashJoin" in big
    assert any("card_num" in k for k in exchanges(big))


def test_above_the_bound_rules_1_2_filter_the_fact_before_it_moves(spark):
    x, y = Inputs(spark, SF0001), Inputs(spark, SF0001, DEFAULT.with_(broadcast_max_rows=1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(y.batch_joined())
        assert "bitmap_construct_agg" in p and p.count("LeftSemi BuildRight") >= 2  # two bits a key, broadcast
        for rule in (rules.passport_alerts, rules.contract_alerts, rules.passport_contract_alerts):
            want = sorted(map(str, rule(x.batch_joined(), dt.date(2024, 2, 1)).collect()))
            assert want and sorted(map(str, rule(y.batch_joined(), dt.date(2024, 2, 1)).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_filter_loses_no_key_and_drops_most_others(spark):
    keys = spark.range(0, 3000).select((F.col("id") * 7).alias("k")).union(spark.sql("select cast(null as bigint)"))
    fact = spark.range(0, 21000).withColumnRenamed("id", "k")
    got = {r["k"] for r in may_join(fact, keys, "k").collect()}
    assert got >= set(range(0, 21000, 7)) and len(got) < 3010  # 6000 of 2 ** 27 bits are set
    small = {r["k"] for r in may_join(fact, keys, "k", 1 << 15).collect()}
    assert small >= set(range(0, 21000, 7)) and len(small) < 5000
    assert may_join(fact, keys.limit(0), "k").count() == 0


def test_broadcast_check_counts_the_dimension_where_its_bound_is_loose(spark):
    ten, three = spark.range(10), spark.range(3)
    assert not BroadcastCheck(ten, 4).ok
    assert BroadcastCheck(ten, 4, exact=three).ok and not BroadcastCheck(ten, 2, exact=three).ok


def test_rules_1_2_share_one_join(spark):
    x = Inputs(spark, SF0001)
    p = plan(rules.passport_contract_alerts(x.batch_joined(), dt.date(2024, 2, 1)))
    assert p.count("Scan parquet") >= 1
    assert len([k for k in exchanges(p) if "card_num" in k]) == 0  # broadcast: the fact is not shuffled


def test_warehouse_slice_prunes_partitions_and_pushes_filters(spark, scratch):
    x = Inputs(spark, SF0001)
    path = f"{scratch}/fact"
    x.tx.write.partitionBy("file_date").parquet(path)
    fact = spark.read.parquet(path)
    p = plan(slice_of_run(fact, dt.date(2024, 1, 10), DEFAULT.amount_cut_s))
    assert re.search(r"PartitionFilters: \[[^\]]*file_date", p)
    assert re.search(r"PushedFilters: \[[^\]]*transe_date", p)
    assert re.search(r"PushedFilters: \[[^\]]*opertype", p)
    assert "ReadSchema: struct<trans_id:string,transe_date:timestamp_ntz" in p
    got = slice_of_run(fact, dt.date(2024, 1, 10), DEFAULT.amount_cut_s).count()
    want = x.tx.filter((F.col("opertype") == "WITHDRAW")
                       & (F.col("transe_date") > dt.datetime(2024, 1, 9, 23, 40, 1))
                       & (F.col("transe_date") < dt.datetime(2024, 1, 11))).count()
    assert got == want


def test_report_shuffles_withdrawals_once_for_rules_3_and_4(spark):
    x = Inputs(spark, SF0001)
    p = plan(rules.city_amount_alerts(x.tx, x.hist, x.runs, x.chain_bl, DEFAULT, True))
    initial = p.split("== Initial Plan ==")[-1]
    fact_keys = [k for k in exchanges(initial) if "card_num" in k]
    assert len(fact_keys) == 1 and "_bucket" in fact_keys[0]


import pytest  # noqa: E402

import __spark_entry__ as E  # noqa: E402


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cross_or_nested_loop_joins(spark, name):
    p = plan(E.queries()[name](spark, SF0001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scans_read_only_needed_columns(spark):
    x = Inputs(spark, SF0001)
    p = plan(rules.amount_guess(x.tx, x.runs, DEFAULT))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", p)
    assert schemas and all("props" not in s for s in schemas)  # rule 4 never needs the terminal
