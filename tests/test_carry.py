"""Lags carried over bucket boundaries equal the plain window; a crowded card spreads; exported files are in order."""

import glob
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardwatch.config import DEFAULT
from cardwatch.operators import report, rules
from cardwatch.operators.timeline import BUCKET, carried_lags
from cardwatch.schemas import ALERT_COLS, ALERTS
from helpers import D, T, digest, fact_rows


@pytest.mark.parametrize("seed", range(3))
def test_carried_lags_equal_the_plain_window(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):  # a crowded card, sparse ones, gaps of days and many ties in time
        card = rnd.choice(["hot", "hot", "hot", "a", "b", None])
        s = rnd.randrange(600) if card == "hot" and i % 4 else rnd.randrange(20 * 86400)
        rows.append((card, T(2024, 1, 1 + s // 86400, s % 86400 // 3600, s % 3600 // 60, s % 60), i, rnd.randrange(9)))
    df = spark.createDataFrame(rows, "card string, ts timestamp_ntz, id long, v int")
    lags = {"v1": ("v", 1), "v3": ("v", 3), "t2": ("ts", 2)}
    w = Window.partitionBy("card").orderBy("ts", "id")
    want = df.withColumns({k: F.lag(c, n).over(w) for k, (c, n) in lags.items()})
    for buckets in ((), (1,), (7, 100), (60, 3600, 86400)):
        got = carried_lags(df, ["card"], ["ts", "id"], "ts", lags, buckets)
        assert digest(got.select(*want.columns)) == digest(want), buckets


def test_a_crowded_hour_spreads(spark):
    hot = spark.range(6000).select(F.lit("hot").alias("card"), F.col("id"),
                                   F.timestamp_add("SECOND", (F.col("id") * 7 % 3600).cast("int"),
                                                   F.expr("TIMESTAMP_NTZ'2024-01-01 10:00:00'")).alias("ts"))
    x = carried_lags(hot, ["card"], ["ts", "id"], "ts", {"p": ("id", 1)}, (60, 86400))
    assert x.count() == 6000
    spread = hot.withColumn(BUCKET, F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 60)).repartition(8, "card", BUCKET)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 6000 / 3


def test_rules_by_the_carrying_scan(spark):
    rnd = random.Random(8)
    rows = [(f"{i:05d}", T(2024, 1, 2, 10 + i % 2, rnd.randrange(60), rnd.randrange(60)), rnd.choice(["C1", "C2"]), "WITHDRAW",
             rnd.randrange(50), rnd.choice(["REJECT", "REJECT", "REJECT", "SUCCESS"]), f"T{i % 3}") for i in range(300)]
    fact = fact_rows(spark, rows)
    hist = spark.createDataFrame([(f"T{k}", "ATM", c, "a", D(2024, 1, 1), T(2999, 12, 31, 23, 59, 59), 0)
                                  for k, c in enumerate("ABA")],
                                 "terminal_id string, terminal_type string, terminal_city string, "
                                 "terminal_address string, effective_from date, effective_to timestamp_ntz, deleted_flg int")
    runs = fact.select(F.col("file_date").alias("run_date")).distinct()
    carry = DEFAULT.with_(carry_buckets_s=(30, 600))
    for f in (lambda c: rules.city_hop_pair(fact, hist, runs, c, True, True), lambda c: rules.amount_guess(fact, runs, c)):
        want = f(DEFAULT)
        assert want.count() > 0 and digest(f(carry)) == digest(want)


def test_exported_files_are_the_sorted_report(spark, scratch):
    rnd = random.Random(1)
    rows = [(D(2024, 1, rnd.randint(1, 28)), f"P{rnd.randrange(300)}", "f", "+7", rnd.choice("1234"), D(2024, 2, 1))
            for _ in range(3000)]
    out = os.path.join(scratch, "rep")
    report.export(spark.createDataFrame(rows, ALERTS), out, order=report.EXPORT_ORDER, max_records=200)
    files = sorted(glob.glob(os.path.join(out, "*.csv")))
    got = []
    for f in files:
        head, *lines = open(f).read().splitlines()
        assert head.split(",") == ALERT_COLS and len(lines) <= 200
        got += [tuple(x.split(",")) for x in lines]
    assert len(files) > 10 and len(got) == 3000
    key = [ALERT_COLS.index(c) for c in report.EXPORT_ORDER]
    assert got == sorted(got, key=lambda r: [r[k] for k in key])
    assert digest(report.read_export(spark, out).select(*ALERT_COLS)) == digest(spark.createDataFrame(rows, ALERTS))
