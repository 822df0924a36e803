"""Warehouse-shaped views projected from the generic test tables.

The same formulas are written as DuckDB SQL in ``cardwatch.plans.oracle`` so
both engines see identical inputs. Everything here is a lazy DataFrame over
the Parquet tables: the views grow with the data.
"""

from __future__ import annotations

import datetime as _dt
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.timefn import day_start
from cardwatch.operators.joins import small_join

# Fixed values of the fixture projection.
DAY0 = _dt.date(2024, 1, 1)
TX_DAY_OFFSET_S = 23 * 3600 + 45 * 60     # operations start at 23:45:00 ...
TX_SPREAD_DIV = 48                          # ... and spread over the next 30 minutes
SNAPSHOT_DAYS = 10
N_CITIES = 25
REJECT_EVENT_TYPES = ("error", "click", "view")


_READS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; the relation is resolved once per session and path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per_session = _READS.setdefault(spark, {})
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]


def _stat(spark: SparkSession, sf_dir: str, name: str, agg: F.Column):
    """Exact single-value aggregate of an input table (count, max key), kept per path."""
    from cardwatch.operators.joins import table_stat
    return table_stat(read_table(spark, sf_dir, name), agg, (sf_dir, name, str(agg)))


def _day0() -> F.Column:
    return F.lit(DAY0)


def _client_id(key: F.Column) -> F.Column:
    return F.when(key % 3 == 0, F.concat(F.lit("VIP-"), key.cast("string"))).otherwise(key.cast("string"))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact transactions from ``events`` (FIXTURES.md §3)."""
    ev = read_table(spark, sf_dir, "events")
    n_terminals = F.lit(_stat(spark, sf_dir, "supplier", F.count(F.lit(1))))
    micros = F.expr("hour(ts) * 3600000000L + minute(ts) * 60000000L"
                    " + cast(extract(SECOND FROM ts) * 1000000 as bigint)")
    offset_s = F.lit(TX_DAY_OFFSET_S) + F.floor(F.floor(micros / TX_SPREAD_DIV) / 1000000).cast("bigint")
    transe_date = F.timestamp_add("SECOND", offset_s, day_start(F.to_date("ts")))
    k = F.get_json_object("props", "$.k").cast("bigint")
    return ev.select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("trans_id"),
        transe_date.alias("transe_date"),
        F.lpad(F.col("user_id").cast("string"), 16, "0").alias("card_num"),
        F.when(F.col("event_id") % 10 == 0, "PAYMENT").otherwise("WITHDRAW").alias("opertype"),
        F.col("value").cast("decimal(18,2)").alias("amt"),
        F.when(F.col("event_type").isin(*REJECT_EVENT_TYPES), "REJECT").otherwise("SUCCESS").alias("oper_result"),
        (k % n_terminals).cast("string").alias("terminal"),
    ).withColumn("file_date", F.to_date("transe_date"))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.lpad(F.col("c_custkey").cast("string"), 16, "0").alias("card_num"),
        F.floor(F.col("c_custkey") / 2).cast("bigint").cast("string").alias("account"),
        _day0().alias("create_dt"),
        F.lit(None).cast("date").alias("update_dt"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    acc = F.floor(F.col("c_custkey") / 2).cast("bigint")
    client_key = F.floor(F.col("c_custkey") / 4).cast("bigint")
    return c.select(
        acc.cast("string").alias("account"),
        F.date_add(_day0(), ((acc * 13) % 90).cast("int")).alias("valid_to"),
        _client_id(client_key).alias("client"),
        _day0().alias("create_dt"),
        F.lit(None).cast("date").alias("update_dt"),
    ).dropDuplicates(["account"])


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    max_key = _stat(spark, sf_dir, "customer", F.max("c_custkey"))
    k = F.col("c_custkey")
    # nation: 25 rows by the schema's definition, a fixed-size broadcast.
    j = small_join(c.filter(k <= F.lit(max_key // 4)), nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return j.select(
        _client_id(k).alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.when(k % 50 == 7, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("patronymic"),
        F.date_add(F.lit(_dt.date(1960, 1, 1)), ((k * 37) % 14000).cast("int")).alias("date_of_birth"),
        F.concat(F.lit("P"), F.lpad(k.cast("string"), 10, "0")).alias("passport_num"),
        F.when(k % 5 < 2, F.lit(None).cast("date"))
         .otherwise(F.date_add(_day0(), ((k * 7) % 60).cast("int"))).alias("passport_valid_to"),
        F.concat(F.lit("+7 "), F.lpad(k.cast("string"), 10, "0")).alias("phone"),
        _day0().alias("create_dt"),
        F.lit(None).cast("date").alias("update_dt"),
    )


def bl_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blacklist feed rows: (passport_num, source_date text, file_date)."""
    c = read_table(spark, sf_dir, "customer")
    max_key = _stat(spark, sf_dir, "customer", F.max("c_custkey"))
    k = F.col("c_custkey")
    base = c.filter((k <= F.lit(max_key // 4)) & (k % 7 == 3)).select(
        F.concat(F.lit("P"), F.lpad(k.cast("string"), 10, "0")).alias("passport_num"),
        F.date_add(_day0(), (k % 30).cast("int")).alias("first_day"),
    )
    out = base.select("passport_num", F.explode(F.array(F.lit(0), F.lit(1))).alias("rep"), "first_day")
    out = out.withColumn("file_date", F.date_add("first_day", F.col("rep")))
    return out.select(
        "passport_num",
        F.concat(F.date_format("file_date", "yyyy-MM-dd"), F.lit(" 00:00:00")).alias("source_date"),
        "file_date",
    )


def snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily full terminal snapshots over ten days, built from ``supplier``."""
    s = read_table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    d = F.col("day")
    out = s.select("s_suppkey", "s_nationkey", F.explode(F.sequence(F.lit(0), F.lit(SNAPSHOT_DAYS - 1))).alias("day"))
    out = out.filter(~((key * 3 + d) % 8).isin(0, 1))
    return out.select(
        F.date_add(_day0(), d).alias("snap_date"),
        key.cast("string").alias("terminal_id"),
        F.when(key % 2 == 0, "ATM").otherwise("POS").alias("terminal_type"),
        F.concat(F.lit("NATION_"), ((F.col("s_nationkey") + F.floor((key + d) / 5)) % N_CITIES)
                 .cast("bigint").cast("string")).alias("terminal_city"),
        F.concat(F.lit("addr-"), key.cast("string")).alias("terminal_address"),
    )
