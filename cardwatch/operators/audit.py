"""Load audit: rows added, updated and deleted per table and batch day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.config import AUDIT_BLACKLIST, AUDIT_FACT, AUDIT_TERMINALS
from cardwatch.operators.scd2 import DELETED, NEW, RETURNED, UPDATED

def _null():
    return F.lit(None).cast("bigint")


def fact_counts(fact: DataFrame, date_col: str = "file_date") -> DataFrame:
    return fact.groupBy(F.col(date_col).alias("upload_dt")).agg(
        F.lit(AUDIT_FACT).alias("table_name"), F.count(F.lit(1)).alias("new_rows"),
        _null().alias("updated_rows"), _null().alias("deleted_rows"))


def blacklist_counts(feed: DataFrame, new: DataFrame, date_col: str = "file_date") -> DataFrame:
    """New passports per feed day (0 when the feed held only known ones)."""
    days = feed.select(F.col(date_col).alias("upload_dt")).distinct()
    n = new.groupBy(F.col(date_col).alias("upload_dt")).agg(F.count(F.lit(1)).alias("new_rows"))
    return days.join(n, "upload_dt", "left").select(
        "upload_dt", F.lit(AUDIT_BLACKLIST).alias("table_name"),
        F.coalesce("new_rows", F.lit(0)).cast("bigint").alias("new_rows"),
        _null().alias("updated_rows"), _null().alias("deleted_rows"))


def terminal_counts(snapshots: DataFrame, changes: DataFrame, date_col: str = "snap_date") -> DataFrame:
    """New (returns included), updated and deleted terminals per snapshot day."""
    days = snapshots.select(F.col(date_col).alias("upload_dt")).distinct()
    c = changes.groupBy(F.col("change_date").alias("upload_dt")).agg(
        F.sum(F.col("change").isin(NEW, RETURNED).cast("bigint")).alias("new_rows"),
        F.sum((F.col("change") == UPDATED).cast("bigint")).alias("updated_rows"),
        F.sum((F.col("change") == DELETED).cast("bigint")).alias("deleted_rows"))
    return days.join(c, "upload_dt", "left").select(
        "upload_dt", F.lit(AUDIT_TERMINALS).alias("table_name"),
        *[F.coalesce(c_, F.lit(0)).cast("bigint").alias(c_) for c_ in ("new_rows", "updated_rows", "deleted_rows")])


def render(audit: DataFrame) -> DataFrame:
    """Text view where a count does not apply ('not exists')."""
    return audit.select("upload_dt", "table_name", *[
        F.coalesce(F.col(c).cast("string"), F.lit("not exists")).alias(c)
        for c in ("new_rows", "updated_rows", "deleted_rows")])
