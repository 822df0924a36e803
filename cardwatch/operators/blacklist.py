"""Insert-only passport blacklist.

A feed row is new when its passport is not yet in the table; new rows take
the batch date as ``entry_dt`` (the date written in the row is kept as
``source_entry_dt``). Copies inside one feed are all inserted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.config import Semantics
from cardwatch.operators.joins import not_in


def new_entries(feed: DataFrame, passport: str = "passport_num", date_col: str = "file_date") -> DataFrame:
    """All days at once: rows of the first feed day of each passport.

    Equal to the day-by-day fold when feeds come in date order. The first day
    per passport is a partial aggregation (a hot passport collapses map-side);
    the join back is on ``(passport, day)``, so only the first day's copies
    of a hot passport meet in one join key, where AQE splits them.
    """
    f = feed.filter(F.col(passport).isNotNull())
    first = f.groupBy(passport).agg(F.min(date_col).alias("_first"))
    j = f.join(first, (f[passport] == first[passport]) & (f[date_col] == first["_first"]), "left_semi")
    return j


def table_from_new(new: DataFrame, passport: str = "passport_num", date_col: str = "file_date",
                   source_col: str | None = "source_entry_dt") -> DataFrame:
    cols = [F.col(passport).alias("passport_num"), F.col(date_col).alias("entry_dt")]
    if source_col and source_col in new.columns:
        cols.append(F.col(source_col))
    return new.select(*cols)


def merge_day(table: DataFrame, feed: DataFrame, day, semantics: Semantics = Semantics.INTENDED,
              passport: str = "passport_num") -> tuple[DataFrame, DataFrame]:
    """One feed against the current table; returns ``(new_rows, table_rows_to_append)``.

    The parity preset is SQL's ``NOT IN``; the intended one leaves NULL passports out (the load keeps them as
    rejected rows).
    """
    d = F.lit(day).cast("date")
    known = table.select(F.col("passport_num").alias(passport))
    if semantics == Semantics.PARITY:
        new = not_in(feed, known, passport)
    else:
        new = feed.filter(F.col(passport).isNotNull()).join(
            known.filter(F.col(passport).isNotNull()), passport, "left_anti")
    src = [F.col("source_entry_dt")] if "source_entry_dt" in new.columns else []
    rows = new.select(F.col(passport).alias("passport_num"), d.alias("entry_dt"), *src)
    return new, rows
