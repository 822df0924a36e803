"""Run dates and lookback slices.

A transactions batch for day ``R`` looks at every withdrawal after the cut
time of day ``R-1`` (23:00:01 or 23:40:01) and, bounded, before ``R+1``.
Such a slice covers at most two calendar days, so a row belongs to the run
of its own day and possibly to the run of the next day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.timefn import cut_ts, day_start
from cardwatch.operators.joins import small_join


def run_dates(fact: DataFrame, date_col: str = "file_date") -> DataFrame:
    """Distinct batch days (bounded by the calendar: broadcast-safe)."""
    return fact.select(F.col(date_col).alias("run_date")).distinct()


def in_slice(ts: Column, run_date: Column, cut_s) -> Column:
    """``ts`` lies in the lookback slice of ``run_date`` (strict cut, bounded above)."""
    return (ts > cut_ts(run_date, cut_s)) & (ts < day_start(F.date_add(run_date, 1)))


def candidate_runs(ts: Column) -> Column:
    """The two runs a timestamp may belong to: its day and the next one."""
    d = F.to_date(ts)
    return F.array(d, F.date_add(d, 1))


def expand_runs(df: DataFrame, runs: DataFrame, cut_s: int, ts_col: str = "transe_date") -> DataFrame:
    """Copy each row once per run whose slice contains it (at most twice)."""
    ts = F.col(ts_col)
    out = df.withColumn("run_date", F.explode(candidate_runs(ts)))
    out = out.filter(in_slice(ts, F.col("run_date"), cut_s))
    return small_join(out, runs, "run_date", "left_semi")


def runs_covering(df: DataFrame, runs: DataFrame, cut_s, first_ts: str, last_ts: str) -> DataFrame:
    """Runs whose slice contains both ``first_ts`` and ``last_ts`` of a row.

    Used when a condition spans several rows of one card (a lag row and the
    current row): the pair is seen by run ``R`` exactly when both ends lie in
    ``R``'s slice, because a slice is a contiguous time interval.
    """
    out = df.withColumn("run_date", F.explode(candidate_runs(F.col(last_ts))))
    out = out.filter(in_slice(F.col(first_ts), F.col("run_date"), cut_s)
                     & in_slice(F.col(last_ts), F.col("run_date"), cut_s))
    return small_join(out, runs, "run_date", "left_semi")


def slice_of_run(fact: DataFrame, run_date, cut_s: int, opertype: str | None = "WITHDRAW",
                 ts_col: str = "transe_date", date_col: str = "file_date") -> DataFrame:
    """Lookback slice for one run (incremental mode); prunes to two partitions."""
    r = F.lit(run_date).cast("date")
    out = fact.filter((F.col(date_col) >= F.date_sub(r, 1)) & (F.col(date_col) <= r))
    if opertype is not None:
        out = out.filter(F.col("opertype") == opertype)
    return out.filter(in_slice(F.col(ts_col), r, cut_s)).withColumn("run_date", r)
