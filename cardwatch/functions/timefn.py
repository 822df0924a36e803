"""Time arithmetic on TIMESTAMP_NTZ columns, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwatch.config import SENTINEL_TS


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def seconds_between(later, earlier) -> Column:
    """Whole seconds from ``earlier`` to ``later`` (exact on whole-second values)."""
    return F.timestamp_diff("SECOND", _c(earlier), _c(later))


def epoch_seconds(ts) -> Column:
    return F.timestamp_diff("SECOND", _epoch(), _c(ts))


def day_start(date_col) -> Column:
    """Midnight of a DATE as TIMESTAMP_NTZ."""
    return _c(date_col).cast("timestamp_ntz")


def date_plus_seconds(date_col, seconds) -> Column:
    s = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_add("SECOND", s, day_start(date_col))


def cut_ts(run_date, cut_seconds) -> Column:
    """Lookback bound of a run: the day before ``run_date`` at the cut time (seconds, int or column)."""
    return date_plus_seconds(F.date_sub(_c(run_date), 1), cut_seconds)


def sentinel_ts() -> Column:
    return F.lit(SENTINEL_TS.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
