"""Bounded-lookback window over a per-key timeline, split across tasks.

``lag`` over ``PARTITION BY key`` puts a whole key into one task; a hot card
with a third of all rows would then be a third of the work in one task. The
rules only need lag rows that lie within a fixed span before the current row
(one hour, twenty minutes), so each key's timeline is cut into time buckets
and every bucket also receives, as a halo, the rows of the last ``span``
seconds of the bucket before it. Within ``(key, bucket)`` the lags of home
rows are exact whenever the lag row lies within ``span`` seconds; otherwise
they are NULL. Cost: rows within ``span`` of a bucket end are duplicated
once, a factor of at most ``1 + span / bucket``.

One bucketed timeline can serve several windows: ``halo_buckets`` with
``repartition=True`` shuffles once by ``(key, bucket)``; later windows on
``(key, bucket, ...)`` reuse that partitioning (and a broadcast join in
between keeps it), so two rules share one shuffle of the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.timefn import epoch_seconds

BUCKET, HOME = "_bucket", "_home"


def halo_buckets(df: DataFrame, ts_col: str, span_s: int, bucket_s: int,
                 keys: Sequence[str] | None = None) -> DataFrame:
    """Copy each row to its time bucket, and to the next one when within ``span_s`` of its end.

    With ``keys``, the result is hash-partitioned by ``keys + bucket`` (one shuffle).
    """
    if span_s > bucket_s:
        raise ValueError("bucket must be at least as long as the lookback span")
    e = epoch_seconds(ts_col)
    home = F.floor(e / bucket_s).cast("bigint")
    nxt_start = (home + 1) * bucket_s
    buckets = F.when(e >= nxt_start - span_s, F.array(home, home + 1)).otherwise(F.array(home))
    x = df.withColumn(HOME, home).withColumn(BUCKET, F.explode(buckets))
    if keys:
        x = x.repartition(*keys, BUCKET)
    return x


def lags_in_buckets(x: DataFrame, keys: Sequence[str], order: Sequence[str],
                    lags: dict[str, tuple[str, int]]) -> DataFrame:
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    return x.withColumns({name: F.lag(c, n).over(w) for name, (c, n) in lags.items()})


def home_rows(x: DataFrame) -> DataFrame:
    return x.filter(F.col(BUCKET) == F.col(HOME)).drop(BUCKET, HOME)


def bounded_lags(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts_col: str,
                 span_s: int, bucket_s: int, lags: dict[str, tuple[str, int]],
                 bucketed: DataFrame | None = None) -> DataFrame:
    """Add lag columns ``name -> (column, offset)`` computed per key in ``order``.

    ``order`` must start with ``ts_col`` and be a total order. A lag value is
    guaranteed only where the lag row is at most ``span_s`` seconds older
    than the row; callers must test that span (the rules do). ``bucketed``
    may pass a frame already prepared by ``halo_buckets`` with a span of at
    least ``span_s``.
    """
    x = bucketed if bucketed is not None else halo_buckets(df, ts_col, span_s, bucket_s)
    return home_rows(lags_in_buckets(x, keys, order, lags))


def carried_lags(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts_col: str,
                 lags: dict[str, tuple[str, int]], buckets_s: Sequence[int]) -> DataFrame:
    """Add lag columns ``name -> (column, offset)``, exact at any distance, with buckets of any size.

    ``bounded_lags`` cannot cut a key's timeline finer than its lookback span; a key whose rows crowd into less than that
    stays in one task. Here a bucket's rows get their lags inside the bucket, except its first n rows (n: the
    largest offset): the rows before those are other first rows of the bucket and the last n rows of the buckets
    before. So the first and last n rows of every bucket, 2n rows however many it holds, go through the same
    scan once more with the next, larger bucket size, and at the end through a plain window per key. What is carried
    over each boundary is n rows, not a span of time, and no row is copied.

    ``order`` must start with ``ts_col`` and be a total order; ``buckets_s`` ascends, from the size that spreads the
    hottest key to one that leaves few buckets a key. The rows are shuffled once, by key and bucket.
    """
    if not buckets_s:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({name: F.lag(c, k).over(w) for name, (c, k) in lags.items()})
    n = max(k for _, k in lags.values())
    x = df.withColumn(BUCKET, F.floor(epoch_seconds(ts_col) / buckets_s[0]).cast("bigint")).repartition(*keys, BUCKET)
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    all_rows = Window.partitionBy(*keys, BUCKET)
    x = x.withColumns({**{name: F.lag(c, k).over(w) for name, (c, k) in lags.items()},
                       "_first": F.row_number().over(w), "_size": F.count(F.lit(1)).over(all_rows)})
    inside = x.filter(F.col("_first") > n).select(*df.columns, *lags)
    edges = x.filter((F.col("_first") <= n) | (F.col("_first") > F.col("_size") - n)).select(
        *df.columns, (F.col("_first") <= n).alias(f"_head{len(buckets_s)}"))
    heads = carried_lags(edges, keys, order, ts_col, lags, buckets_s[1:]).filter(f"_head{len(buckets_s)}")
    return inside.unionByName(heads.select(*df.columns, *lags))
