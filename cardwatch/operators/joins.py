"""Join helpers with an explicit size check before any broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_STATS: dict[tuple, object] = {}


def table_stat(df: DataFrame, agg, stats_key: tuple | None = None):
    """One exact aggregate of a base table (a single value), kept per ``stats_key``.

    Like catalog statistics: only for inputs that do not change (an input
    table path); without a key the aggregate always runs.
    """
    if stats_key is None or stats_key not in _STATS:
        v = df.agg(agg).first()[0]
        if stats_key is None:
            return v
        _STATS[stats_key] = v
    return _STATS[stats_key]


def table_rows(df: DataFrame, stats_key: tuple | None = None) -> int:
    return table_stat(df, F.count(F.lit(1)), None if stats_key is None else (*stats_key, "rows"))


class BroadcastCheck:
    """Decide once whether a dimension may be broadcast, from a bounding frame.

    ``bound`` is a frame whose row count times ``factor`` bounds the
    dimension (e.g. cards bound the card chain, factor 1; snapshot rows bound
    the terminal history, factor 2). Where that bound is too loose, the rows of
    ``exact``, the dimension itself, decide. Beyond ``max_rows`` the join stays a
    shuffle join, where AQE's skew handling splits a hot key of the fact side.
    """

    def __init__(self, bound: DataFrame, max_rows: int | None, factor: int = 1, stats_key: tuple | None = None,
                 exact: DataFrame | None = None):
        self._bound, self._max, self._factor, self._key, self._exact = bound, max_rows, factor, stats_key, exact
        self._ok: bool | None = None

    @property
    def ok(self) -> bool:
        if self._ok is None:
            self._ok = self._max is not None and (
                table_rows(self._bound, self._key) * self._factor <= self._max
                or (self._exact is not None
                    and table_rows(self._exact, self._key and (*self._key, "exact")) <= self._max))
        return self._ok


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner", *,
             check: BroadcastCheck | bool | None = None) -> DataFrame:
    """Join a fact to a dimension; broadcast the dimension only if the check passed."""
    ok = check.ok if isinstance(check, BroadcastCheck) else bool(check)
    return fact.join(F.broadcast(dim) if ok else dim, on, how)


def small_join(df: DataFrame, bounded: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a side bounded by construction (calendar days, 25 nations)."""
    return df.join(F.broadcast(bounded), on, how)


#: bits of a key filter: 16 MB of bitmaps whatever the number of keys; more keys only let more rows pass
KEY_FILTER_BITS = 1 << 27
_BITMAP_BITS = 1 << 15  # bits of one bitmap that Spark's aggregate builds


def _slots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), key), F.lit(bits)) for seed in (1, 2)]


def key_filter(keys: DataFrame, on: str, bits: int = KEY_FILTER_BITS) -> DataFrame:
    """A Bloom filter of the keys as rows (bucket, bitmap): two bits a key, at most ``bits`` bits in all."""
    slots = keys.filter(F.col(on).isNotNull()).select(F.explode(F.array(*_slots(F.col(on), bits))).alias("slot"))
    return slots.groupBy(F.floor(F.col("slot") / _BITMAP_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("slot") % _BITMAP_BITS).alias("bitmap"))


def may_join(fact: DataFrame, keys: DataFrame, on: str, bits: int = KEY_FILTER_BITS) -> DataFrame:
    """Rows of ``fact`` whose key may be among ``keys``: none that is there is lost, few others pass.

    The filter is broadcast (its size is bounded by ``bits``), so the fact is thinned out where it is scanned, before
    a join with ``keys`` moves it. ``keys`` itself may have any size.
    """
    found = key_filter(keys, on, bits)
    for slot in _slots(F.col(on), bits):
        f = found.select(F.col("bucket").alias("_bucket_no"), F.col("bitmap").alias("_bitmap"))
        place = slot % _BITMAP_BITS
        byte = F.conv(F.hex(F.substring(F.col("_bitmap"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
        hit = F.getbit(byte.cast("int"), (place % 8).cast("int")) == 1
        fact = fact.join(F.broadcast(f), (F.floor(slot / _BITMAP_BITS) == F.col("_bucket_no")) & hit, "left_semi")
    return fact


def not_in(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` for which SQL's ``on NOT IN (SELECT on FROM other)`` is true.

    Three-valued: with an empty ``other`` every row stays; otherwise a NULL on either side makes the test unknown,
    so rows with a NULL key go, and a NULL in ``other`` empties the result. Spark's own null-aware anti join only
    broadcasts ``other``; here it is a plain anti join on the non-NULL keys, of any size, and the two facts about
    ``other`` come in as scalar subqueries of the same plan (one partially aggregated pass, no job of its own).
    """
    keys = other.select(F.col(on))
    facts = keys.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(on).isNull(), 1)).alias("nulls"))).scalar()
    rest = df.join(keys.filter(F.col(on).isNotNull()), on, "left_anti")
    known = F.col(on).isNotNull() & (facts["nulls"] == 0)
    return rest.filter((facts["n"] == 0) | known)
