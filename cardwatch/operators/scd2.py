"""Versioned (SCD type 2) history of a keyed dimension fed by full snapshots.

History rows: key, attributes, ``effective_from`` (date), ``effective_to``
(timestamp; the sentinel while open) and ``deleted_flg`` (1 for a tombstone
that records the key's disappearance with its last attributes).

For a snapshot ``S`` of day ``D`` the merge does, in this order:
new keys (absent, or open only as a tombstone) open a version from ``D`` and
close their tombstone at ``D-1``; keys missing from ``S`` close their open
version at ``D-1`` and open a tombstone from ``D``; keys whose attributes
changed close at ``D-1`` and open a new version from ``D``.

Two forms are provided:

* ``merge_day`` - one snapshot against the current history: one full outer
  join of the snapshot with the open rows on the key, one classification.
* ``backfill`` - all snapshots at once in closed form: per key, the days it
  is present, the previous/next presence and the next snapshot day tell
  where versions start and where tombstones go. Windows are per key over
  its presence days (bounded by the number of snapshots), and no key x day
  grid is ever built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.config import Semantics
from cardwatch.functions.timefn import sentinel_ts
from cardwatch.operators.joins import small_join

NEW, RETURNED, UPDATED, DELETED = "new", "returned", "updated", "deleted"


def _changed(a_cols: Sequence[Column], b_cols: Sequence[Column], semantics: Semantics) -> Column:
    if semantics == Semantics.PARITY:
        # '<>' is NULL when either side is NULL, so such a change goes unseen.
        parts = [F.coalesce(a != b, F.lit(False)) for a, b in zip(a_cols, b_cols)]
    else:
        parts = [~a.eqNullSafe(b) for a, b in zip(a_cols, b_cols)]
    return reduce(lambda x, y: x | y, parts)


def _close(day_col: Column) -> Column:
    return F.date_sub(day_col, 1).cast("timestamp_ntz")


def snapshot_days(snapshots: DataFrame, date_col: str) -> DataFrame:
    """Distinct snapshot days with the following snapshot day (calendar-bounded)."""
    days = snapshots.select(F.col(date_col).alias("_day")).distinct()
    return days.withColumn("_next_snap", F.lead("_day").over(Window.orderBy("_day")))


def _presence(snapshots: DataFrame, key: str, attrs: Sequence[str], date_col: str,
              semantics: Semantics) -> DataFrame:
    s = snapshots.select(key, *attrs, F.col(date_col).alias("_day"))
    if semantics == Semantics.INTENDED:
        # exact copies of a row carry nothing for the history; collapsing them is a
        # partial aggregation, so a key copied many times never reaches one window task whole
        s = s.filter(F.col(key).isNotNull()).dropDuplicates([key, "_day", *attrs])
    s = small_join(s, snapshot_days(snapshots, date_col), "_day")
    w = Window.partitionBy(key).orderBy("_day")
    return s.withColumns({
        "_prev_day": F.lag("_day").over(w),
        "_prev_next_snap": F.lag("_next_snap").over(w),
        "_next_day": F.lead("_day").over(w),
        **{f"_prev_{a}": F.lag(a).over(w) for a in attrs},
    })


def change_events(snapshots: DataFrame, key: str, attrs: Sequence[str], date_col: str = "snap_date",
                  semantics: Semantics = Semantics.INTENDED) -> DataFrame:
    """Per key and day, the change the merge of that day applies.

    Columns: change_date, key, attrs, change in (new, returned, updated, deleted).
    Deleted rows carry the last attributes seen. One presence row yields at
    most two events (a version start on its day, a tombstone on the next
    snapshot day); both come out of one ``explode`` so the key partitioning
    of the presence window carries over to the history window.
    """
    s = _presence(snapshots, key, attrs, date_col, semantics)
    first = F.col("_prev_day").isNull()
    returned = ~first & (F.col("_prev_next_snap") != F.col("_day"))
    changed = _changed([F.col(a) for a in attrs], [F.col(f"_prev_{a}") for a in attrs], semantics)
    updated = ~first & ~returned & changed
    kind = F.when(first, NEW).when(returned, RETURNED).when(updated, UPDATED)
    gone = F.col("_next_snap").isNotNull() & (
        F.col("_next_day").isNull() | (F.col("_next_day") != F.col("_next_snap")))
    ev = F.array_compact(F.array(
        F.when(kind.isNotNull(), F.struct(F.col("_day").alias("d"), kind.alias("c"))),
        F.when(gone, F.struct(F.col("_next_snap").alias("d"), F.lit(DELETED).alias("c")))))
    x = s.select(key, *attrs, F.explode(ev).alias("_ev"))
    return x.select(F.col("_ev.d").alias("change_date"), key, *attrs, F.col("_ev.c").alias("change"))


def history_from_events(events: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(key).orderBy("effective_from")
    h = events.select(key, *attrs, F.col("change_date").alias("effective_from"),
                      F.when(F.col("change") == DELETED, 1).otherwise(0).alias("deleted_flg"))
    nxt = F.lead("effective_from").over(w)
    h = h.withColumn("effective_to", F.coalesce(_close(nxt), sentinel_ts()))
    return h.select(key, *attrs, "effective_from", "effective_to", "deleted_flg")


def backfill(snapshots: DataFrame, key: str, attrs: Sequence[str], date_col: str = "snap_date",
             semantics: Semantics = Semantics.INTENDED) -> DataFrame:
    """Full history from all snapshots at once (closed form of the daily fold).

    The closed form compares each snapshot with the key's previous one. Under
    the parity preset a NULL attribute hides a change, and the open version
    then differs from the previous snapshot, so parity uses ``fold``.
    """
    if semantics == Semantics.PARITY:
        raise ValueError("closed form is for the intended preset; use fold() for parity")
    return history_from_events(change_events(snapshots, key, attrs, date_col, semantics), key, attrs)


def empty_history(spark, key: str, attrs: Sequence[str]) -> DataFrame:
    cols = ", ".join([f"CAST(NULL AS STRING) AS `{c}`" for c in [key, *attrs]])
    return spark.sql(f"SELECT {cols}, CAST(NULL AS DATE) AS effective_from, "
                     f"CAST(NULL AS TIMESTAMP_NTZ) AS effective_to, CAST(NULL AS INT) AS deleted_flg "
                     f"WHERE false")


def merge_rows(open_: DataFrame, snapshot: DataFrame, day, key: str, attrs: Sequence[str],
               semantics: Semantics = Semantics.INTENDED, history: DataFrame | None = None) -> DataFrame:
    """The open rows after one day's full snapshot: kept, closed at D-1, or opened on D.

    Columns of the history, and ``_change`` (new, returned, updated, deleted) on the row that a change opened. Only
    the open rows take part; closed ones stay as they are. ``history`` (all rows, NULL keys and all) is needed for
    the parity preset only.
    """
    d = F.lit(day).cast("date")
    s = snapshot.select(key, *attrs)
    if semantics == Semantics.INTENDED:
        s = s.filter(F.col(key).isNotNull()).dropDuplicates([key, *attrs])  # exact copies are one row
    s = s.select(F.col(key).alias("_s_key"), *[F.col(a).alias(f"_s_{a}") for a in attrs],
                 F.lit(True).alias("_in_s"))
    o = open_.select(F.col(key).alias("_h_key"), *[F.col(a).alias(f"_h_{a}") for a in attrs],
                     F.col("effective_from").alias("_h_from"), F.col("deleted_flg").alias("_h_flg"),
                     F.lit(True).alias("_in_h"))
    j = s.join(o, F.col("_s_key") == F.col("_h_key"), "full_outer")
    in_s, in_h = F.col("_in_s").isNotNull(), F.col("_in_h").isNotNull()
    flg = F.col("_h_flg")
    changed = _changed([F.col(f"_s_{a}") for a in attrs], [F.col(f"_h_{a}") for a in attrs], semantics)
    if semantics == Semantics.PARITY:
        # NOT IN semantics, as scalar subqueries of the same plan: a NULL key in the snapshot hides every deletion, a
        # NULL key in the history hides every new row and is itself never deleted, and a NULL-key row is new only
        # while the history is still empty
        snap_nulls = snapshot.agg(F.count(F.when(F.col(key).isNull(), 1))).scalar()
        hist = (open_ if history is None else history).agg(
            F.struct(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(key).isNull(), 1)).alias("nulls"))).scalar()
        delete_ok = (snap_nulls == 0) & F.col("_h_key").isNotNull()
        new_ok = (F.col("_s_key").isNotNull() & (hist["nulls"] == 0)) | (hist["n"] == 0)
    else:
        delete_ok, new_ok = F.lit(True), F.lit(True)
    kind = (F.when(in_s & ~in_h & new_ok, NEW)
             .when(in_s & in_h & (flg == 1), RETURNED)
             .when(~in_s & in_h & (flg == 0) & delete_ok, DELETED)
             .when(in_s & in_h & (flg == 0) & changed, UPDATED))
    j = j.withColumn("_kind", kind)
    k = F.col("_kind")
    from_s = k.isin(NEW, RETURNED, UPDATED)
    closes = k.isin(RETURNED, DELETED, UPDATED)

    def row(key_c, attr_cs, frm, to, flg, change):
        return F.struct(key_c.alias(key), *[c.alias(a) for c, a in zip(attr_cs, attrs)], frm.alias("effective_from"),
                        to.alias("effective_to"), flg.alias("deleted_flg"), change.alias("_change"))

    # the open row before today: kept open, or closed at D-1
    old = F.when(in_h, row(F.col("_h_key"), [F.col(f"_h_{a}") for a in attrs], F.col("_h_from"),
                           F.when(closes, _close(d)).otherwise(sentinel_ts()), F.col("_h_flg"),
                           F.lit(None).cast("string")))
    # the row opened today: a version from the snapshot, or a tombstone with the last attributes
    new = F.when(k.isNotNull(), row(
        F.when(from_s, F.col("_s_key")).otherwise(F.col("_h_key")),
        [F.when(from_s, F.col(f"_s_{a}")).otherwise(F.col(f"_h_{a}")) for a in attrs],
        d, sentinel_ts(), F.when(k == DELETED, 1).otherwise(0), k))
    return j.select(F.explode(F.array_compact(F.array(old, new))).alias("_r")).select("_r.*")


def is_open() -> Column:
    return F.col("effective_to") == sentinel_ts()


def merge_day(history: DataFrame, snapshot: DataFrame, day, key: str, attrs: Sequence[str],
              semantics: Semantics = Semantics.INTENDED) -> tuple[DataFrame, DataFrame]:
    """Apply one day's full snapshot; return ``(history, changes)``.

    Closed rows are passed through untouched; only the open rows take part in
    the join, so a storage layer can keep closed rows as immutable appends
    and rewrite the open set alone.
    """
    hcols = [key, *attrs, "effective_from", "effective_to", "deleted_flg"]
    history = history.select(*hcols)
    rows = merge_rows(history.filter(is_open()), snapshot, day, key, attrs, semantics, history)
    new_history = history.filter(~is_open()).unionByName(rows.select(*hcols))
    changes = rows.filter(F.col("_change").isNotNull()).select(
        F.lit(day).cast("date").alias("change_date"), key, *attrs, F.col("_change").alias("change"))
    return new_history, changes


def rewind(history: DataFrame, day) -> DataFrame:
    """The history as it was before the merge of ``day``: later versions undone, what they closed open again.

    Needs nothing but the rows themselves: a merge of day D closes at D-1, and every earlier one before that.
    """
    d = F.lit(day).cast("date")
    h = history.filter(F.col("effective_from") < d)
    reopened = F.to_date("effective_to") >= F.date_sub(d, 1)
    return h.withColumn("effective_to", F.when(reopened, sentinel_ts()).otherwise(F.col("effective_to")))


def splice(history: DataFrame, snapshot: DataFrame, day, before, after, key: str, attrs: Sequence[str]) -> DataFrame:
    """Set one day of the history anew (a snapshot that comes late, or a day that runs again); keys that it concerns.

    ``before`` and ``after`` are the snapshot days around ``day`` (None: there is none). Per key the versions that
    cover the three days tell its state on each. Where the snapshot's state differs from the history's on ``day``, the
    versions covering them are replaced: the state before ends at D-1, the snapshot's state holds up to the next
    snapshot day, the state after goes on from there, and neighbours in the same state become one version. So only
    keys that change are touched, and versions that cover none of the three days never are.

    Columns: the key, ``_old`` (effective_from and effective_to of the versions to take out), ``_new`` (versions to
    put in), both NULL for keys that stay as they are; ``_change`` and ``_next_change``, the changes that the merges of
    ``day`` and ``after`` make. Intended preset only: parity hides changes, so its states are not those of the snapshots.
    """
    d = F.lit(day).cast("date")
    p_day = F.lit(before).cast("date")
    n_day = F.lit(after).cast("date")
    to_day = F.to_date("effective_to")
    version = F.struct(*attrs, "deleted_flg", "effective_from", "effective_to")

    def covering(x):
        return F.max(F.when((F.col("effective_from") <= x) & (to_day >= x), version))

    h = history.filter(to_day >= (p_day if before is not None else d)).groupBy(F.col(key).alias("_k")).agg(
        covering(p_day).alias("_p"), covering(d).alias("_o"), covering(n_day).alias("_n"),
        F.min(F.when(F.col("effective_from") > (n_day if after is not None else d), F.col("effective_from"))).alias("_later"))
    s = snapshot.select(key, *attrs).filter(F.col(key).isNotNull()).dropDuplicates([key, *attrs]).select(
        F.col(key).alias("_s_key"), F.struct(*attrs).alias("_s"))
    j = s.join(h, F.col("_s_key") == F.col("_k"), "full_outer").select(F.coalesce("_s_key", "_k").alias(key), "_s", "_p",
                                                                        "_o", "_n", "_later")

    never, present, absent = F.lit(0), F.lit(1), F.lit(2)

    def values(c: str) -> Column:
        return F.struct(*[F.col(f"{c}.{a}").alias(a) for a in attrs])

    def state(c: str) -> Column:
        return F.when(F.col(c).isNull(), never).when(F.col(f"{c}.deleted_flg") == 0, present).otherwise(absent)

    j = j.withColumns({"_ps": state("_p"), "_pv": values("_p"), "_os": state("_o"), "_ov": values("_o")})
    j = j.withColumns({"_xs": F.when(F.col("_s").isNotNull(), present).when(F.col("_ps") > 0, absent).otherwise(never),
                       "_xv": F.coalesce(F.col("_s"), F.col("_pv"))})
    # after: a tombstone there stands only for keys that are known by then, with the attributes they had last
    n_here = state("_n") == present
    ns = never if after is None else F.when(n_here, present).when(F.col("_xs") > 0, absent).otherwise(never)
    j = j.withColumns({"_ns": ns, "_nv": F.when(n_here, values("_n")).otherwise(F.col("_xv"))})

    def same(a: str, b: str) -> Column:
        return (F.col(f"_{a}s") == F.col(f"_{b}s")) & (F.col(f"_{a}s") > 0) & (
            (F.col(f"_{a}s") == absent) | F.col(f"_{a}v").eqNullSafe(F.col(f"_{b}v")))

    def change(a: str, b: str) -> Column:
        sa, sb = F.col(f"_{a}s"), F.col(f"_{b}s")
        return (F.when((sa == never) & (sb == present), NEW).when((sa == absent) & (sb == present), RETURNED)
                .when((sa == present) & (sb == absent), DELETED)
                .when((sa == present) & (sb == present) & ~F.col(f"_{a}v").eqNullSafe(F.col(f"_{b}v")), UPDATED))

    def row(c: str, frm: Column, to: Column) -> Column:
        return F.struct(*[F.col(f"_{c}v.{a}").alias(a) for a in attrs], frm.cast("date").alias("effective_from"),
                        to.cast("timestamp_ntz").alias("effective_to"),
                        F.when(F.col(f"_{c}s") == absent, 1).otherwise(0).alias("deleted_flg"))

    x_from = F.when(same("p", "x"), F.col("_p.effective_from")).otherwise(d)
    x_to = sentinel_ts() if after is None else _close(n_day)
    n_from = F.when(same("x", "n"), x_from).otherwise(n_day)
    n_to = F.coalesce(F.col("_n.effective_to"), _close(F.col("_later")), sentinel_ts())
    new = F.array_compact(F.array(
        F.when((F.col("_ps") > 0) & ~same("p", "x"), row("p", F.col("_p.effective_from"), _close(d))),
        F.when((F.col("_xs") > 0) & ~same("x", "n"), row("x", x_from, x_to)),
        F.when(F.col("_ns") > 0, row("n", n_from, n_to))))
    span = [F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.effective_from"), F.col(f"{c}.effective_to")))
            for c in ("_p", "_o", "_n")]
    touched = (F.col("_xs") != F.col("_os")) | (F.col("_xs") == present) & ~F.col("_xv").eqNullSafe(F.col("_ov"))
    return j.select(key, F.when(touched, F.array_distinct(F.array_compact(F.array(*span)))).alias("_old"),
                    F.when(touched, new).alias("_new"), change("p", "x").alias("_change"),
                    change("x", "n").alias("_next_change"))


def spliced(history: DataFrame, found: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """``history`` with the versions of ``splice`` taken out and put in."""
    hcols = [key, *attrs, "effective_from", "effective_to", "deleted_flg"]
    gone = found.select(key, F.explode("_old").alias("_x")).select(key, F.col("_x.effective_from").alias("effective_from"))
    put = found.select(key, F.explode("_new").alias("_x")).select(key, "_x.*")
    return history.select(*hcols).join(gone, [key, "effective_from"], "left_anti").unionByName(put.select(*hcols))


def fold(spark, snapshots: DataFrame, key: str, attrs: Sequence[str], date_col: str = "snap_date",
         semantics: Semantics = Semantics.INTENDED, checkpoint_every: int = 1,
         days: Sequence | None = None) -> tuple[DataFrame, DataFrame]:
    """Replay ``merge_day`` over the snapshot days in date order.

    The day list is the calendar of batches (bounded). Lineage is cut with a
    reliable ``checkpoint()`` into the session's checkpoint folder.
    """
    from cardwatch.session import checkpoint_dir
    checkpoint_dir(spark)  # the session's shared folder; set only when unset
    if days is None:
        days = [r[0] for r in snapshots.select(date_col).distinct().orderBy(date_col).collect()]
    hist = empty_history(spark, key, attrs)
    changes = []
    for i, d in enumerate(days):
        snap = snapshots.filter(F.col(date_col) == F.lit(d))
        hist, ch = merge_day(hist, snap, d, key, attrs, semantics)
        if (i + 1) % checkpoint_every == 0:
            # each day's history reads the previous one twice (closed part, open join):
            # without a cut the plan doubles per day
            hist = hist.checkpoint()
            ch = ch.checkpoint()
        changes.append(ch)
    allch = reduce(DataFrame.unionByName, changes) if changes else None
    return hist, allch


def current(history: DataFrame) -> DataFrame:
    """Open, non-deleted versions."""
    return history.filter((F.col("effective_to") == sentinel_ts()) & (F.col("deleted_flg") == 0))


def as_of(history: DataFrame, day) -> DataFrame:
    """Versions valid on ``day`` (tombstones excluded)."""
    d = F.lit(day).cast("date")
    return history.filter((F.col("deleted_flg") == 0) & (F.col("effective_from") <= d)
                          & (F.to_date("effective_to") >= d))
