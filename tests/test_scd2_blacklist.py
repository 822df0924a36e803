"""SCD2 merge and blacklist edges; fold = closed form."""

from pyspark.sql import functions as F

from cardwatch.config import Semantics
from cardwatch.operators import blacklist as bl
from cardwatch.operators import scd2
from cardwatch.schemas import BLACKLIST, HIST_COLS, TERMINAL_ATTRS
from helpers import D, T, digest

KEY, ATTRS = "terminal_id", TERMINAL_ATTRS
SNAP = "snap_date string, terminal_id string, terminal_type string, terminal_city string, terminal_address string"


def _snaps(spark, rows):
    return spark.createDataFrame(rows, SNAP).withColumn("snap_date", F.to_date("snap_date"))


ROWS = [
    # day 1: a, b, c
    ("2024-01-01", "a", "ATM", "X", "1"), ("2024-01-01", "b", "ATM", "X", "2"), ("2024-01-01", "c", "POS", "Y", "3"),
    # day 2: a changes city, b gone, c same, d new
    ("2024-01-02", "a", "ATM", "Z", "1"), ("2024-01-02", "c", "POS", "Y", "3"), ("2024-01-02", "d", "POS", "Y", "4"),
    # day 3: b returns with other attributes, c gone
    ("2024-01-03", "a", "ATM", "Z", "1"), ("2024-01-03", "b", "POS", "W", "2"), ("2024-01-03", "d", "POS", "Y", "4"),
    # day 4: c returns same attributes, d gone
    ("2024-01-04", "a", "ATM", "Z", "1"), ("2024-01-04", "b", "POS", "W", "2"), ("2024-01-04", "c", "POS", "Y", "3"),
    # day 5: nothing of d again (gone twice)
    ("2024-01-05", "a", "ATM", "Z", "1"), ("2024-01-05", "b", "POS", "W", "2"), ("2024-01-05", "c", "POS", "Y", "3"),
]


def test_backfill_equals_fold(spark):
    s = _snaps(spark, ROWS)
    closed = scd2.backfill(s, KEY, ATTRS)
    folded, changes = scd2.fold(spark, s, KEY, ATTRS, checkpoint_every=2)
    assert digest(closed.select(*HIST_COLS)) == digest(folded.select(*HIST_COLS))
    ev = scd2.change_events(s, KEY, ATTRS)
    assert digest(ev) == digest(changes.select(*ev.columns))


def test_history_shape(spark):
    h = scd2.backfill(_snaps(spark, ROWS), KEY, ATTRS)
    opens = h.filter(F.col("effective_to") == T(2999, 12, 31, 23, 59, 59))
    assert opens.groupBy(KEY).count().filter("count <> 1").count() == 0  # one open row per key
    d = {r[KEY]: r for r in opens.collect()}
    assert d["d"]["deleted_flg"] == 1 and d["d"]["effective_from"] == D(2024, 1, 4)
    assert d["b"]["terminal_city"] == "W" and d["b"]["deleted_flg"] == 0
    ev = {(r["change_date"].day, r[KEY]): r["change"] for r in scd2.change_events(_snaps(spark, ROWS), KEY, ATTRS).collect()}
    assert ev[(2, "a")] == "updated" and ev[(2, "b")] == "deleted" and ev[(2, "d")] == "new"
    assert ev[(3, "b")] == "returned" and ev[(3, "c")] == "deleted" and ev[(4, "c")] == "returned"
    assert ev[(4, "d")] == "deleted" and (5, "d") not in ev


def test_intervals_do_not_overlap(spark):
    h = scd2.backfill(_snaps(spark, ROWS), KEY, ATTRS)
    bad = h.alias("x").join(h.alias("y"), (F.col("x.terminal_id") == F.col("y.terminal_id"))
                            & (F.col("x.effective_from") < F.col("y.effective_from"))
                            & (F.to_date("x.effective_to") >= F.col("y.effective_from")))
    assert bad.count() == 0


def test_same_snapshot_twice_changes_nothing(spark):
    s = _snaps(spark, ROWS[:3])
    h1, _ = scd2.merge_day(scd2.empty_history(spark, KEY, ATTRS), s.drop("snap_date"), D(2024, 1, 1), KEY, ATTRS)
    h2, ch = scd2.merge_day(h1, s.drop("snap_date"), D(2024, 1, 1), KEY, ATTRS)
    assert ch.count() == 0 and digest(h1) == digest(h2)


def test_null_attribute_change_intended_vs_parity(spark):
    rows = [("2024-01-01", "a", "ATM", None, "1"), ("2024-01-02", "a", "ATM", "X", "1")]
    s = _snaps(spark, rows)
    _, ch_i = scd2.fold(spark, s, KEY, ATTRS, semantics=Semantics.INTENDED)
    _, ch_p = scd2.fold(spark, s, KEY, ATTRS, semantics=Semantics.PARITY)
    assert sorted(r["change"] for r in ch_i.collect()) == ["new", "updated"]
    assert sorted(r["change"] for r in ch_p.collect()) == ["new"]


def test_null_id_intended_rejected_parity_hides_deletions(spark):
    rows = [("2024-01-01", "a", "ATM", "X", "1"), ("2024-01-01", "b", "ATM", "X", "2"),
            ("2024-01-02", "a", "ATM", "X", "1"), ("2024-01-02", None, "ATM", "X", "9")]
    s = _snaps(spark, rows)
    _, ch_i = scd2.fold(spark, s, KEY, ATTRS, semantics=Semantics.INTENDED)
    _, ch_p = scd2.fold(spark, s, KEY, ATTRS, semantics=Semantics.PARITY)
    assert sorted((r["change_date"].day, r["change"]) for r in ch_i.collect()) == [(1, "new"), (1, "new"), (2, "deleted")]
    assert sorted((r["change_date"].day, r["change"]) for r in ch_p.collect()) == [(1, "new"), (1, "new")]


def test_as_of_rebuilds_each_snapshot(spark):
    s = _snaps(spark, ROWS)
    h = scd2.backfill(s, KEY, ATTRS)
    for day in range(1, 6):
        d = D(2024, 1, day)
        got = scd2.as_of(h, d).select(KEY, *ATTRS)
        want = s.filter(F.col("snap_date") == d).select(KEY, *ATTRS)
        assert digest(got) == digest(want)


FEED = "passport_num string, source_entry_dt string, file_date date"


def test_blacklist_bulk_equals_fold(spark):
    rows = [("P1", None, D(2024, 1, 1)), ("P2", None, D(2024, 1, 1)), ("P1", None, D(2024, 1, 2)),
            ("P3", None, D(2024, 1, 2)), ("P3", None, D(2024, 1, 3))]
    feed = spark.createDataFrame(rows, FEED)
    bulk = bl.table_from_new(bl.new_entries(feed), source_col=None)
    table = spark.createDataFrame([], BLACKLIST)
    for day in (D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)):
        _, add = bl.merge_day(table, feed.filter(F.col("file_date") == day).drop("source_entry_dt"), day)
        table = table.unionByName(add)
    assert digest(bulk) == digest(table)


def test_blacklist_nulls_intended_vs_parity(spark):
    table_with_null = spark.createDataFrame([(None, D(2024, 1, 1)), ("P1", D(2024, 1, 1))], BLACKLIST)
    feed = spark.createDataFrame([("P2", None, D(2024, 1, 2))], FEED).drop("source_entry_dt")
    assert bl.merge_day(table_with_null, feed, D(2024, 1, 2))[1].count() == 1
    assert bl.merge_day(table_with_null, feed, D(2024, 1, 2), Semantics.PARITY)[1].count() == 0
    empty = spark.createDataFrame([], BLACKLIST)
    null_feed = spark.createDataFrame([(None, None, D(2024, 1, 2))], FEED).drop("source_entry_dt")
    assert bl.merge_day(empty, null_feed, D(2024, 1, 2))[1].count() == 0
    assert bl.merge_day(empty, null_feed, D(2024, 1, 2), Semantics.PARITY)[1].count() == 1
