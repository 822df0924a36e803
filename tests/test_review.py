"""Cases of the review: NULL cities, copied snapshots, NULL ids, unreadable file types, second files of a day."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cardwatch.config import Semantics
from cardwatch.operators import report, scd2
from cardwatch.schemas import ALERT_COLS
from cardwatch.sources import feeds

ATTRS = ["city"]
HIST = "id string, city string, effective_from date, effective_to timestamp_ntz, deleted_flg int"


def history(spark):
    return spark.createDataFrame([], HIST)


def test_copied_snapshot_rows_do_not_double(spark):
    snap = spark.createDataFrame([("1", "A"), ("1", "A"), ("2", "B")], "id string, city string")
    h = history(spark)
    for day in (1, 2, 3):
        h, _ = scd2.merge_day(h, snap, dt.date(2024, 1, day), "id", ATTRS)
    assert sorted(r["id"] for r in h.collect()) == ["1", "2"]


def test_parity_null_id_in_history_changes_nothing(spark):
    first = spark.createDataFrame([(None, "A"), ("1", "A")], "id string, city string")
    h, _ = scd2.merge_day(history(spark), first, dt.date(2024, 1, 1), "id", ATTRS, Semantics.PARITY)
    second = spark.createDataFrame([("1", "A"), ("2", "B")], "id string, city string")
    h2, ch = scd2.merge_day(h, second, dt.date(2024, 1, 2), "id", ATTRS, Semantics.PARITY)
    assert ch.count() == 0 and h2.count() == h.count() == 2


def test_unreadable_types_are_refused(spark, scratch):
    for n in ("terminals_02012024.xlsx", "passport_blacklist_02012024.csv.gz", "terminals_03012024.csv"):
        with open(os.path.join(scratch, n), "w") as f:
            f.write("x\n")
    got = {r["file_name"]: r["reject_reason"] for r in feeds.discover(spark, scratch).collect()}
    assert got["terminals_02012024.xlsx"] == "unreadable file type"
    assert got["passport_blacklist_02012024.csv.gz"] and got["terminals_03012024.csv"] is None
    assert [r["file_name"] for r in feeds.pending(feeds.discover(spark, scratch), None).collect()] == ["terminals_03012024.csv"]


def test_report_files_hold_six_columns(spark, scratch):
    d = dt.date(2024, 1, 1)
    row = spark.range(1).select(*[F.lit(d if c.endswith("_dt") else "x").alias(c) for c in ALERT_COLS])
    report.export(row, os.path.join(scratch, "rep"))
    found = [os.path.join(p, n) for p, _, ns in os.walk(os.path.join(scratch, "rep")) for n in ns if n.endswith(".csv")]
    assert found and open(found[0]).readline().strip().split(",") == ALERT_COLS
