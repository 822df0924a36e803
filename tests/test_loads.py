"""The commit log: whole loads or none, emptied days, late days, rejected rows and refused files."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from cardwatch.config import DEFAULT, FIXED_REPORT_DT, PARITY, Semantics
from cardwatch.operators import scd2
from cardwatch.operators.joins import not_in
from cardwatch.plans.warehouse import Warehouse
from cardwatch.schemas import HIST_COLS
from helpers import D, T, digest, fact_rows, one_client

CFG = DEFAULT.with_(report_dt=FIXED_REPORT_DT)
ATTRS = ["city", "kind"]


def day(n):
    return D(2024, 1, n)


def warehouse(spark, root, cfg=CFG):
    wh = Warehouse(spark, root, cfg)
    wh.bootstrap(*one_client(spark, valid_to=D(2024, 1, 1)))
    return wh


def ops(spark, n, ids=("1", "2")):
    return fact_rows(spark, [(i, T(2024, 1, n, 10 + k), "C1", "WITHDRAW", 5, "SUCCESS", "T1") for k, i in enumerate(ids)])


def snapshot(spark, rows):
    return spark.createDataFrame([(k, "ATM", c, "a") for k, c in rows],
                                 "terminal_id string, terminal_type string, terminal_city string, terminal_address string")


def passports(spark, rows):
    return spark.createDataFrame([(p,) for p in rows], "passport_num string")


def test_emptied_day(spark, scratch):
    wh = warehouse(spark, scratch)
    wh.load_transactions(day(2), ops(spark, 2))
    assert wh.fact().count() == 2 and wh.alerts().count() == 2
    wh.load_transactions(day(2), ops(spark, 2).limit(0))
    assert wh.fact().count() == 0 and wh.alerts().count() == 0
    assert [tuple(r)[2:] for r in wh.audit().collect()] == [(0, None, None)]
    wh.load_blacklist(day(2), passports(spark, ["A"]))
    wh.load_blacklist(day(2), passports(spark, []))
    assert wh.blacklist().count() == 0
    wh.load_terminals(day(2), snapshot(spark, [("1", "X")]))
    wh.load_terminals(day(2), snapshot(spark, []))
    assert wh.terminals_history().count() == 0


def state(wh):
    return [digest(t) for t in (wh.fact(), wh.alerts(), wh.blacklist(), wh.audit(), wh.rejects(),
                                wh.terminals_history().select(*HIST_COLS), wh.manifest().drop("committed_at"),
                                wh.refused().drop("committed_at"))]


def write_day(folder, n, tx, bl=("P1",), term=(("T1", "X"),), extra=""):
    tag = day(n).strftime("%d%m%Y")
    with open(os.path.join(folder, f"transactions_{tag}{extra}.txt"), "w") as f:
        f.write("id;date;amount;card;type;result;terminal\n")
        f.writelines(f"{line}\n" for line in tx)
    with open(os.path.join(folder, f"passport_blacklist_{tag}{extra}.csv"), "w") as f:
        f.write("date,passport\n")
        f.writelines(f"2024-01-0{n} 00:00:00,{p}\n" for p in bl)
    with open(os.path.join(folder, f"terminals_{tag}{extra}.csv"), "w") as f:
        f.write("id,type,city,address\n")
        f.writelines(f"{k},ATM,{c},a\n" for k, c in term)


def line(i, n, hour=10):
    return f"{i};2024-01-0{n} {hour}:00:00;5,50;C1;WITHDRAW;SUCCESS;T1"


def test_a_failed_load_leaves_the_state_before(spark, scratch, monkeypatch):
    inbox = os.path.join(scratch, "in")
    os.mkdir(inbox)
    wh = warehouse(spark, os.path.join(scratch, "wh"))
    write_day(inbox, 2, [line(1, 2), "short;line"])
    wh.load_folder(inbox)
    before = state(wh)
    write_day(inbox, 3, [line(2, 3)], bl=["P2"], term=[("T1", "Y"), ("T2", "Z")])
    plain, done = Warehouse._write, []
    for crash in range(20):
        at = [0]

        def failing(self, *a, **k):
            at[0] += 1
            if at[0] > crash:
                raise RuntimeError("lost")
            return plain(self, *a, **k)

        monkeypatch.setattr(Warehouse, "_write", failing)
        try:
            wh.load_folder(inbox)
            done.append(crash)
            break
        except RuntimeError:
            assert state(wh) == before, crash
            assert state(Warehouse(spark, wh.root, CFG)) == before
        finally:
            monkeypatch.setattr(Warehouse, "_write", plain)
    assert done and done[0] >= 5
    assert wh.fact().count() == 2 and [r["file_date"] for r in wh.rejects().collect()] == [day(2)]


def test_files_in_any_order_give_the_same_warehouse(spark, scratch):
    days = {2: ([line(1, 2), line(2, 2, 23)], ["P9", "P1"], [("T1", "X"), ("T2", "Y")]),
            3: ([line(3, 3, "00")], ["P1", "P2"], [("T1", "Y")]),
            4: ([line(4, 4)], ["P2", "P3"], [("T1", "X"), ("T2", "Y"), ("T3", "Z")])}
    states = []
    for order in ([2, 3, 4], [2, 4, 3], [4, 2, 3]):
        root = os.path.join(scratch, "".join(map(str, order)))
        inbox = os.path.join(root, "in")
        os.makedirs(inbox)
        wh = warehouse(spark, os.path.join(root, "wh"))
        for n in order:
            write_day(inbox, n, *days[n])
            wh.load_folder(inbox)
        states.append(state(wh))
    assert states[0] == states[1] == states[2]
    hist = {(r["terminal_id"], str(r["effective_from"])): r["terminal_city"] for r in wh.terminals_history().collect()}
    assert hist["T1", "2024-01-03"] == "Y"


def test_further_file_of_an_old_day(spark, scratch):
    inbox = os.path.join(scratch, "in")
    os.mkdir(inbox)
    wh = warehouse(spark, os.path.join(scratch, "wh"))
    write_day(inbox, 2, [line(1, 2)])
    write_day(inbox, 3, [line(2, 3)])
    wh.load_folder(inbox)
    with open(os.path.join(inbox, "transactions_b_02012024.txt"), "w") as f:
        f.write("h\n" + line(5, 2, 11) + "\n")
    assert wh.load_folder(inbox) == [day(2)]
    assert sorted(r[0] for r in wh.fact().select("trans_id").collect()) == ["1", "2", "5"]
    assert wh.alerts().filter(F.col("run_date") == F.lit(day(2))).filter("event_type = '2'").count() == 2


def test_rejected_rows_and_refused_files(spark, scratch):
    inbox = os.path.join(scratch, "in")
    os.mkdir(inbox)
    wh = warehouse(spark, os.path.join(scratch, "wh"))
    good = line(1, 2)
    write_day(inbox, 2, [good, good + ";8", '"' + good.replace(";C1;", '";C1;'), "9;2024-01-02 10:00:00", ";" + good[2:],
                         good.replace("5,50", "x"), good.replace("2024-01-02", "02.01.2024"), "  " + line(2, 2) + "  "],
              bl=["P1", "", "P2"], term=[("T1", "X"), ("", "Y")])
    with open(os.path.join(inbox, "passport_x_02012024.csv"), "w") as f:
        f.write("date,passport\n2024-01-02,P7,extra\n")
    for name in ("junk_02012024.txt", "passport_blacklist_nodate.csv"):
        with open(os.path.join(inbox, name), "w") as f:
            f.write("x\n")
    wh.load_folder(inbox)
    wh.load_folder(inbox)
    got = sorted((r["feed"], r["reject_reason"]) for r in wh.rejects().collect())
    assert got == [("passport", "field count"), ("passport", "null passport"), ("terminals", "null terminal"),
                   *sorted(("transactions", r) for r in ("field count", "quoted field", "field count", "missing field",
                                                         "bad amount", "bad date"))]
    assert good + ";8" in [r["line"] for r in wh.rejects().collect()]
    assert sorted(r[0] for r in wh.fact().select("trans_id").collect()) == ["1", "2"]
    assert sorted((r["file_name"], r["reason"]) for r in wh.refused().collect()) == [
        ("junk_02012024.txt", "unknown prefix"), ("passport_blacklist_nodate.csv", "no date in name")]


def test_parity_refuses_late_snapshots(spark, scratch):
    wh = warehouse(spark, scratch, PARITY.with_(report_dt=FIXED_REPORT_DT))
    wh.load_terminals(day(3), snapshot(spark, [("1", "X")]))
    with pytest.raises(ValueError):
        wh.load_terminals(day(2), snapshot(spark, [("1", "Y")]))
    wh.load_terminals(day(3), snapshot(spark, [("1", "Y")]))
    assert [r["terminal_city"] for r in wh.terminals_history().collect()] == ["Y"]


def test_the_newest_merge_reads_no_closed_rows(spark, scratch, monkeypatch):
    wh = warehouse(spark, scratch)
    for n, city in ((2, "X"), (3, "Y"), (4, "Z")):
        wh.load_terminals(day(n), snapshot(spark, [("1", city)]))
    read = []
    plain = Warehouse._read
    monkeypatch.setattr(Warehouse, "_read", lambda self, t, *a: read.append(t) or plain(self, t, *a))
    wh.load_terminals(day(5), snapshot(spark, [("1", "X")]))
    assert read == ["open"]


@pytest.mark.parametrize("seed", range(4))
def test_splice_in_any_order_equals_the_replay(spark, seed):
    rnd = random.Random(seed)
    days = [day(d) for d in sorted(rnd.sample(range(1, 20), 4))]
    snaps = {d: [(k, rnd.choice(["A", "B", None]), "x") for k in "abcdefgh" if rnd.random() < 0.6] for d in days}
    order = rnd.sample(days, len(days))
    again = rnd.choice(order)  # loaded wrongly first, and once more at the end
    loads = [(d, [(k, "Z", "x") for k in "abz"] if d == again else snaps[d]) for d in order] + [(again, snaps[again])]
    schema = "id string, city string, kind string"
    hist, done = scd2.empty_history(spark, "id", ATTRS), set()
    for d, rows in loads:
        found = scd2.splice(hist, spark.createDataFrame(rows, schema), d, max((x for x in done if x < d), default=None),
                            min((x for x in done if x > d), default=None), "id", ATTRS)
        hist = scd2.spliced(hist, found, "id", ATTRS).checkpoint()
        done.add(d)
    snaps = spark.createDataFrame([(*r, d) for d in days for r in snaps[d]], schema + ", snap_date date")
    want, _ = scd2.fold(spark, snaps, "id", ATTRS, "snap_date", days=days)
    assert digest(hist) == digest(want.select(*hist.columns))
    # and back again: the history before each day's merge
    for i, d in enumerate(days):
        upto, _ = scd2.fold(spark, snaps, "id", ATTRS, "snap_date", days=days[:i])
        assert digest(scd2.rewind(hist, d)) == digest(upto.select(*hist.columns))


def test_not_in_is_three_valued(spark):
    import duckdb
    con = duckdb.connect()
    for left in (["a", "b", None, "a"], []):
        for right in ([], ["a"], ["a", "a", None], [None]):
            lf, rf = (spark.createDataFrame([(x,) for x in v], "k string") for v in (left, right))
            con.register("l", lf.toArrow())
            con.register("r", rf.toArrow())
            want = con.execute("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)").fetchall()
            got = not_in(lf, rf, "k")
            assert sorted(map(str, got.collect())) == sorted(f"Row(k={x[0]!r})" for x in want)
    plan = not_in(spark.range(10).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k"), "k") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_parity_merge_needs_no_driver_jobs(spark):
    rows = spark.createDataFrame([("1", "A", "x")], "id string, city string, kind string")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    scd2.merge_day(scd2.empty_history(spark, "id", ATTRS), rows, dt.date(2024, 1, 1), "id", ATTRS, Semantics.PARITY)
    assert len(tracker.getJobIdsForGroup(None)) == before
