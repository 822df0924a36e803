"""Feed files -> day-by-day warehouse load == bulk plans over the same data; stream == batch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cardwatch.config import DEFAULT, FIXED_REPORT_DT
from cardwatch.operators import audit as audit_ops
from cardwatch.plans.context import Inputs
from cardwatch.plans.queries import full_report
from cardwatch.plans.warehouse import Warehouse
from cardwatch.schemas import ALERT_COLS, HIST_COLS
from cardwatch.sources import feeds
from conftest import SF0001
from feedfiles import write_feeds
from helpers import digest

LAST = dt.date(2024, 1, 8)
CFG = DEFAULT.with_(report_dt=FIXED_REPORT_DT)


@pytest.fixture(scope="module")
def feed_dir(spark):
    import tempfile
    d = tempfile.mkdtemp(prefix="cardwatch-feeds-")
    write_feeds(spark, SF0001, d, LAST)
    for junk in (".DS_Store", "unknown_01012024.txt", "transactions_nodate.txt"):
        with open(os.path.join(d, junk), "w") as f:
            f.write("x\n")
    return d


@pytest.fixture(scope="module")
def bulk(spark):
    x = Inputs(spark, SF0001)
    return Inputs.from_frames(
        spark, CFG, tx=x.tx.filter(F.col("file_date") <= F.lit(LAST)), cards=x.cards, accounts=x.accounts,
        clients=x.clients, bl_feed=x.bl_feed.filter(F.col("file_date") <= F.lit(LAST)),
        snap=x.snap.filter(F.col("snap_date") <= F.lit(LAST)))


def _load(spark, root, bulk):
    wh = Warehouse(spark, root, CFG)
    wh.bootstrap(bulk.cards, bulk.accounts, bulk.clients)
    return wh


@pytest.fixture(scope="module")
def loaded(spark, feed_dir, bulk):
    import tempfile
    wh = _load(spark, tempfile.mkdtemp(prefix="cardwatch-wh-"), bulk)
    wh.load_folder(feed_dir)
    return wh


def test_discovery_reports_unusable_files(spark, feed_dir):
    found = {r["file_name"]: r["reject_reason"] for r in feeds.discover(spark, feed_dir).collect()}
    assert ".DS_Store" not in found
    assert found["unknown_01012024.txt"] == "unknown prefix"
    assert found["transactions_nodate.txt"] == "no date in name"


def test_fact_equals_source(loaded, bulk):
    assert digest(loaded.fact()) == digest(bulk.tx.select(*loaded.fact().columns))


def test_alerts_equal_bulk_report(loaded, bulk):
    got = loaded.alerts().select(*ALERT_COLS)
    assert digest(got) == digest(full_report(bulk))


def test_history_and_blacklist_equal_bulk(loaded, bulk):
    assert digest(loaded.terminals_history().select(*HIST_COLS)) == digest(bulk.hist.select(*HIST_COLS))
    assert digest(loaded.blacklist()) == digest(bulk.bl_table.select("passport_num", "entry_dt"))


def test_audit_equals_bulk(loaded, bulk):
    want = (audit_ops.fact_counts(bulk.tx).unionByName(audit_ops.blacklist_counts(bulk.bl_feed, bulk.bl_new))
            .unionByName(audit_ops.terminal_counts(bulk.snap, bulk.changes)))
    assert digest(loaded.audit()) == digest(want)


def test_reload_is_a_no_op(loaded, feed_dir):
    before = digest(loaded.alerts())
    assert loaded.load_folder(feed_dir) == []
    assert digest(loaded.alerts()) == before


def test_rerun_of_a_day_rewrites_the_same_rows(spark, loaded, feed_dir):
    """A crash after the load but before the manifest record replays the day: nothing doubles."""
    tables = [loaded.alerts(), loaded.fact(), loaded.blacklist(), loaded.audit(),
              loaded.terminals_history().select(*HIST_COLS)]
    before = [digest(t) for t in tables]
    files = [(r["file_date"], r["feed_order"], r["feed"], r["file_name"])
             for r in feeds.discover(spark, feed_dir).filter(F.col("file_date") == F.lit(LAST)).collect()]
    loaded.load_day(feed_dir, LAST, files)
    after = [digest(t) for t in (loaded.alerts(), loaded.fact(), loaded.blacklist(), loaded.audit(),
                                 loaded.terminals_history().select(*HIST_COLS))]
    assert after == before


def test_rejected_lines(spark, scratch):
    with open(os.path.join(scratch, "transactions_02012024.txt"), "w") as f:
        f.write(TX := "h1;h2;h3;h4;h5;h6;h7\n")
        f.write("1;2024-01-02 10:00:00;7,62;C1;WITHDRAW;SUCCESS;T1\n")
        f.write("2;2024-01-02 10:00:00;7.62;C1;WITHDRAW;SUCCESS;T1\n")
        f.write("3;2024-01-02 10:00:00;x;C1;WITHDRAW;SUCCESS;T1\n")
        f.write("4;2024-01-02 10:00:00;7.62\n")
        f.write("\n")
    good, bad = feeds.read_transactions(spark, scratch)
    g = {r["trans_id"]: r for r in good.collect()}
    assert set(g) == {"1", "2"} and str(g["1"]["amt"]) == "7.62" and g["1"]["file_date"] == dt.date(2024, 1, 2)
    assert sorted(r["reject_reason"] for r in bad.collect()) == ["bad amount", "field count"]
    assert TX


def test_date_order_of_names(spark, scratch):
    for n in ("transactions_31032021.txt", "transactions_01042021.txt"):
        with open(os.path.join(scratch, n), "w") as f:
            f.write("h\n")
    days = [r["file_date"] for r in feeds.discover(spark, scratch).orderBy("file_date").collect()]
    assert days == [dt.date(2021, 3, 31), dt.date(2021, 4, 1)]


def test_stream_equals_batch(spark, feed_dir, loaded, bulk):
    import tempfile
    from cardwatch.streaming.feed_stream import start
    wh = _load(spark, tempfile.mkdtemp(prefix="cardwatch-wh-stream-"), bulk)
    q = start(spark, wh, feed_dir, query_name="t_stream", checkpoint=tempfile.mkdtemp(prefix="cardwatch-sq-"))
    q.awaitTermination(600)
    assert digest(wh.alerts()) == digest(loaded.alerts())
    assert digest(wh.terminals_history().select(*HIST_COLS)) == digest(loaded.terminals_history().select(*HIST_COLS))
    assert digest(wh.audit()) == digest(loaded.audit())
    assert digest(wh.blacklist()) == digest(loaded.blacklist())


def test_export_report_csv(spark, loaded, scratch):
    out = os.path.join(scratch, "rep_fraud")
    loaded.export_report(out)
    back = spark.read.option("header", True).csv(out)
    assert sorted(back.columns) == sorted(ALERT_COLS)
    assert back.count() == loaded.alerts().count()


def test_stream_restart_resumes_from_checkpoint(spark, feed_dir, loaded, bulk):
    import shutil
    import tempfile
    from cardwatch.streaming.feed_stream import start
    src = sorted((os.stat(os.path.join(feed_dir, n)).st_mtime, n) for n in os.listdir(feed_dir)
                 if n.endswith((".txt", ".csv")) and "nodate" not in n and not n.startswith("unknown"))
    half = len(src) // 2
    inbox = tempfile.mkdtemp(prefix="cardwatch-inbox-")
    ckpt = tempfile.mkdtemp(prefix="cardwatch-sq-restart-")
    wh = _load(spark, tempfile.mkdtemp(prefix="cardwatch-wh-restart-"), bulk)
    for part in (src[:half], src[half:]):
        for mtime, n in part:
            shutil.copy2(os.path.join(feed_dir, n), os.path.join(inbox, n))
        q = start(spark, wh, inbox, query_name="t_restart", checkpoint=ckpt)
        q.awaitTermination(600)
    assert digest(wh.alerts()) == digest(loaded.alerts())
    assert digest(wh.fact()) == digest(loaded.fact())


def test_command_line_run(spark, feed_dir, loaded, bulk, scratch):
    from cardwatch.__main__ import main
    dims = os.path.join(scratch, "dims")
    for name in ("cards", "accounts", "clients"):
        getattr(bulk, name).write.parquet(os.path.join(dims, name))
    days = main(["--data", feed_dir, "--warehouse", os.path.join(scratch, "wh"), "--dims", dims,
                 "--report", os.path.join(scratch, "rep"), "--report-dt", "2024-02-01"], spark=spark)
    assert days and max(days) == LAST
    back = spark.read.option("header", True).csv(os.path.join(scratch, "rep"))
    assert back.count() == loaded.alerts().count()


def test_parquet_and_csv_tabular_feeds(spark, scratch):
    import pandas as pd
    pd.DataFrame({"id": ["1", "2"], "type": ["ATM", "POS"], "city": ["X", "Y"], "addr": ["a", "b"]}) \
        .to_parquet(os.path.join(scratch, "terminals_02012024.parquet"))
    with open(os.path.join(scratch, "terminals_03012024.csv"), "w") as f:
        f.write("terminal_id,terminal_type,terminal_city,terminal_address\n3,ATM,Z,c\n")
    rows = sorted((r["snap_date"].day, r["terminal_id"], r["terminal_city"])
                  for r in feeds.read_terminals(spark, scratch).collect())
    assert rows == [(2, "1", "X"), (2, "2", "Y"), (3, "3", "Z")]


def test_parity_daily_load_equals_per_run_parity(spark, scratch, bulk):
    """Parity preset through the daily path = per-run plans with the history as of each run."""
    import tempfile
    from cardwatch.config import PARITY
    from cardwatch.operators import dims, report, rules, scd2
    from cardwatch.operators.lookback import slice_of_run
    from cardwatch.schemas import TERMINAL_ATTRS
    last = dt.date(2024, 1, 4)
    d = tempfile.mkdtemp(prefix="cardwatch-feeds-parity-")
    write_feeds(spark, SF0001, d, last)
    cfg = PARITY.with_(report_dt=FIXED_REPORT_DT)
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="cardwatch-wh-parity-"), cfg)
    wh.bootstrap(bulk.cards, bulk.accounts, bulk.clients)
    days = wh.load_folder(d)
    chain = dims.card_chain(bulk.cards, bulk.accounts, bulk.clients)
    parts = []
    for day in days:
        tx = bulk.tx.filter(F.col("file_date") <= F.lit(day))
        bl_tab = bulk.bl_table.filter(F.col("entry_dt") <= F.lit(day))
        hist = scd2.backfill(bulk.snap.filter(F.col("snap_date") <= F.lit(day)), "terminal_id", TERMINAL_ATTRS)
        runs = spark.createDataFrame([(day,)], "run_date date")
        j = rules.batch_joined(tx.filter(F.col("file_date") == F.lit(day)), dims.with_blacklist(chain, bl_tab), True)
        hops = rules.city_hop_rep(slice_of_run(tx, day, cfg.city_cut_s), hist, runs, cfg, False, True)
        hits = rules.amount_guess(slice_of_run(tx, day, cfg.amount_cut_s), runs, cfg)
        parts.append(report.build(rules.passport_contract_alerts(j, cfg.report_dt),
                                  rules.city_alerts(hops, chain, True, cfg.report_dt),
                                  rules.amount_alerts(hits, chain, True, cfg.report_dt)))
    want = parts[0]
    for p in parts[1:]:
        want = want.unionByName(p)
    got = wh.alerts().select(*ALERT_COLS)
    assert got.count() > 0
    assert digest(got) == digest(want)
