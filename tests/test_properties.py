"""Property tests: the split timeline equals the plain per-key window; bulk rules equal per-run slices."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardwatch.config import DEFAULT
from cardwatch.functions.timefn import seconds_between
from cardwatch.operators import report, rules
from cardwatch.operators.lookback import run_dates, slice_of_run
from cardwatch.operators.timeline import bounded_lags
from helpers import digest, fact_rows

BASE = dt.datetime(2024, 1, 5, 22, 0, 0)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

timeline = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3 * 3600), st.sampled_from(["R", "S"]),
                              st.integers(1, 9)), min_size=1, max_size=40)


def _tx(spark, rows):
    out = []
    for i, (card, off, res, amt) in enumerate(rows):
        out.append((f"{i:04d}", BASE + dt.timedelta(seconds=off), f"C{card}", "WITHDRAW", amt * 100,
                    "REJECT" if res == "R" else "SUCCESS", "A"))
    return fact_rows(spark, out)


@SETTINGS
@given(rows=timeline, span=st.sampled_from([60, 600, 1200]), mult=st.sampled_from([1, 2, 4]))
def test_bounded_lags_equal_plain_window(spark, rows, span, mult):
    tx = _tx(spark, rows)
    lags = {"p1": ("transe_date", 1), "p3": ("transe_date", 3), "r2": ("oper_result", 2)}
    got = bounded_lags(tx, ["card_num"], ["transe_date", "trans_id"], "transe_date", span, span * mult, lags)
    w = Window.partitionBy("card_num").orderBy("transe_date", "trans_id")
    want = tx.withColumns({k: F.lag(c, n).over(w) for k, (c, n) in lags.items()})
    # exact wherever the lag row lies within the span; compare on those rows
    ok = seconds_between("transe_date", "p3") <= span
    for k in lags:
        g = got.filter(ok).select("trans_id", k)
        wv = want.filter(ok).select("trans_id", k)
        assert digest(g) == digest(wv)
    assert got.count() == tx.count()


@SETTINGS
@given(rows=timeline)
def test_bulk_amount_rule_equals_per_run_slices(spark, rows):
    tx = _tx(spark, rows)
    runs = run_dates(tx)
    bulk = rules.amount_guess(tx, runs, DEFAULT, "none")
    parts = []
    for (d,) in runs.collect():
        s = slice_of_run(tx, d, DEFAULT.amount_cut_s)
        one = spark.createDataFrame([(d,)], "run_date date")
        parts.append(rules.amount_guess(s.drop("run_date"), one, DEFAULT, "none"))
    per_run = parts[0]
    for p in parts[1:]:
        per_run = per_run.unionByName(p)
    assert digest(bulk) == digest(per_run)


def test_dedup_idempotent(spark):
    from conftest import SF0001
    import __spark_entry__ as E
    r = E.queries()["fraud_report"](spark, SF0001)
    once = report.dedup(r)
    assert digest(report.dedup(once)) == digest(once)


snapshots = st.lists(  # per day: which of 4 terminals are present, and their city
    st.lists(st.tuples(st.booleans(), st.sampled_from(["X", "Y"])), min_size=4, max_size=4),
    min_size=1, max_size=4)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=snapshots)
def test_scd2_closed_form_equals_fold(spark, days):
    from cardwatch.operators import scd2
    from cardwatch.schemas import HIST_COLS, TERMINAL_ATTRS
    rows = []
    for i, day in enumerate(days):
        for t, (present, city) in enumerate(day):
            if present:
                rows.append((dt.date(2024, 1, 1 + i), str(t), "ATM", city, "a"))
    if not rows:
        return
    snap = spark.createDataFrame(rows, "snap_date date, terminal_id string, terminal_type string, "
                                       "terminal_city string, terminal_address string")
    closed = scd2.backfill(snap, "terminal_id", TERMINAL_ATTRS)
    folded, _ = scd2.fold(spark, snap, "terminal_id", TERMINAL_ATTRS)
    assert digest(closed.select(*HIST_COLS)) == digest(folded.select(*HIST_COLS))


city_timeline = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30 * 3600), st.sampled_from(["A", "B"])),
                         min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=city_timeline)
def test_bulk_city_pair_equals_per_run_slices(spark, rows):
    from cardwatch.schemas import TERMINALS_HIST
    sent = dt.datetime(2999, 12, 31, 23, 59, 59)
    hist = spark.createDataFrame([("A", "ATM", "CityA", "a", dt.date(2024, 1, 1), sent, 0),
                                  ("B", "ATM", "CityB", "b", dt.date(2024, 1, 1), sent, 0)], TERMINALS_HIST)
    tx = fact_rows(spark, [(f"{i:04d}", BASE + dt.timedelta(seconds=off), f"C{card}", "WITHDRAW", 1, "SUCCESS", term)
                           for i, (card, off, term) in enumerate(rows)])
    runs = run_dates(tx)
    bulk = rules.city_hop_pair(tx, hist, runs, DEFAULT, True, True)
    parts = []
    for (d,) in runs.collect():
        s = slice_of_run(tx, d, DEFAULT.city_cut_s).drop("run_date")
        one = spark.createDataFrame([(d,)], "run_date date")
        parts.append(rules.city_hop_pair(s, hist, one, DEFAULT, True, True))
    per_run = parts[0]
    for p in parts[1:]:
        per_run = per_run.unionByName(p)
    assert digest(bulk) == digest(per_run)


mixed_timeline = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30 * 3600), st.sampled_from(["A", "B", "Z"]),
                                    st.sampled_from(["R", "S"]), st.integers(1, 9)), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=mixed_timeline)
def test_shared_shuffle_equals_separate_rules(spark, rows):
    from cardwatch.schemas import TERMINALS_HIST
    from helpers import one_client
    from cardwatch.operators import dims
    sent = dt.datetime(2999, 12, 31, 23, 59, 59)
    # terminal Z has no valid version: its operations count for rule 4 but not for rule 3
    hist = spark.createDataFrame([("A", "ATM", "CityA", "a", dt.date(2024, 1, 1), sent, 0),
                                  ("B", "ATM", "CityB", "b", dt.date(2024, 1, 1), sent, 0),
                                  ("Z", "ATM", "CityZ", "z", dt.date(2024, 1, 1), sent, 1)], TERMINALS_HIST)
    tx = fact_rows(spark, [(f"{i:04d}", BASE + dt.timedelta(seconds=off), f"C{card}", "WITHDRAW", amt * 100,
                            "REJECT" if res == "R" else "SUCCESS", term)
                           for i, (card, off, term, res, amt) in enumerate(rows)])
    cards, accounts, clients = one_client(spark, card="C0")
    chain = dims.card_chain(cards.unionByName(spark.createDataFrame([("C1", "A1", None, None)], cards.schema)),
                            accounts, clients)
    runs = run_dates(tx)
    rd = dt.date(2024, 2, 1)
    both = rules.city_amount_alerts(tx, hist, runs, chain, DEFAULT, True, rd, True)
    sep = report.build(
        rules.city_alerts(rules.city_hop_pair(tx, hist, runs, DEFAULT, True, True), chain, True, rd),
        rules.amount_alerts(rules.amount_guess(tx, runs, DEFAULT, "decreasing"), chain, True, rd))
    assert digest(both) == digest(sep)
