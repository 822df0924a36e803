"""Named queries: one per operator of the inventory, over the test tables.

Every query reads the Parquet tables (through the fixture views) and does
work that grows with them; none runs on made-up input. The same names have
DuckDB forms in ``cardwatch.plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.config import PARITY, Semantics
from cardwatch.functions.text import date_text_before_blank, fio
from cardwatch.operators import audit, report, rules, scd2
from cardwatch.operators.joins import not_in
from cardwatch.operators.lookback import expand_runs
from cardwatch.plans.context import Inputs
from cardwatch.schemas import (
    ALERT_COLS, BLACKLIST_FEED, FACT_COLS, HIST_COLS, TERMINAL_ATTRS, TERMINAL_SNAPSHOT, TX_TEXT_FIELDS,
)
from cardwatch.session import checkpoint_dir
from cardwatch.sources import feeds

# Fixed query parameters (same values in the DuckDB forms).
MANIFEST_THROUGH = _dt.date(2024, 1, 15)   # batches before this day are already loaded
ASOF_DAY = _dt.date(2024, 1, 5)            # day of the terminal as-of snapshot
LATE_DAY = _dt.date(2024, 1, 6)            # snapshot that comes after all others
FEED_EXT = {"passport": ".xlsx", "terminals": ".xlsx", "transactions": ".txt"}
FEED_STEM = {"passport": "passport_blacklist_", "terminals": "terminals_", "transactions": "transactions_"}

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    def run(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
        return _fn(Inputs(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    _REGISTRY[fn.__name__] = run
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# ------------------------------------------------------------------ feeds

def _file_names(x: Inputs) -> DataFrame:
    def names(days: DataFrame, feed: str) -> DataFrame:
        return days.select(F.concat(F.lit(FEED_STEM[feed]), F.date_format("d", "ddMMyyyy"),
                                    F.lit(FEED_EXT[feed])).alias("file_name"))
    parts = [names(x.bl_feed.select(F.col("file_date").alias("d")).distinct(), "passport"),
             names(x.snap.select(F.col("snap_date").alias("d")).distinct(), "terminals"),
             names(x.tx.select(F.col("file_date").alias("d")).distinct(), "transactions")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def feed_batches(x: Inputs) -> DataFrame:
    """File names of every feed day, routed by prefix, dated from the name, in batch order."""
    return feeds.route(_file_names(x))


@query
def feed_pending(x: Inputs) -> DataFrame:
    """Batches not yet in the load manifest (manifest = loads before a given day)."""
    b = feeds.route(_file_names(x))
    manifest = b.filter(F.col("file_date") < F.lit(MANIFEST_THROUGH)).select("file_name")
    return b.join(manifest, "file_name", "left_anti")


@query
def feed_refused(x: Inputs) -> DataFrame:
    """Files that the load refuses, with the reason, among each day's good, hidden, foreign and undated ones."""
    day = F.date_format("file_date", "ddMMyyyy")
    names = F.array(*[F.concat(F.lit(a), day, F.lit(b)) for a, b in (
        ("transactions_", ".txt"), (".transactions_", ".txt"), ("_tmp_", ".txt"), ("report_", ".txt"),
        ("transactions_x", ".txt"), ("terminals_", ".xlsx"), ("terminals_", ".csv"), ("passport_blacklist_", ".csv.gz"))])
    days = x.tx.select("file_date").distinct()
    files = days.select(F.explode(names).alias("name")).select(
        F.concat(F.lit("inbox/"), F.col("name")).alias("path"), F.lit(1).alias("length"), F.lit(None).alias("modificationTime"))
    return feeds.classify(files).filter("reject_reason is not null").select("file_name", "feed", "file_date", "reject_reason")


def _tx_source(x: Inputs) -> dict:
    """A transaction's text fields in source order; decimal comma on every third id."""
    amt = F.col("amt").cast("string")
    return {"trans_id": F.col("trans_id"), "transe_date": F.date_format("transe_date", "yyyy-MM-dd HH:mm:ss"),
            "amt": F.when(F.col("trans_id").cast("bigint") % 3 == 0, F.regexp_replace(amt, r"\.", ",")).otherwise(amt),
            "card_num": F.col("card_num"), "opertype": F.col("opertype"), "oper_result": F.col("oper_result"),
            "terminal": F.col("terminal")}


def _day_file(feed: str, day) -> Column:
    return F.concat(F.lit(FEED_STEM[feed]), F.date_format(day, "ddMMyyyy"), F.lit(FEED_EXT[feed])).alias("file_name")


@query
def tx_text_normalize(x: Inputs) -> DataFrame:
    """';'-lines in source field order (decimal comma on every third id) parsed back to the fact layout."""
    src = _tx_source(x)
    lines = x.tx.select(_day_file("transactions", F.col("file_date")),
                        F.concat_ws(";", *[src[c] for c in TX_TEXT_FIELDS]).alias("line"))
    parsed, _ = feeds.split_good(feeds.classify_transactions(lines), FACT_COLS)
    return parsed.select(*FACT_COLS[:-1])


@query
def tx_rejects(x: Inputs) -> DataFrame:
    """Damaged transaction lines as the load rejects them: file, line and reason, by the load's own parser."""
    src, k = _tx_source(x), F.col("trans_id").cast("bigint")
    src |= {"card_num": F.when(k % 83 == 0, F.concat(F.lit('"'), F.col("card_num"), F.lit('"'))).otherwise(src["card_num"]),
            "trans_id": F.when(k % 79 == 0, F.lit("")).otherwise(src["trans_id"]),
            "transe_date": F.when(k % 73 == 0, F.date_format("transe_date", "dd.MM.yyyy")).otherwise(src["transe_date"]),
            "amt": F.when(k % 71 == 0, F.lit("n/a")).otherwise(src["amt"])}
    line = F.concat_ws(";", *[src[c] for c in TX_TEXT_FIELDS])
    line = F.when(k % 97 == 0, F.concat(line, F.lit(";x"))).when(k % 89 == 0, F.substring_index(line, ";", 6)).otherwise(line)
    lines = x.tx.select(_day_file("transactions", F.col("file_date")), line.alias("line"))
    return feeds.split_good(feeds.classify_transactions(lines), FACT_COLS)[1]


@query
def blacklist_rejects(x: Inputs) -> DataFrame:
    """Damaged passport rows as the load rejects them: no passport, or another number of fields."""
    k = F.substring("passport_num", 2, 20).cast("bigint")
    num = F.when(k % 3 == 0, F.lit("")).otherwise(F.col("passport_num"))
    line = F.concat_ws(",", F.col("source_date"), num)
    lines = x.bl_feed.select(_day_file("passport", F.col("file_date")),
                             F.when(k % 5 == 0, F.concat(line, F.lit(",x"))).otherwise(line).alias("line"))
    rows = feeds.parse_lines(lines, BLACKLIST_FEED.fieldNames(), ",", '"')
    return feeds.split_good(feeds.classify_blacklist(rows), ["passport_num"])[1]


@query
def terminal_rejects(x: Inputs) -> DataFrame:
    """Damaged snapshot rows as the load rejects them: no terminal, or another number of fields."""
    k = F.col("terminal_id").cast("bigint") + F.dayofmonth("snap_date")
    tid = F.when(k % 7 == 0, F.lit(" ")).otherwise(F.col("terminal_id"))
    line = F.concat_ws(",", tid, F.col("terminal_type"), F.concat(F.lit('"'), F.col("terminal_city"), F.lit('"')),
                       F.when(k % 11 != 0, F.col("terminal_address")))
    lines = x.snap.select(_day_file("terminals", F.col("snap_date")), line.alias("line"))
    rows = feeds.parse_lines(lines, TERMINAL_SNAPSHOT.fieldNames(), ",", '"')
    return feeds.split_good(feeds.classify_terminals(rows), ["terminal_id"])[1]


@query
def blacklist_feed(x: Inputs) -> DataFrame:
    """Blacklist feed rows with the date part of the source date text."""
    return x.bl_feed.select("passport_num", date_text_before_blank("source_date").alias("source_entry_dt"),
                            "file_date")


@query
def terminal_snapshot(x: Inputs) -> DataFrame:
    return x.snap


# ------------------------------------------------------------------ tables

@query
def dim_cards(x: Inputs) -> DataFrame:
    return x.cards


@query
def dim_accounts(x: Inputs) -> DataFrame:
    return x.accounts


@query
def dim_clients(x: Inputs) -> DataFrame:
    return x.clients


@query
def fact_transactions(x: Inputs) -> DataFrame:
    return x.tx


@query
def daily_slice(x: Inputs) -> DataFrame:
    """Per batch day: rows, withdrawals, rejects and the amount total of the staged file."""
    return x.tx.groupBy("file_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum((F.col("opertype") == "WITHDRAW").cast("bigint")).alias("n_withdraw"),
        F.sum((F.col("oper_result") == "REJECT").cast("bigint")).alias("n_reject"),
        F.sum("amt").cast("decimal(38,2)").alias("amt_total"))


@query
def client_fio(x: Inputs) -> DataFrame:
    c = x.clients
    return c.select("client_id", fio("last_name", "first_name", "patronymic").alias("fio"), "phone", "passport_num")


# ------------------------------------------------------------------ joins

@query
def client_chain(x: Inputs) -> DataFrame:
    j = x.batch_joined(alerts_only=False)
    return j.select("trans_id", "card_num", "client_id", "passport_num", "fio", "bl_entry_dt")


def _terminal_join(x: Inputs, asof: bool) -> DataFrame:
    """The 1-hour slice joined to terminal versions (as the city rule sees it)."""
    t = _slice(x, x.cfg.city_cut_s).select("run_date", "trans_id", "card_num", "transe_date", "terminal")
    j = rules.with_terminal(t, x.hist, asof, x.hist_check, every_version=True)
    return j.select("run_date", "trans_id", "card_num", "transe_date", "terminal", "terminal_city", "effective_from")


@query
def terminal_join_all(x: Inputs) -> DataFrame:
    return _terminal_join(x, asof=False)


@query
def terminal_join_asof(x: Inputs) -> DataFrame:
    return _terminal_join(x, asof=True)


# ------------------------------------------------------------------ slices

def _slice(x: Inputs, cut_s: int) -> DataFrame:
    w = x.tx.filter(F.col("opertype") == "WITHDRAW")
    return expand_runs(w, x.runs, cut_s).select("run_date", *FACT_COLS)


@query
def lookback_1h(x: Inputs) -> DataFrame:
    return _slice(x, x.cfg.city_cut_s)


@query
def lookback_20m(x: Inputs) -> DataFrame:
    return _slice(x, x.cfg.amount_cut_s)


# ------------------------------------------------------------------ blacklist

@query
def blacklist_new(x: Inputs) -> DataFrame:
    return x.bl_new.select("passport_num", "file_date")


@query
def blacklist_merge_last_day(x: Inputs) -> DataFrame:
    """Incremental path: the table of all earlier feeds plus ``merge_day`` of the newest feed."""
    from cardwatch.operators import blacklist as bl
    last = _last(x, x.bl_feed, "file_date", "bl_feed")
    before = bl.table_from_new(bl.new_entries(x.bl_feed.filter(F.col("file_date") < F.lit(last))),
                               source_col=None)
    _, rows = bl.merge_day(before, x.bl_feed.filter(F.col("file_date") == F.lit(last)), last)
    return before.unionByName(rows.select("passport_num", "entry_dt"))


@query
def blacklist_not_in(x: Inputs) -> DataFrame:
    """Feed rows whose passport is NOT IN the earlier entries, three-valued: a plain table, one that holds NULLs
    (and copies), and an empty one."""
    k = F.substring("passport_num", 2, 20).cast("bigint")
    num = F.when(k % 4 == 0, F.lit(None)).otherwise(F.col("passport_num")).alias("passport_num")
    cut = F.col("file_date") < F.lit(MANIFEST_THROUGH)
    known = x.bl_feed.filter(cut).select(num)
    feed = x.bl_feed.filter(~cut).select(num, "file_date")
    tables = {"plain": known.filter("passport_num is not null"), "nulls": known, "empty": known.limit(0)}
    parts = [not_in(feed, t, "passport_num").select(F.lit(name).alias("variant"), "passport_num", "file_date")
             for name, t in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def blacklist_table(x: Inputs) -> DataFrame:
    return x.bl_table.select("passport_num", "entry_dt", date_text_before_blank("source_entry_dt").alias("source_entry_dt"))


# ------------------------------------------------------------------ SCD2

@query
def scd2_history(x: Inputs) -> DataFrame:
    return x.hist.select(*HIST_COLS)


def _changes(x: Inputs, *kinds: str) -> DataFrame:
    return x.changes.filter(F.col("change").isin(*kinds)).select(
        "change_date", "terminal_id", "terminal_type", "terminal_city", "terminal_address", "change")


@query
def scd2_history_fold(x: Inputs) -> DataFrame:
    """History by replaying the daily merge (parity preset) over the snapshot days."""
    hist, _ = scd2.fold(x.spark, x.snap, "terminal_id", list(TERMINAL_ATTRS), "snap_date", Semantics.PARITY)
    return hist.select(*HIST_COLS)


def _last(x: Inputs, df: DataFrame, col: str, name: str):
    """Newest batch day of an input (one value)."""
    return df.agg(F.max(col)).first()[0]


@query
def scd2_merge_last_day(x: Inputs) -> DataFrame:
    """Incremental path: history of all earlier days, then ``merge_day`` of the newest snapshot."""
    last = _last(x, x.snap, "snap_date", "snap")
    before = x.snap.filter(F.col("snap_date") < F.lit(last))
    hist = scd2.backfill(before, "terminal_id", list(TERMINAL_ATTRS))
    today = x.snap.filter(F.col("snap_date") == F.lit(last))
    merged, _ = scd2.merge_day(hist, today, last, "terminal_id", list(TERMINAL_ATTRS))
    return merged.select(*HIST_COLS)


@query
def scd2_late_snapshot(x: Inputs) -> DataFrame:
    """The history without one day's snapshot, then that day spliced in: the same as all days in order."""
    days = [r["d"] for r in x.snap.select(F.col("snap_date").alias("d")).distinct().collect()]  # the calendar
    before, after = max(d for d in days if d < LATE_DAY), min(d for d in days if d > LATE_DAY)
    hist = scd2.backfill(x.snap.filter(F.col("snap_date") != F.lit(LATE_DAY)), "terminal_id", list(TERMINAL_ATTRS))
    late = x.snap.filter(F.col("snap_date") == F.lit(LATE_DAY))
    found = scd2.splice(hist, late, LATE_DAY, before, after, "terminal_id", TERMINAL_ATTRS)
    return scd2.spliced(hist, found, "terminal_id", TERMINAL_ATTRS).select(*HIST_COLS)


@query
def scd2_new(x: Inputs) -> DataFrame:
    return _changes(x, scd2.NEW, scd2.RETURNED)


@query
def scd2_deleted(x: Inputs) -> DataFrame:
    return _changes(x, scd2.DELETED)


@query
def scd2_updated(x: Inputs) -> DataFrame:
    return _changes(x, scd2.UPDATED)


@query
def scd2_resurrected(x: Inputs) -> DataFrame:
    return _changes(x, scd2.RETURNED)


@query
def scd2_current(x: Inputs) -> DataFrame:
    return scd2.current(x.hist).select(*HIST_COLS)


@query
def scd2_asof(x: Inputs) -> DataFrame:
    return scd2.as_of(x.hist, ASOF_DAY).select(*HIST_COLS)


# ------------------------------------------------------------------ rule parts

@query
def city_first_visit(x: Inputs) -> DataFrame:
    return rules.city_first_visits(x.tx, x.hist, x.runs, x.cfg, True, x.hist_check)


@query
def city_running_count(x: Inputs) -> DataFrame:
    return rules.city_running_count(rules.city_first_visits(x.tx, x.hist, x.runs, x.cfg, True, x.hist_check))


@query
def city_hop_rep(x: Inputs) -> DataFrame:
    return rules.city_hop_rep(x.tx, x.hist, x.runs, x.cfg, True, x.hist_check)


@query
def city_hop_rep_all(x: Inputs) -> DataFrame:
    return rules.city_hop_rep(x.tx, x.hist, x.runs, x.cfg, False, x.hist_check)


@query
def city_hop_pair(x: Inputs) -> DataFrame:
    return rules.city_hop_pair(x.tx, x.hist, x.runs, x.cfg, True, x.hist_check)


@query
def city_hop_pair_all(x: Inputs) -> DataFrame:
    return rules.city_hop_pair(x.tx, x.hist, x.runs, x.cfg, False, x.hist_check)


@query
def amount_guess(x: Inputs) -> DataFrame:
    return rules.amount_guess(x.tx, x.runs, x.cfg, "decreasing")


@query
def amount_guess_literal(x: Inputs) -> DataFrame:
    return rules.amount_guess(x.tx, x.runs, x.cfg, "literal")


@query
def amount_guess_pattern(x: Inputs) -> DataFrame:
    return rules.amount_guess(x.tx, x.runs, x.cfg, "none")


#: minutes, days, months: the finest spreads a card's crowded hour, the last leaves few buckets a card
CARRY = (60, 86_400, 30 * 86_400)


@query
def city_hop_pair_carry(x: Inputs) -> DataFrame:
    """Rule 3's pairs by the scan that carries the last row over each bucket's boundary."""
    return rules.city_hop_pair(x.tx, x.hist, x.runs, x.cfg.with_(carry_buckets_s=CARRY), True, x.hist_check)


@query
def amount_guess_carry(x: Inputs) -> DataFrame:
    """Rule 4's hits by the scan that carries the last rows over each bucket's boundary."""
    return rules.amount_guess(x.tx, x.runs, x.cfg.with_(carry_buckets_s=CARRY), "decreasing")


# ------------------------------------------------------------------ rules

@query
def fraud_passport(x: Inputs) -> DataFrame:
    return rules.passport_alerts(x.batch_joined(), x.cfg.report_dt)


@query
def fraud_contract(x: Inputs) -> DataFrame:
    return rules.contract_alerts(x.batch_joined(), x.cfg.report_dt)


def _city(x: Inputs, parity: bool, chain: DataFrame | None = None, timeline: DataFrame | None = None) -> DataFrame:
    if parity:
        hops = rules.city_hop_rep(x.tx, x.hist, x.runs, x.cfg, False, x.hist_check)
    else:
        hops = rules.city_hop_pair(x.tx, x.hist, x.runs, x.cfg, True, x.hist_check, timeline)
    return rules.city_alerts(hops, x.chain if chain is None else chain, x.chain_check, x.cfg.report_dt)


def _amount(x: Inputs, parity: bool, chain: DataFrame | None = None, timeline: DataFrame | None = None) -> DataFrame:
    hits = rules.amount_guess(x.tx, x.runs, x.cfg, "literal" if parity else "decreasing", timeline)
    return rules.amount_alerts(hits, x.chain if chain is None else chain, x.chain_check, x.cfg.report_dt)


@query
def fraud_city(x: Inputs) -> DataFrame:
    """Rule 3, intended: pair form over as-of terminal versions."""
    return _city(x, parity=False)


@query
def fraud_city_parity(x: Inputs) -> DataFrame:
    """Rule 3, literal: representative form over all terminal versions."""
    return _city(x, parity=True)


@query
def fraud_amount(x: Inputs) -> DataFrame:
    return _amount(x, parity=False)


@query
def fraud_amount_parity(x: Inputs) -> DataFrame:
    return _amount(x, parity=True)


@query
def fraud_last_run(x: Inputs) -> DataFrame:
    """All rules for the newest batch day through the daily path (as the warehouse load runs them)."""
    from cardwatch.operators.lookback import slice_of_run
    last = _last(x, x.tx, "file_date", "tx")
    runs = x.spark.createDataFrame([(last,)], "run_date date")
    staged = x.tx.filter(F.col("file_date") == F.lit(last))
    pc = rules.passport_contract_alerts(rules.batch_joined(staged, x.chain_bl, x.chain_check, True), x.cfg.report_dt)
    recent = slice_of_run(x.tx, last, min(x.cfg.city_cut_s, x.cfg.amount_cut_s)).drop("run_date")
    both = rules.city_amount_alerts(recent, x.hist, runs, x.chain_bl, x.cfg, x.chain_check, x.cfg.report_dt,
                                    x.hist_check)
    return report.build(pc, both)


# ------------------------------------------------------------------ output

def full_report(x: Inputs, parity: bool = False) -> DataFrame:
    """All rules; the joins to the card chain share one chain plan, and (intended preset,
    broadcastable history) rules 3 and 4 share one shuffle of the withdrawals."""
    pc = rules.passport_contract_alerts(x.batch_joined(), x.cfg.report_dt)
    if not parity and x.hist_check.ok:
        both = rules.city_amount_alerts(x.tx, x.hist, x.runs, x.chain_bl, x.cfg, x.chain_check, x.cfg.report_dt,
                                        x.hist_check)
        return report.build(pc, both)
    return report.build(pc, _city(x, parity, x.chain_bl), _amount(x, parity, x.chain_bl))


@query
def fraud_report(x: Inputs) -> DataFrame:
    """All four rules, intended preset, as one accumulated report."""
    return full_report(x)


@query
def fraud_report_export(x: Inputs) -> DataFrame:
    """The exported report files, read back: the whole report, six columns."""
    folder = f"{checkpoint_dir(x.spark)}/report-{uuid.uuid4().hex}"
    report.export(full_report(x), folder, order=report.EXPORT_ORDER)
    return report.read_export(x.spark, folder).select(*ALERT_COLS)


@query
def fraud_report_parity(x: Inputs) -> DataFrame:
    return full_report(x, parity=True)


@query
def fraud_report_dedup(x: Inputs) -> DataFrame:
    return report.dedup(full_report(x))


def _audit(x: Inputs) -> DataFrame:
    return (audit.fact_counts(x.tx)
            .unionByName(audit.blacklist_counts(x.bl_feed, x.bl_new))
            .unionByName(audit.terminal_counts(x.snap, x.changes)))


@query
def audit_counts(x: Inputs) -> DataFrame:
    return _audit(x)


@query
def audit_report(x: Inputs) -> DataFrame:
    """Audit rows as text, 'not exists' where a count does not apply."""
    return audit.render(_audit(x))


__all__ = ["registry", "PARITY", "Semantics"]
