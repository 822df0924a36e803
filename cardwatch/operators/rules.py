"""The four fraud rules as DataFrame plans over all batches at once.

Batch semantics kept: rules 1 and 2 look at the operations of a batch day;
rules 3 and 4 look at a lookback slice per batch (withdrawals after the cut
of the previous day), so a pair near midnight can alert in two runs.

Rules 3 and 4 never explode the fact per run before their windows: lags are
computed once on each card's whole timeline (split into time buckets with a
lookback halo, see ``timeline``), and a hit is then assigned to every run
whose slice holds both ends of the pattern. A slice is a contiguous time
interval, so this equals evaluating each run's slice on its own.

``city_amount_alerts`` runs rules 3 (pair form, as-of) and 4 as one
pipeline over a single shuffle of the withdrawals; the per-rule functions
remain for the named queries and the parity preset.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.config import (
    EVENT_AMOUNT, EVENT_CITY, EVENT_CONTRACT, EVENT_PASSPORT, OPER_WITHDRAW, RESULT_REJECT,
    RESULT_SUCCESS, RuleConfig, Semantics,
)
from cardwatch.functions.timefn import seconds_between
from cardwatch.operators.joins import BroadcastCheck, dim_join, may_join
from cardwatch.operators.lookback import expand_runs, runs_covering
from cardwatch.operators.timeline import bounded_lags, carried_lags, halo_buckets, home_rows, lags_in_buckets
from cardwatch.schemas import ALERT_COLS


def _report_dt(report_dt: _dt.date | None) -> Column:
    return F.lit(report_dt).cast("date") if report_dt is not None else F.current_date()


def alert_rows(df: DataFrame, event_dt: Column, event_type: str, report_dt) -> DataFrame:
    return df.select(event_dt.alias("event_dt"), F.col("passport_num").alias("passport"), "fio", "phone",
                     F.lit(event_type).alias("event_type"), _report_dt(report_dt).alias("report_dt"))


# ---------------------------------------------------------------- rules 1, 2

def expired_passport(ts: Column, valid_to: Column) -> Column:
    """Operation on or after the passport's last valid day (NULL: never expires)."""
    return F.coalesce(F.to_date(ts) >= valid_to, F.lit(False))


def listed_passport(bl_entry_dt: Column, batch_day: Column) -> Column:
    return F.coalesce(bl_entry_dt <= batch_day, F.lit(False))


def may_alert(chain_bl: DataFrame, tx: DataFrame) -> DataFrame:
    """Cards of the chain that rules 1 and 2 can raise at all: a passport, contract or list entry dated by the last
    day of ``tx`` (its last operation or batch day). Every hit of the two rules implies this."""
    last = tx.agg(F.max(F.greatest(F.to_date("transe_date"), "file_date")).alias("d")).scalar()
    return chain_bl.filter((F.col("passport_valid_to") <= last) | (F.col("valid_to") <= last)
                           | (F.col("bl_entry_dt") <= last))


def batch_joined(tx: DataFrame, chain_bl: DataFrame, chain_check: BroadcastCheck | bool | None = None,
                 alerts_only: bool = False) -> DataFrame:
    """Operations of every batch joined to the card chain (one join for rules 1 and 2).

    ``alerts_only``: rows that neither rule can raise may be missing. When the chain is too large for a broadcast,
    both sides of the shuffle join are then cut to the cards that can alert, the operations by a Bloom filter.
    """
    t = tx.select("trans_id", "card_num", "transe_date", "file_date")
    if alerts_only and not (chain_check.ok if isinstance(chain_check, BroadcastCheck) else chain_check):
        chain_bl = may_alert(chain_bl, t)
        t = may_join(t, chain_bl.select("card_num"), "card_num")
    return dim_join(t, chain_bl, "card_num", check=chain_check)


def passport_hits(joined: DataFrame) -> Column:
    return (expired_passport(F.col("transe_date"), F.col("passport_valid_to"))
            | listed_passport(F.col("bl_entry_dt"), F.col("file_date")))


def contract_hits(joined: DataFrame) -> Column:
    return F.coalesce(F.to_date("transe_date") >= F.col("valid_to"), F.lit(False))


def passport_alerts(joined: DataFrame, report_dt=None) -> DataFrame:
    """Rule 1: operation under an expired or blacklisted passport (event_dt = batch day)."""
    return alert_rows(joined.filter(passport_hits(joined)), F.col("file_date"), EVENT_PASSPORT, report_dt)


def contract_alerts(joined: DataFrame, report_dt=None) -> DataFrame:
    """Rule 2: operation under an expired contract (event_dt = batch day)."""
    return alert_rows(joined.filter(contract_hits(joined)), F.col("file_date"), EVENT_CONTRACT, report_dt)


def passport_contract_alerts(joined: DataFrame, report_dt=None) -> DataFrame:
    """Rules 1 and 2 from one pass: each row yields 0, 1 or 2 alerts."""
    types = F.array_compact(F.array(
        F.when(passport_hits(joined), F.lit(EVENT_PASSPORT)),
        F.when(contract_hits(joined), F.lit(EVENT_CONTRACT))))
    x = joined.withColumn("_type", F.explode(types))
    return x.select(F.col("file_date").alias("event_dt"), F.col("passport_num").alias("passport"), "fio",
                    "phone", F.col("_type").alias("event_type"), _report_dt(report_dt).alias("report_dt"))


# ---------------------------------------------------------------- terminals

def with_terminal(tx: DataFrame, hist: DataFrame, asof: bool,
                  hist_check: BroadcastCheck | bool | None = None, every_version: bool = False) -> DataFrame:
    """Join operations to terminal versions.

    ``asof``: the non-deleted version valid on the operation's day (an
    equi-join on the terminal plus an interval condition, so it stays a hash
    join). Otherwise every version of the terminal matches, tombstones too;
    for the rules only the distinct cities of a terminal matter (a repeated
    city neither changes a first visit nor makes a city change between
    sorted copies), so unless ``every_version`` the history is first reduced
    to distinct (terminal, city) pairs, which cuts the fan-out.
    """
    if asof:
        h = hist.filter(F.col("deleted_flg") == 0).select(
            F.col("terminal_id"), "terminal_city", "effective_from", F.to_date("effective_to").alias("_to_day"))
        cond = ((F.col("terminal") == F.col("terminal_id"))
                & (F.col("effective_from") <= F.to_date("transe_date"))
                & (F.to_date("transe_date") <= F.col("_to_day")))
        return dim_join(tx, h, cond, check=hist_check).drop("terminal_id", "_to_day")
    if every_version:
        h = hist.select("terminal_id", "terminal_city", "effective_from")
    else:
        h = hist.select("terminal_id", "terminal_city").distinct()
    return dim_join(tx, h, F.col("terminal") == F.col("terminal_id"), check=hist_check).drop("terminal_id")


def _withdrawals(tx: DataFrame) -> DataFrame:
    return tx.filter(F.col("opertype") == OPER_WITHDRAW).select(
        "trans_id", "transe_date", "card_num", "amt", "oper_result", "terminal")


# ---------------------------------------------------------------- rule 3

def city_first_visits(tx: DataFrame, hist: DataFrame, runs: DataFrame, cfg: RuleConfig,
                      asof: bool | None = None, hist_check=None) -> DataFrame:
    """Per run, card and city the first operation time in the 1-hour slice.

    Grouped by terminal (and day, as versions hold for whole days) before the terminals are joined: a version
    match then meets one row a card, terminal and day, so the fan-out over versions and their cities never
    multiplies the operations themselves. Both groupings pre-aggregate map-side, so a hot card shrinks before
    any shuffle.
    """
    asof = (cfg.semantics == Semantics.INTENDED) if asof is None else asof
    w = expand_runs(_withdrawals(tx).select("card_num", "terminal", "transe_date"), runs, cfg.city_cut_s)
    first = w.groupBy("run_date", "card_num", "terminal", F.to_date("transe_date").alias("_d")).agg(
        F.min("transe_date").alias("transe_date"))
    j = with_terminal(first.drop("_d"), hist, asof, hist_check)
    return j.groupBy("run_date", "card_num", "terminal_city").agg(F.min("transe_date").alias("transe_date"))


def city_running_count(first_visits: DataFrame) -> DataFrame:
    """Running number of cities per card (ties share) and its per-card total."""
    w_run = Window.partitionBy("run_date", "card_num").orderBy("transe_date")
    w_all = Window.partitionBy("run_date", "card_num")
    x = first_visits.withColumn("cnt", F.count(F.lit(1)).over(w_run))
    return x.withColumn("sum_cnt", F.sum("cnt").over(w_all))


def city_hop_rep(tx: DataFrame, hist: DataFrame, runs: DataFrame, cfg: RuleConfig,
                 asof: bool | None = None, hist_check=None) -> DataFrame:
    """Rule 3, representative form: consecutive first visits of two cities within the gap.

    The per-card window runs over at most one row per city and run.
    """
    fv = city_first_visits(tx, hist, runs, cfg, asof, hist_check)
    w = Window.partitionBy("run_date", "card_num").orderBy("transe_date", "terminal_city")
    x = city_running_count(fv).withColumn("prev_transe_date", F.lag("transe_date").over(w))
    x = x.withColumn("gap_s", seconds_between("transe_date", "prev_transe_date"))
    return (x.filter((F.col("sum_cnt") > 2) & (F.col("gap_s") <= cfg.city_max_gap_s))
             .select("run_date", "card_num", "terminal_city", "transe_date", "prev_transe_date", "gap_s"))


def withdrawal_timeline(tx: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Withdrawals bucketed for both windowed rules and shuffled once by (card, bucket).

    The halo covers the longer of the two lookback spans, so rule 3 (after a
    broadcast terminal join, which keeps the partitioning) and rule 4 read
    the same shuffle output.
    """
    span = max(cfg.city_max_gap_s, cfg.amount_max_span_s)
    bucket = max(cfg.city_bucket_s, cfg.amount_bucket_s, span)
    return halo_buckets(_withdrawals(tx), "transe_date", span, bucket, keys=["card_num"])


def city_hop_pair(tx: DataFrame, hist: DataFrame, runs: DataFrame, cfg: RuleConfig,
                  asof: bool | None = None, hist_check=None, timeline: DataFrame | None = None) -> DataFrame:
    """Rule 3, pair form: an operation in another city than the card's previous one within the gap.

    ``timeline`` (from ``withdrawal_timeline``) lets rule 3 share rule 4's shuffle.
    """
    asof = (cfg.semantics == Semantics.INTENDED) if asof is None else asof
    lags = {"prev_city": ("terminal_city", 1), "prev_transe_date": ("transe_date", 1)}
    order = ["transe_date", "trans_id", "terminal_city"]
    if timeline is not None:
        x = home_rows(lags_in_buckets(with_terminal(timeline, hist, asof, hist_check), ["card_num"], order, lags))
    else:
        j = with_terminal(_withdrawals(tx), hist, asof, hist_check)
        if cfg.carry_buckets_s:
            x = carried_lags(j, ["card_num"], order, "transe_date", lags, cfg.carry_buckets_s)
        else:
            x = bounded_lags(j, ["card_num"], order, "transe_date", cfg.city_max_gap_s, cfg.city_bucket_s, lags)
    x = x.withColumn("gap_s", seconds_between("transe_date", "prev_transe_date"))
    hit = (F.col("prev_city") != F.col("terminal_city")) & (F.col("gap_s") <= cfg.city_max_gap_s)
    x = runs_covering(x.filter(hit), runs, cfg.city_cut_s, "prev_transe_date", "transe_date")
    return x.select("run_date", "card_num", "trans_id", "transe_date", "terminal_city", "prev_city",
                    "prev_transe_date", "gap_s")


def city_alerts(hops: DataFrame, chain: DataFrame, chain_check=None, report_dt=None) -> DataFrame:
    j = dim_join(hops, chain, "card_num", check=chain_check)
    return alert_rows(j, F.to_date("transe_date"), EVENT_CITY, report_dt)


# ---------------------------------------------------------------- rule 4

def amount_chain(amt: Column, prev: list[Column], mode: str) -> Column:
    """Amount test over the current and previous amounts (most recent first).

    ``decreasing``: each attempt lower than the one before it.
    ``literal``: the chained comparison read left to right with 0/1 results,
    ``((amt < a1) < a2) < a3``.
    ``none``: no amount test.
    """
    if mode == "none":
        return F.lit(True)
    if mode == "decreasing":
        seq = [amt, *prev]
        out = F.lit(True)
        for a, b in zip(seq, seq[1:]):
            out = out & (a < b)
        return out
    if mode == "literal":
        acc = amt < prev[0]
        for b in prev[1:]:
            acc = acc.cast("int") < b
        return acc
    raise ValueError(mode)


def amount_guess(tx: DataFrame, runs: DataFrame, cfg: RuleConfig, amount_mode: str | None = None,
                 timeline: DataFrame | None = None) -> DataFrame:
    """Rule 4: a success right after ``n`` rejected withdrawals, all within the span."""
    n = cfg.amount_n_rejects
    mode = amount_mode or ("decreasing" if cfg.semantics == Semantics.INTENDED else "literal")
    lags = {}
    for i in range(1, n + 1):
        lags[f"_r{i}"] = ("oper_result", i)
        lags[f"_a{i}"] = ("amt", i)
    lags["_t_first"] = ("transe_date", n)
    order = ["transe_date", "trans_id"]
    if cfg.carry_buckets_s and timeline is None:
        x = carried_lags(_withdrawals(tx), ["card_num"], order, "transe_date", lags, cfg.carry_buckets_s)
    else:
        x = bounded_lags(_withdrawals(tx), ["card_num"], order, "transe_date",
                         cfg.amount_max_span_s, cfg.amount_bucket_s, lags, bucketed=timeline)
    hit = (F.col("oper_result") == RESULT_SUCCESS)
    for i in range(1, n + 1):
        hit = hit & (F.col(f"_r{i}") == RESULT_REJECT)
    hit = hit & (seconds_between("transe_date", "_t_first") < cfg.amount_max_span_s)
    hit = hit & amount_chain(F.col("amt"), [F.col(f"_a{i}") for i in range(1, n + 1)], mode)
    x = runs_covering(x.filter(hit), runs, cfg.amount_cut_s, "_t_first", "transe_date")
    return x.select("run_date", "card_num", "trans_id", "transe_date", "amt",
                    F.col("_t_first").alias("first_reject_date"))


def amount_alerts(hits: DataFrame, chain: DataFrame, chain_check=None, report_dt=None) -> DataFrame:
    j = dim_join(hits, chain, "card_num", check=chain_check)
    return alert_rows(j, F.to_date("transe_date"), EVENT_AMOUNT, report_dt)


# ---------------------------------------------------------------- rules 3 + 4, one shuffle

def city_amount_alerts(tx: DataFrame, hist: DataFrame, runs: DataFrame, chain: DataFrame, cfg: RuleConfig,
                       chain_check=None, report_dt=None, hist_check: BroadcastCheck | bool = True) -> DataFrame:
    """Rules 3 (pair form, as-of terminals) and 4 from a single shuffle of the withdrawals.

    One pipeline without branches: bucketed timeline shuffled by
    (card, bucket) -> rule 4 lags -> as-of broadcast left join to terminal
    versions (keeps the partitioning) -> rule 3 lags over the rows that found
    a version (a window on (card, bucket, has_city), satisfied by the same
    partitioning) -> both rules' hits out of one explode -> runs -> chain.
    The as-of join matches at most one version per operation, so rows are
    not multiplied. When ``hist_check`` fails the join is a shuffle join:
    still correct, at the price of a second exchange before rule 3.
    """
    n = cfg.amount_n_rejects
    mode = "decreasing" if cfg.semantics == Semantics.INTENDED else "literal"
    t = withdrawal_timeline(tx, cfg)
    lags4 = {**{f"_r{i}": ("oper_result", i) for i in range(1, n + 1)},
             **{f"_a{i}": ("amt", i) for i in range(1, n + 1)}, "_t_first": ("transe_date", n)}
    t = lags_in_buckets(t, ["card_num"], ["transe_date", "trans_id"], lags4)
    hit4 = (F.col("oper_result") == RESULT_SUCCESS)
    for i in range(1, n + 1):
        hit4 = hit4 & (F.col(f"_r{i}") == RESULT_REJECT)
    hit4 = hit4 & (seconds_between("transe_date", "_t_first") < cfg.amount_max_span_s)
    hit4 = hit4 & amount_chain(F.col("amt"), [F.col(f"_a{i}") for i in range(1, n + 1)], mode)
    t = t.withColumn("_hit4", F.coalesce(hit4, F.lit(False)))
    h = hist.filter(F.col("deleted_flg") == 0).select(
        F.col("terminal_id"), "terminal_city", "effective_from", F.to_date("effective_to").alias("_to_day"),
        F.lit(True).alias("_matched"))
    cond = ((F.col("terminal") == F.col("terminal_id")) & (F.col("effective_from") <= F.to_date("transe_date"))
            & (F.to_date("transe_date") <= F.col("_to_day")))
    j = dim_join(t, h, cond, "left", check=hist_check)
    # a version without a city is a previous row all the same; only operations without a version are not
    w3 = Window.partitionBy("card_num", "_bucket", F.col("_matched").isNotNull()).orderBy(
        "transe_date", "trans_id", "terminal_city")
    j = j.withColumns({"_prev_city": F.lag("terminal_city").over(w3),
                       "_prev_ts": F.lag("transe_date").over(w3)})
    hit3 = (F.col("_matched").isNotNull() & (F.col("_prev_city") != F.col("terminal_city"))
            & (seconds_between("transe_date", "_prev_ts") <= cfg.city_max_gap_s))
    j = home_rows(j)
    ev = F.array_compact(F.array(
        F.when(F.coalesce(hit3, F.lit(False)),
               F.struct(F.lit(EVENT_CITY).alias("rule"), F.col("_prev_ts").alias("first_ts"),
                        F.lit(cfg.city_cut_s).alias("cut_s"))),
        F.when(F.col("_hit4"),
               F.struct(F.lit(EVENT_AMOUNT).alias("rule"), F.col("_t_first").alias("first_ts"),
                        F.lit(cfg.amount_cut_s).alias("cut_s")))))
    x = j.select("card_num", "transe_date", F.explode(ev).alias("_e")).select(
        "card_num", "transe_date", "_e.rule", "_e.first_ts", "_e.cut_s")
    x = runs_covering(x, runs, F.col("cut_s"), "first_ts", "transe_date")
    a = dim_join(x, chain, "card_num", check=chain_check)
    return a.select(F.to_date("transe_date").alias("event_dt"), F.col("passport_num").alias("passport"), "fio",
                    "phone", F.col("rule").alias("event_type"), _report_dt(report_dt).alias("report_dt"))


__all__ = [n for n in dir() if not n.startswith("_")] + ["ALERT_COLS"]
