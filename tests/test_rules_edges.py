"""Edge rows for the four rules (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from cardwatch.config import DEFAULT, PARITY
from cardwatch.operators import dims, rules
from cardwatch.operators.lookback import expand_runs, run_dates
from cardwatch.schemas import BLACKLIST
from helpers import D, T, col_list, fact_rows, one_client

SENT = T(2999, 12, 31, 23, 59, 59)


def _hist(spark, rows):
    """rows: (terminal_id, city, effective_from, effective_to, deleted_flg)."""
    from cardwatch.schemas import TERMINALS_HIST
    return spark.createDataFrame([(r[0], "ATM", r[1], "addr", r[2], r[3], r[4]) for r in rows], TERMINALS_HIST)


def _rule12(spark, tx_rows, bl=(), **client):
    cards, accounts, clients = one_client(spark, **client)
    chain = dims.card_chain(cards, accounts, clients)
    chain_bl = dims.with_blacklist(chain, spark.createDataFrame(list(bl), BLACKLIST))
    j = rules.batch_joined(fact_rows(spark, tx_rows), chain_bl, True)
    return rules.passport_contract_alerts(j, D(2024, 2, 1))


def test_expiry_midnight_alerts(spark):
    out = _rule12(spark, [("1", T(2021, 3, 1, 0, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "t")],
                  valid_to=D(2021, 3, 1), passport_valid_to=D(2021, 3, 1))
    assert sorted(col_list(out, "event_type")) == ["1", "2"]  # both expired: one alert of each type


def test_expiry_day_before_no_alert(spark):
    out = _rule12(spark, [("1", T(2021, 2, 28, 23, 59, 59), "C1", "WITHDRAW", 1, "SUCCESS", "t")],
                  valid_to=D(2021, 3, 1), passport_valid_to=D(2021, 3, 1))
    assert out.count() == 0


def test_null_passport_validity_never_expires(spark):
    tx = [("1", T(2021, 5, 1, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "t")]
    assert _rule12(spark, tx, passport_valid_to=None).count() == 0
    listed = _rule12(spark, tx, bl=[("PP1", D(2021, 4, 1))], passport_valid_to=None)
    assert col_list(listed, "event_type") == ["1"]


def test_listed_after_the_batch_day_no_alert(spark):
    tx = [("1", T(2021, 5, 1, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "t")]
    assert _rule12(spark, tx, bl=[("PP1", D(2021, 5, 2))]).count() == 0


def test_null_patronymic_gives_null_fio_alert_kept(spark):
    tx = [("1", T(2021, 5, 1, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "t")]
    out = _rule12(spark, tx, patronymic=None, valid_to=D(2021, 1, 1))
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["fio"] is None


def test_vip_client_joins_and_unknown_card_dropped(spark):
    tx = [("1", T(2021, 5, 1, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "t"),
          ("2", T(2021, 5, 1, 10, 0, 0), "NOPE", "WITHDRAW", 1, "SUCCESS", "t")]
    out = _rule12(spark, tx, client="VIP-6237", valid_to=D(2021, 1, 1))
    assert out.count() == 1


def test_lookback_cut_edges(spark):
    tx = fact_rows(spark, [
        ("a", T(2024, 1, 1, 23, 0, 1), "C1", "WITHDRAW", 1, "SUCCESS", "t"),
        ("b", T(2024, 1, 1, 23, 0, 2), "C1", "WITHDRAW", 1, "SUCCESS", "t"),
        ("c", T(2024, 1, 1, 23, 40, 1), "C1", "WITHDRAW", 1, "SUCCESS", "t"),
        ("d", T(2024, 1, 1, 23, 40, 2), "C1", "WITHDRAW", 1, "SUCCESS", "t"),
        ("e", T(2024, 1, 2, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "t"),
    ])
    runs = run_dates(tx)
    s1 = expand_runs(tx, runs, DEFAULT.city_cut_s).filter(F.col("run_date") == D(2024, 1, 2))
    s2 = expand_runs(tx, runs, DEFAULT.amount_cut_s).filter(F.col("run_date") == D(2024, 1, 2))
    assert sorted(col_list(s1, "trans_id")) == ["b", "c", "d", "e"]
    assert sorted(col_list(s2, "trans_id")) == ["d", "e"]


def _city(spark, tx_rows, hist_rows, cfg=DEFAULT, form="pair", asof=True):
    tx = fact_rows(spark, tx_rows)
    hist = _hist(spark, hist_rows)
    runs = run_dates(tx)
    f = rules.city_hop_pair if form == "pair" else rules.city_hop_rep
    return f(tx, hist, runs, cfg, asof, True)


def _two_terms(frm=D(2024, 1, 1)):
    return [("A", "CityA", frm, SENT, 0), ("B", "CityB", frm, SENT, 0)]


def test_city_gap_edges(spark):
    ok = _city(spark, [("1", T(2024, 1, 5, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "A"),
                       ("2", T(2024, 1, 5, 11, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "B")], _two_terms())
    assert ok.count() == 1
    late = _city(spark, [("1", T(2024, 1, 5, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "A"),
                         ("2", T(2024, 1, 5, 11, 0, 1), "C1", "WITHDRAW", 1, "SUCCESS", "B")], _two_terms())
    assert late.count() == 0


def test_one_city_many_operations_no_alert(spark):
    rows = [(str(i), T(2024, 1, 5, 10, i, 0), "C1", "WITHDRAW", 1, "SUCCESS", "A") for i in range(20)]
    assert _city(spark, rows, _two_terms()).count() == 0
    assert _city(spark, rows, _two_terms(), form="rep").count() == 0


def test_representative_vs_pair_form(spark):
    rows = [("1", T(2024, 1, 5, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "A"),
            ("2", T(2024, 1, 5, 12, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "A"),
            ("3", T(2024, 1, 5, 12, 30, 0), "C1", "WITHDRAW", 1, "SUCCESS", "B")]
    assert _city(spark, rows, _two_terms(), form="rep").count() == 0
    assert _city(spark, rows, _two_terms(), form="pair").count() == 1


def test_moved_terminal_asof_vs_all_versions(spark):
    hist = [("A", "CityA", D(2024, 1, 1), T(2024, 1, 4), 0), ("A", "CityZ", D(2024, 1, 5), SENT, 0)]
    rows = [("1", T(2024, 1, 5, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "A")]
    assert _city(spark, rows, hist, asof=True).count() == 0
    assert _city(spark, rows, hist, asof=False).count() == 1


def test_two_cities_same_second_one_alert_on_later_name(spark):
    rows = [("1", T(2024, 1, 5, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "B"),
            ("2", T(2024, 1, 5, 10, 0, 0), "C1", "WITHDRAW", 1, "SUCCESS", "A")]
    out = _city(spark, rows, _two_terms(), form="rep").collect()
    assert len(out) == 1 and out[0]["terminal_city"] == "CityB"


def _amount(spark, rows, mode=None, cfg=DEFAULT):
    tx = fact_rows(spark, rows)
    return rules.amount_guess(tx, run_dates(tx), cfg, mode)


def _seq(spark, results_amounts, start=T(2024, 1, 5, 10, 0, 0), step_s=60, last_gap_s=None, op=None):
    rows = []
    t = start
    for i, (res, amt) in enumerate(results_amounts):
        rows.append((f"{i:03d}", t, "C1", (op or {}).get(i, "WITHDRAW"), amt, res, "A"))
        t = t + __import__("datetime").timedelta(seconds=step_s)
    return rows


def test_amount_guess_span_edge(spark):
    import datetime as dt
    base = T(2024, 1, 5, 10, 0, 0)
    within = [("0", base, "C1", "WITHDRAW", 400, "REJECT", "A"),
              ("1", base + dt.timedelta(seconds=60), "C1", "WITHDRAW", 300, "REJECT", "A"),
              ("2", base + dt.timedelta(seconds=120), "C1", "WITHDRAW", 200, "REJECT", "A"),
              ("3", base + dt.timedelta(seconds=1199), "C1", "WITHDRAW", 100, "SUCCESS", "A")]
    assert _amount(spark, within).count() == 1
    at = within[:3] + [("3", base + dt.timedelta(seconds=1200), "C1", "WITHDRAW", 100, "SUCCESS", "A")]
    assert _amount(spark, at).count() == 0


def test_amount_guess_increasing_intended_none_literal_alert(spark):
    rows = _seq(spark, [("REJECT", 100), ("REJECT", 200), ("REJECT", 300), ("SUCCESS", 50)])
    assert _amount(spark, rows, "decreasing").count() == 0
    assert _amount(spark, rows, "literal").count() == 1


def test_five_rejects_then_success_one_alert(spark):
    rows = _seq(spark, [("REJECT", 900), ("REJECT", 800), ("REJECT", 700), ("REJECT", 600), ("REJECT", 500),
                        ("SUCCESS", 400)])
    assert _amount(spark, rows).count() == 1


def test_payments_between_are_ignored(spark):
    rows = _seq(spark, [("REJECT", 400), ("SUCCESS", 1), ("REJECT", 300), ("REJECT", 200), ("SUCCESS", 100)],
                op={1: "PAYMENT"})
    assert _amount(spark, rows).count() == 1


def test_alert_near_midnight_in_two_runs(spark):
    import datetime as dt
    base = T(2024, 1, 5, 23, 45, 0)
    rows = [(str(i), base + dt.timedelta(seconds=60 * i), "C1", "WITHDRAW", 400 - 100 * i,
             "REJECT" if i < 3 else "SUCCESS", "A") for i in range(4)]
    rows.append(("z", T(2024, 1, 6, 10, 0, 0), "C2", "WITHDRAW", 1, "SUCCESS", "A"))  # makes 01-06 a run
    out = _amount(spark, rows)
    assert sorted(col_list(out, "run_date")) == [D(2024, 1, 5), D(2024, 1, 6)]


def test_parity_preset_uses_literal_chain(spark):
    rows = _seq(spark, [("REJECT", 100), ("REJECT", 200), ("REJECT", 300), ("SUCCESS", 50)])
    assert _amount(spark, rows, cfg=PARITY).count() == 1
