"""DuckDB forms of the named queries (the correctness oracle).

Written independently of the Spark plans and in the plain per-run shape of
the original batch job: rules 3 and 4 explode the fact into run slices
before their windows, the blacklist test is an ``IN`` subquery, and the
terminal history comes from a key x day state grid with
``last_value(... IGNORE NULLS)`` instead of the presence/lead closed form.
The fixture views of FIXTURES.md are inlined as CTEs over the raw tables.
"""

from __future__ import annotations

REPORT_DT = "DATE '2024-02-01'"
SENTINEL = "TIMESTAMP '2999-12-31 23:59:59'"
CUT_1H_S = 23 * 3600 + 1
CUT_20M_S = 23 * 3600 + 40 * 60 + 1

_FIO = "{p}last_name || ' ' || {p}first_name || ' ' || {p}patronymic"

# name -> (deps, body)
CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTE[name] = (deps, body)


cte("tx0", (), """
SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS trans_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP)
         + to_seconds(CAST(85500 + ((hour(ts) * 3600000000 + minute(ts) * 60000000 + microsecond(ts)) // 48)
                                    // 1000000 AS BIGINT)) AS transe_date,
       lpad(CAST(user_id AS VARCHAR), 16, '0') AS card_num,
       CASE WHEN event_id % 10 = 0 THEN 'PAYMENT' ELSE 'WITHDRAW' END AS opertype,
       CAST(value AS DECIMAL(18,2)) AS amt,
       CASE WHEN event_type IN ('error', 'click', 'view') THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
       CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % (SELECT count(*) FROM supplier) AS VARCHAR)
         AS terminal
FROM events""")
cte("tx", ("tx0",), "SELECT *, CAST(transe_date AS DATE) AS file_date FROM tx0")
cte("cards", (), """
SELECT lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS card_num, CAST(c_custkey // 2 AS VARCHAR) AS account,
       DATE '2024-01-01' AS create_dt, CAST(NULL AS DATE) AS update_dt
FROM customer""")
cte("accounts", (), """
SELECT DISTINCT CAST(c_custkey // 2 AS VARCHAR) AS account,
       DATE '2024-01-01' + CAST(((c_custkey // 2) * 13) % 90 AS INTEGER) AS valid_to,
       CASE WHEN (c_custkey // 4) % 3 = 0 THEN 'VIP-' || CAST(c_custkey // 4 AS VARCHAR)
            ELSE CAST(c_custkey // 4 AS VARCHAR) END AS client,
       DATE '2024-01-01' AS create_dt, CAST(NULL AS DATE) AS update_dt
FROM customer""")
cte("clients", (), """
SELECT CASE WHEN c_custkey % 3 = 0 THEN 'VIP-' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END
         AS client_id,
       c_name AS last_name, c_mktsegment AS first_name,
       CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE n_name END AS patronymic,
       DATE '1960-01-01' + CAST((c_custkey * 37) % 14000 AS INTEGER) AS date_of_birth,
       'P' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS passport_num,
       CASE WHEN c_custkey % 5 < 2 THEN NULL ELSE DATE '2024-01-01' + CAST((c_custkey * 7) % 60 AS INTEGER) END
         AS passport_valid_to,
       '+7 ' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone,
       DATE '2024-01-01' AS create_dt, CAST(NULL AS DATE) AS update_dt
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey <= (SELECT max(c_custkey) FROM customer) // 4""")
cte("bl_feed", (), """
SELECT passport_num, strftime(first_day + rep, '%Y-%m-%d') || ' 00:00:00' AS source_date,
       first_day + rep AS file_date
FROM (SELECT 'P' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS passport_num,
             DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS first_day,
             unnest([0, 1]) AS rep
      FROM customer
      WHERE c_custkey <= (SELECT max(c_custkey) FROM customer) // 4 AND c_custkey % 7 = 3) b""")
cte("snap", (), """
SELECT DATE '2024-01-01' + CAST(day AS INTEGER) AS snap_date, CAST(s_suppkey AS VARCHAR) AS terminal_id,
       CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
       'NATION_' || CAST((s_nationkey + (s_suppkey + day) // 5) % 25 AS VARCHAR) AS terminal_city,
       'addr-' || CAST(s_suppkey AS VARCHAR) AS terminal_address
FROM (SELECT s_suppkey, s_nationkey, unnest(range(0, 10)) AS day FROM supplier)
WHERE (s_suppkey * 3 + day) % 8 NOT IN (0, 1)""")

# ---- SCD2 history from a key x snapshot-day state grid
cte("sdays", ("snap",), "SELECT DISTINCT snap_date AS d FROM snap")
cte("scd_grid", ("snap", "sdays"), """
SELECT i.terminal_id, sd.d, s.terminal_id IS NOT NULL AS present,
       s.terminal_type, s.terminal_city, s.terminal_address
FROM (SELECT terminal_id, min(snap_date) AS first_d FROM snap GROUP BY terminal_id) i
JOIN sdays sd ON sd.d >= i.first_d
LEFT JOIN snap s ON s.terminal_id = i.terminal_id AND s.snap_date = sd.d""")
cte("scd_state", ("scd_grid",), """
SELECT terminal_id, d, present,
       last_value(terminal_type IGNORE NULLS) OVER w AS terminal_type,
       last_value(terminal_city IGNORE NULLS) OVER w AS terminal_city,
       last_value(terminal_address IGNORE NULLS) OVER w AS terminal_address
FROM scd_grid
WINDOW w AS (PARTITION BY terminal_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
cte("changes", ("scd_state",), """
SELECT * FROM (
  SELECT d AS change_date, terminal_id, terminal_type, terminal_city, terminal_address,
         CASE WHEN p_present IS NULL THEN 'new'
              WHEN NOT present AND p_present THEN 'deleted'
              WHEN present AND NOT p_present THEN 'returned'
              WHEN present AND (terminal_type IS DISTINCT FROM p_type OR terminal_city IS DISTINCT FROM p_city
                                OR terminal_address IS DISTINCT FROM p_addr) THEN 'updated' END AS change
  FROM (SELECT *, lag(present) OVER w AS p_present, lag(terminal_type) OVER w AS p_type,
               lag(terminal_city) OVER w AS p_city, lag(terminal_address) OVER w AS p_addr
        FROM scd_state WINDOW w AS (PARTITION BY terminal_id ORDER BY d)))
WHERE change IS NOT NULL""")
cte("hist", ("changes",), f"""
SELECT terminal_id, terminal_type, terminal_city, terminal_address, change_date AS effective_from,
       COALESCE(CAST(lead(change_date) OVER (PARTITION BY terminal_id ORDER BY change_date) - 1 AS TIMESTAMP),
                {SENTINEL}) AS effective_to,
       CAST(CASE WHEN change = 'deleted' THEN 1 ELSE 0 END AS INTEGER) AS deleted_flg
FROM changes""")

# ---- blacklist, chain
cte("bl_new", ("bl_feed",), """
SELECT f.* FROM bl_feed f
JOIN (SELECT passport_num, min(file_date) AS fd FROM bl_feed GROUP BY passport_num) m
  ON f.passport_num = m.passport_num AND f.file_date = m.fd""")
cte("bl_table", ("bl_new",), """
SELECT passport_num, file_date AS entry_dt, CAST(split_part(source_date, ' ', 1) AS DATE) AS source_entry_dt
FROM bl_new""")
cte("chain", ("cards", "accounts", "clients"), f"""
SELECT c.card_num, a.account, a.valid_to, cl.client_id, cl.passport_num, cl.passport_valid_to,
       {_FIO.format(p='cl.')} AS fio, cl.phone
FROM clients cl JOIN accounts a ON cl.client_id = a.client JOIN cards c ON a.account = c.account""")
cte("runs", ("tx",), "SELECT DISTINCT file_date AS run_date FROM tx")
cte("wd", ("tx",), """
SELECT trans_id, transe_date, card_num, amt, oper_result, terminal FROM tx WHERE opertype = 'WITHDRAW'""")


def _slice_join(alias: str, cut_s: int) -> str:
    return (f"JOIN runs r ON {alias}.transe_date > CAST(r.run_date - 1 AS TIMESTAMP) + to_seconds({cut_s}) "
            f"AND {alias}.transe_date < CAST(r.run_date + 1 AS TIMESTAMP)")


def _tj(asof: bool) -> str:
    cond = ("AND h.deleted_flg = 0 AND h.effective_from <= CAST(w.transe_date AS DATE) "
            "AND CAST(w.transe_date AS DATE) <= CAST(h.effective_to AS DATE)") if asof else ""
    return f"SELECT w.*, h.terminal_city FROM wd w JOIN hist h ON w.terminal = h.terminal_id {cond}"


for _asof, _sfx in ((True, "asof"), (False, "all")):
    cte(f"tj_{_sfx}", ("wd", "hist"), _tj(_asof))
    cte(f"s1_{_sfx}", (f"tj_{_sfx}", "runs"), f"SELECT r.run_date, x.* FROM tj_{_sfx} x {_slice_join('x', CUT_1H_S)}")
    cte(f"fv_{_sfx}", (f"s1_{_sfx}",), f"""
SELECT run_date, card_num, terminal_city, min(transe_date) AS transe_date
FROM s1_{_sfx} GROUP BY run_date, card_num, terminal_city""")
    cte(f"rc_{_sfx}", (f"fv_{_sfx}",), f"""
SELECT run_date, card_num, terminal_city, transe_date, cnt,
       CAST(sum(cnt) OVER (PARTITION BY run_date, card_num) AS BIGINT) AS sum_cnt
FROM (SELECT *, count(*) OVER (PARTITION BY run_date, card_num ORDER BY transe_date) AS cnt FROM fv_{_sfx})""")
    cte(f"rep_{_sfx}", (f"rc_{_sfx}",), f"""
SELECT run_date, card_num, terminal_city, transe_date, prev_transe_date,
       CAST(epoch(transe_date) - epoch(prev_transe_date) AS BIGINT) AS gap_s
FROM (SELECT *, lag(transe_date) OVER (PARTITION BY run_date, card_num ORDER BY transe_date, terminal_city)
                  AS prev_transe_date FROM rc_{_sfx})
WHERE sum_cnt > 2 AND epoch(transe_date) - epoch(prev_transe_date) <= 3600""")
    cte(f"pair_{_sfx}", (f"s1_{_sfx}",), f"""
SELECT run_date, card_num, trans_id, transe_date, terminal_city, prev_city, prev_transe_date,
       CAST(epoch(transe_date) - epoch(prev_transe_date) AS BIGINT) AS gap_s
FROM (SELECT *, lag(terminal_city) OVER w AS prev_city, lag(transe_date) OVER w AS prev_transe_date
      FROM s1_{_sfx} WINDOW w AS (PARTITION BY run_date, card_num ORDER BY transe_date, trans_id, terminal_city))
WHERE prev_city <> terminal_city AND epoch(transe_date) - epoch(prev_transe_date) <= 3600""")

cte("s1tx", ("wd", "runs"), f"SELECT r.run_date, x.* FROM wd x {_slice_join('x', CUT_1H_S)}")
cte("s2", ("wd", "runs"), f"SELECT r.run_date, x.* FROM wd x {_slice_join('x', CUT_20M_S)}")
cte("s2_lags", ("s2",), """
SELECT *, lag(oper_result, 1) OVER w AS r1, lag(oper_result, 2) OVER w AS r2, lag(oper_result, 3) OVER w AS r3,
       lag(amt, 1) OVER w AS a1, lag(amt, 2) OVER w AS a2, lag(amt, 3) OVER w AS a3,
       lag(transe_date, 3) OVER w AS t3
FROM s2 WINDOW w AS (PARTITION BY run_date, card_num ORDER BY transe_date, trans_id)""")
_AMOUNT = {
    "decreasing": "amt < a1 AND a1 < a2 AND a2 < a3",
    "literal": "CAST(CAST(amt < a1 AS INTEGER) < a2 AS INTEGER) < a3",
    "none": "TRUE",
}
for _mode, _cond in _AMOUNT.items():
    cte(f"ag_{_mode}", ("s2_lags",), f"""
SELECT run_date, card_num, trans_id, transe_date, amt, t3 AS first_reject_date
FROM s2_lags
WHERE oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT'
  AND epoch(transe_date) - epoch(t3) < 1200 AND {_cond}""")


def _alerts(src: str, event_dt: str, etype: str) -> str:
    return (f"SELECT {event_dt} AS event_dt, ch.passport_num AS passport, ch.fio, ch.phone, "
            f"'{etype}' AS event_type, {REPORT_DT} AS report_dt FROM {src} x JOIN chain ch ON x.card_num = ch.card_num")


_RULE12 = f"""
SELECT t.file_date AS event_dt, cl.passport_num AS passport, {_FIO.format(p='cl.')} AS fio, cl.phone,
       '{{etype}}' AS event_type, {REPORT_DT} AS report_dt
FROM clients cl JOIN accounts a ON cl.client_id = a.client JOIN cards c ON a.account = c.account
JOIN tx t ON c.card_num = t.card_num
WHERE {{cond}}"""
cte("r1", ("clients", "accounts", "cards", "tx", "bl_table"), _RULE12.format(
    etype="1", cond="CAST(t.transe_date AS DATE) >= cl.passport_valid_to OR cl.passport_num IN "
                    "(SELECT passport_num FROM bl_table WHERE entry_dt <= t.file_date)"))
cte("r2", ("clients", "accounts", "cards", "tx"), _RULE12.format(
    etype="2", cond="CAST(t.transe_date AS DATE) >= a.valid_to"))
cte("r3", ("pair_asof", "chain"), _alerts("pair_asof", "CAST(x.transe_date AS DATE)", "3"))
cte("r3p", ("rep_all", "chain"), _alerts("rep_all", "CAST(x.transe_date AS DATE)", "3"))
cte("r4", ("ag_decreasing", "chain"), _alerts("ag_decreasing", "CAST(x.transe_date AS DATE)", "4"))
cte("r4p", ("ag_literal", "chain"), _alerts("ag_literal", "CAST(x.transe_date AS DATE)", "4"))
cte("report", ("r1", "r2", "r3", "r4"),
    "SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r4")
cte("report_p", ("r1", "r2", "r3p", "r4p"),
    "SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3p UNION ALL SELECT * FROM r4p")

# ---- feeds
cte("feed_names", ("bl_feed", "snap", "tx"), """
SELECT DISTINCT 'passport_blacklist_' || strftime(file_date, '%d%m%Y') || '.xlsx' AS file_name FROM bl_feed
UNION ALL SELECT DISTINCT 'terminals_' || strftime(snap_date, '%d%m%Y') || '.xlsx' FROM snap
UNION ALL SELECT DISTINCT 'transactions_' || strftime(file_date, '%d%m%Y') || '.txt' FROM tx""")
cte("routed", ("feed_names",), r"""
SELECT file_name,
       CASE WHEN starts_with(file_name, 'passport') THEN 'passport'
            WHEN starts_with(file_name, 'terminals') THEN 'terminals'
            WHEN starts_with(file_name, 'transactions') THEN 'transactions' END AS feed,
       CAST(strptime(regexp_extract(file_name, '_(\d{8})\.[^.]*$', 1), '%d%m%Y') AS DATE) AS file_date,
       CAST(CASE WHEN starts_with(file_name, 'passport') THEN 1
                 WHEN starts_with(file_name, 'terminals') THEN 2
                 WHEN starts_with(file_name, 'transactions') THEN 3 END AS INTEGER) AS feed_order
FROM feed_names""")


cte("tx_lines", ("tx",), """
SELECT 'transactions_' || strftime(file_date, '%d%m%Y') || '.txt' AS file_name, file_date,
       CASE WHEN k % 97 = 0 THEN l || ';x' WHEN k % 89 = 0 THEN array_to_string(string_split(l, ';')[1:6], ';') ELSE l END
         AS line
FROM (SELECT file_date, CAST(trans_id AS BIGINT) AS k,
             CASE WHEN k % 79 = 0 THEN '' ELSE trans_id END || ';'
             || CASE WHEN k % 73 = 0 THEN strftime(transe_date, '%d.%m.%Y')
                     ELSE strftime(transe_date, '%Y-%m-%d %H:%M:%S') END || ';'
             || CASE WHEN k % 71 = 0 THEN 'n/a' WHEN k % 3 = 0 THEN replace(CAST(amt AS VARCHAR), '.', ',')
                     ELSE CAST(amt AS VARCHAR) END || ';'
             || CASE WHEN k % 83 = 0 THEN '"' || card_num || '"' ELSE card_num END || ';'
             || opertype || ';' || oper_result || ';' || terminal AS l
      FROM tx)""")
cte("tx_bad", ("tx_lines",), """
SELECT file_name, 'transactions' AS feed, file_date, line,
       CASE WHEN len(f) <> 7 THEN 'field count' WHEN contains(line, '"') THEN 'quoted field'
            WHEN list_contains(f, '') THEN 'missing field'
            WHEN try_strptime(f[2], '%Y-%m-%d %H:%M:%S') IS NULL THEN 'bad date'
            WHEN TRY_CAST(replace(f[3], ',', '.') AS DECIMAL(18,2)) IS NULL THEN 'bad amount' END AS reject_reason
FROM (SELECT *, string_split(line, ';') AS f FROM tx_lines)""")
cte("bl_bad", ("bl_feed",), """
SELECT 'passport_blacklist_' || strftime(file_date, '%d%m%Y') || '.xlsx' AS file_name, 'passport' AS feed, file_date,
       source_date || ',' || CASE WHEN k % 3 = 0 THEN '' ELSE passport_num END || CASE WHEN k % 5 = 0 THEN ',x' ELSE '' END
         AS line,
       CASE WHEN k % 5 = 0 THEN 'field count' ELSE 'null passport' END AS reject_reason
FROM (SELECT *, CAST(substr(passport_num, 2) AS BIGINT) AS k FROM bl_feed) WHERE k % 5 = 0 OR k % 3 = 0""")
cte("term_bad", ("snap",), """
SELECT 'terminals_' || strftime(snap_date, '%d%m%Y') || '.xlsx' AS file_name, 'terminals' AS feed,
       snap_date AS file_date,
       CASE WHEN k % 7 = 0 THEN ' ' ELSE terminal_id END || ',' || terminal_type || ',"' || terminal_city || '"'
         || CASE WHEN k % 11 = 0 THEN '' ELSE ',' || terminal_address END AS line,
       CASE WHEN k % 11 = 0 THEN 'field count' ELSE 'null terminal' END AS reject_reason
FROM (SELECT *, CAST(terminal_id AS BIGINT) + day(snap_date) AS k FROM snap) WHERE k % 11 = 0 OR k % 7 = 0""")
cte("bl_nulls", ("bl_feed",), """
SELECT CASE WHEN CAST(substr(passport_num, 2) AS BIGINT) % 4 = 0 THEN NULL ELSE passport_num END AS passport_num, file_date
FROM bl_feed""")
cte("bl_before", ("bl_nulls",), "SELECT * FROM bl_nulls WHERE file_date < DATE '2024-01-15'")
cte("bl_after", ("bl_nulls",), "SELECT * FROM bl_nulls WHERE file_date >= DATE '2024-01-15'")

HIST_COLS = "terminal_id, terminal_type, terminal_city, terminal_address, effective_from, effective_to, deleted_flg"
CHG_COLS = "change_date, terminal_id, terminal_type, terminal_city, terminal_address, change"
FACT_COLS = "trans_id, transe_date, card_num, opertype, amt, oper_result, terminal, file_date"

QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "feed_batches": (("routed",), "SELECT * FROM routed"),
    "feed_pending": (("routed",), "SELECT * FROM routed WHERE file_name NOT IN "
                                  "(SELECT file_name FROM routed WHERE file_date < DATE '2024-01-15')"),
    "tx_text_normalize": (("tx",), "SELECT trans_id, transe_date, card_num, opertype, amt, oper_result, terminal FROM tx"),
    "feed_refused": (("runs",), """
SELECT 'report_' || d || '.txt' AS file_name, CAST(NULL AS VARCHAR) AS feed, run_date AS file_date,
       'unknown prefix' AS reject_reason FROM (SELECT run_date, strftime(run_date, '%d%m%Y') AS d FROM runs)
UNION ALL SELECT 'transactions_x' || strftime(run_date, '%d%m%Y') || '.txt', 'transactions', NULL, 'no date in name' FROM runs
UNION ALL SELECT 'terminals_' || strftime(run_date, '%d%m%Y') || '.xlsx', 'terminals', run_date, 'unreadable file type' FROM runs
UNION ALL SELECT 'passport_blacklist_' || strftime(run_date, '%d%m%Y') || '.csv.gz', 'passport', NULL, 'no date in name'
FROM runs"""),
    "tx_rejects": (("tx_bad",), "SELECT * FROM tx_bad WHERE reject_reason IS NOT NULL"),
    "blacklist_rejects": (("bl_bad",), "SELECT * FROM bl_bad"),
    "terminal_rejects": (("term_bad",), "SELECT * FROM term_bad"),
    "blacklist_not_in": (("bl_before", "bl_after"), """
SELECT 'plain' AS variant, passport_num, file_date FROM bl_after
WHERE passport_num NOT IN (SELECT passport_num FROM bl_before WHERE passport_num IS NOT NULL)
UNION ALL SELECT 'nulls', passport_num, file_date FROM bl_after WHERE passport_num NOT IN (SELECT passport_num FROM bl_before)
UNION ALL SELECT 'empty', passport_num, file_date FROM bl_after
WHERE passport_num NOT IN (SELECT passport_num FROM bl_before WHERE false)"""),
    "scd2_late_snapshot": (("hist",), f"SELECT {HIST_COLS} FROM hist"),
    "blacklist_feed": (("bl_feed",), "SELECT passport_num, CAST(split_part(source_date, ' ', 1) AS DATE) "
                                     "AS source_entry_dt, file_date FROM bl_feed"),
    "terminal_snapshot": (("snap",), "SELECT * FROM snap"),
    "dim_cards": (("cards",), "SELECT * FROM cards"),
    "dim_accounts": (("accounts",), "SELECT * FROM accounts"),
    "dim_clients": (("clients",), "SELECT * FROM clients"),
    "fact_transactions": (("tx",), f"SELECT {FACT_COLS} FROM tx"),
    "daily_slice": (("tx",), """
SELECT file_date, count(*) AS n_rows,
       CAST(count(*) FILTER (WHERE opertype = 'WITHDRAW') AS BIGINT) AS n_withdraw,
       CAST(count(*) FILTER (WHERE oper_result = 'REJECT') AS BIGINT) AS n_reject,
       CAST(sum(amt) AS DECIMAL(38,2)) AS amt_total
FROM tx GROUP BY file_date"""),
    "client_fio": (("clients",), f"SELECT client_id, {_FIO.format(p='')} AS fio, phone, passport_num FROM clients"),
    "client_chain": (("tx", "chain", "bl_table"), """
SELECT t.trans_id, t.card_num, ch.client_id, ch.passport_num, ch.fio,
       (SELECT min(entry_dt) FROM bl_table b WHERE b.passport_num = ch.passport_num) AS bl_entry_dt
FROM tx t JOIN chain ch ON t.card_num = ch.card_num"""),
    "terminal_join_all": (("s1tx", "hist"), """
SELECT t.run_date, t.trans_id, t.card_num, t.transe_date, t.terminal, h.terminal_city, h.effective_from
FROM s1tx t JOIN hist h ON t.terminal = h.terminal_id"""),
    "terminal_join_asof": (("s1tx", "hist"), """
SELECT t.run_date, t.trans_id, t.card_num, t.transe_date, t.terminal, h.terminal_city, h.effective_from
FROM s1tx t JOIN hist h ON t.terminal = h.terminal_id AND h.deleted_flg = 0
 AND h.effective_from <= CAST(t.transe_date AS DATE) AND CAST(t.transe_date AS DATE) <= CAST(h.effective_to AS DATE)"""),
    "lookback_1h": (("tx", "runs"), f"SELECT r.run_date, {', '.join('x.' + c for c in FACT_COLS.split(', '))} "
                                    f"FROM tx x {_slice_join('x', CUT_1H_S)} WHERE x.opertype = 'WITHDRAW'"),
    "lookback_20m": (("tx", "runs"), f"SELECT r.run_date, {', '.join('x.' + c for c in FACT_COLS.split(', '))} "
                                     f"FROM tx x {_slice_join('x', CUT_20M_S)} WHERE x.opertype = 'WITHDRAW'"),
    "blacklist_new": (("bl_new",), "SELECT passport_num, file_date FROM bl_new"),
    "blacklist_merge_last_day": (("bl_table",), "SELECT passport_num, entry_dt FROM bl_table"),
    "blacklist_table": (("bl_table",), "SELECT passport_num, entry_dt, source_entry_dt FROM bl_table"),
    "scd2_history": (("hist",), f"SELECT {HIST_COLS} FROM hist"),
    "scd2_history_fold": (("hist",), f"SELECT {HIST_COLS} FROM hist"),
    "scd2_merge_last_day": (("hist",), f"SELECT {HIST_COLS} FROM hist"),
    "scd2_new": (("changes",), f"SELECT {CHG_COLS} FROM changes WHERE change IN ('new', 'returned')"),
    "scd2_deleted": (("changes",), f"SELECT {CHG_COLS} FROM changes WHERE change = 'deleted'"),
    "scd2_updated": (("changes",), f"SELECT {CHG_COLS} FROM changes WHERE change = 'updated'"),
    "scd2_resurrected": (("changes",), f"SELECT {CHG_COLS} FROM changes WHERE change = 'returned'"),
    "scd2_current": (("hist",), f"SELECT {HIST_COLS} FROM hist WHERE effective_to = {SENTINEL} AND deleted_flg = 0"),
    "scd2_asof": (("hist",), f"SELECT {HIST_COLS} FROM hist WHERE deleted_flg = 0 "
                             f"AND effective_from <= DATE '2024-01-05' AND CAST(effective_to AS DATE) >= DATE '2024-01-05'"),
    "city_first_visit": (("fv_asof",), "SELECT * FROM fv_asof"),
    "city_running_count": (("rc_asof",), "SELECT * FROM rc_asof"),
    "city_hop_rep": (("rep_asof",), "SELECT * FROM rep_asof"),
    "city_hop_rep_all": (("rep_all",), "SELECT * FROM rep_all"),
    "city_hop_pair": (("pair_asof",), "SELECT * FROM pair_asof"),
    "city_hop_pair_all": (("pair_all",), "SELECT * FROM pair_all"),
    "amount_guess": (("ag_decreasing",), "SELECT * FROM ag_decreasing"),
    "amount_guess_literal": (("ag_literal",), "SELECT * FROM ag_literal"),
    "amount_guess_pattern": (("ag_none",), "SELECT * FROM ag_none"),
    "fraud_passport": (("r1",), "SELECT * FROM r1"),
    "fraud_contract": (("r2",), "SELECT * FROM r2"),
    "fraud_city": (("r3",), "SELECT * FROM r3"),
    "fraud_city_parity": (("r3p",), "SELECT * FROM r3p"),
    "fraud_amount": (("r4",), "SELECT * FROM r4"),
    "fraud_amount_parity": (("r4p",), "SELECT * FROM r4p"),
    "fraud_last_run": (("r1", "r2", "pair_asof", "ag_decreasing", "chain", "runs"), f"""
SELECT * FROM r1 WHERE event_dt = (SELECT max(run_date) FROM runs)
UNION ALL SELECT * FROM r2 WHERE event_dt = (SELECT max(run_date) FROM runs)
UNION ALL {_alerts("(SELECT * FROM pair_asof WHERE run_date = (SELECT max(run_date) FROM runs))",
                   "CAST(x.transe_date AS DATE)", "3")}
UNION ALL {_alerts("(SELECT * FROM ag_decreasing WHERE run_date = (SELECT max(run_date) FROM runs))",
                   "CAST(x.transe_date AS DATE)", "4")}"""),
    "fraud_report": (("report",), "SELECT * FROM report"),
    "fraud_report_parity": (("report_p",), "SELECT * FROM report_p"),
    "fraud_report_dedup": (("report",), "SELECT DISTINCT * FROM report"),
    "audit_report": (("audit",), """
SELECT upload_dt, table_name, COALESCE(CAST(new_rows AS VARCHAR), 'not exists') AS new_rows,
       COALESCE(CAST(updated_rows AS VARCHAR), 'not exists') AS updated_rows,
       COALESCE(CAST(deleted_rows AS VARCHAR), 'not exists') AS deleted_rows
FROM audit"""),
    "audit_counts": (("audit",), "SELECT * FROM audit"),
}

cte("audit", ("tx", "bl_feed", "bl_new", "sdays", "changes"), """
SELECT file_date AS upload_dt, 'DWH_FACT_transactions' AS table_name, count(*) AS new_rows,
       CAST(NULL AS BIGINT) AS updated_rows, CAST(NULL AS BIGINT) AS deleted_rows
FROM tx GROUP BY file_date
UNION ALL
SELECT d.file_date, 'DWH_DIM_passport_blacklist', CAST(count(n.passport_num) AS BIGINT), NULL, NULL
FROM (SELECT DISTINCT file_date FROM bl_feed) d LEFT JOIN bl_new n ON n.file_date = d.file_date
GROUP BY d.file_date
UNION ALL
SELECT sd.d, 'DWH_DIM_terminals_HIST',
       CAST(count(c.change) FILTER (WHERE c.change IN ('new', 'returned')) AS BIGINT),
       CAST(count(c.change) FILTER (WHERE c.change = 'updated') AS BIGINT),
       CAST(count(c.change) FILTER (WHERE c.change = 'deleted') AS BIGINT)
FROM sdays sd LEFT JOIN changes c ON c.change_date = sd.d
GROUP BY sd.d""")


# the same results by another plan
QUERIES["city_hop_pair_carry"] = QUERIES["city_hop_pair"]
QUERIES["amount_guess_carry"] = QUERIES["amount_guess"]
QUERIES["fraud_report_export"] = QUERIES["fraud_report"]


def _order(deps: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in CTE[n][0]:
            visit(d)
        out.append(n)

    for d in deps:
        visit(d)
    return out


def sql(name: str) -> str:
    deps, body = QUERIES[name]
    names = _order(deps)
    if not names:
        return body.strip()
    withs = ",\n".join(f"{n} AS ({CTE[n][1].strip()}\n)" for n in names)
    return f"WITH {withs}\n{body.strip()}"


def all_sql() -> dict[str, str]:
    return {n: sql(n) for n in QUERIES}
