"""Table schemas (fixed DDL; positional feeds get these explicitly)."""

from pyspark.sql import types as T

S, D, TS = T.StringType(), T.DateType(), T.TimestampNTZType()
AMT = T.DecimalType(18, 2)

CARDS = T.StructType([
    T.StructField("card_num", S), T.StructField("account", S),
    T.StructField("create_dt", D), T.StructField("update_dt", D),
])

ACCOUNTS = T.StructType([
    T.StructField("account", S), T.StructField("valid_to", D), T.StructField("client", S),
    T.StructField("create_dt", D), T.StructField("update_dt", D),
])

CLIENTS = T.StructType([
    T.StructField("client_id", S), T.StructField("last_name", S), T.StructField("first_name", S),
    T.StructField("patronymic", S), T.StructField("date_of_birth", D),
    T.StructField("passport_num", S), T.StructField("passport_valid_to", D),
    T.StructField("phone", S), T.StructField("create_dt", D), T.StructField("update_dt", D),
])

# Fact layout (target column order) plus the batch date.
FACT = T.StructType([
    T.StructField("trans_id", S), T.StructField("transe_date", TS), T.StructField("card_num", S),
    T.StructField("opertype", S), T.StructField("amt", AMT), T.StructField("oper_result", S),
    T.StructField("terminal", S), T.StructField("file_date", D),
])
FACT_COLS = [f.name for f in FACT.fields]

# Source order of a transactions text line: id, date, amount, card, type, result, terminal.
TX_TEXT_FIELDS = ["trans_id", "transe_date", "amt", "card_num", "opertype", "oper_result", "terminal"]
TX_TEXT = T.StructType([T.StructField(c, S) for c in TX_TEXT_FIELDS])

TERMINAL_SNAPSHOT = T.StructType([
    T.StructField("terminal_id", S), T.StructField("terminal_type", S),
    T.StructField("terminal_city", S), T.StructField("terminal_address", S),
])
TERMINAL_ATTRS = ["terminal_type", "terminal_city", "terminal_address"]

TERMINALS_HIST = T.StructType([
    T.StructField("terminal_id", S), T.StructField("terminal_type", S),
    T.StructField("terminal_city", S), T.StructField("terminal_address", S),
    T.StructField("effective_from", D), T.StructField("effective_to", TS),
    T.StructField("deleted_flg", T.IntegerType()),
])
HIST_COLS = [f.name for f in TERMINALS_HIST.fields]

BLACKLIST_FEED = T.StructType([T.StructField("date", S), T.StructField("passport", S)])
BLACKLIST = T.StructType([T.StructField("passport_num", S), T.StructField("entry_dt", D)])

ALERTS = T.StructType([
    T.StructField("event_dt", D), T.StructField("passport", S), T.StructField("fio", S),
    T.StructField("phone", S), T.StructField("event_type", S), T.StructField("report_dt", D),
])
ALERT_COLS = [f.name for f in ALERTS.fields]
ALERTS_RUN = T.StructType([*ALERTS.fields, T.StructField("run_date", D)])

AUDIT = T.StructType([
    T.StructField("upload_dt", D), T.StructField("table_name", S),
    T.StructField("new_rows", T.LongType()), T.StructField("updated_rows", T.LongType()),
    T.StructField("deleted_rows", T.LongType()),
])

# Rejected rows of every feed, as they came.
REJECTS = T.StructType([
    T.StructField("file_name", S), T.StructField("feed", S), T.StructField("file_date", D), T.StructField("line", S),
    T.StructField("reject_reason", S),
])
