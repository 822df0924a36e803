"""Small helpers for hand-written test tables."""

import datetime as dt
import decimal
import hashlib

from pyspark.sql import functions as F

from cardwatch.schemas import FACT

D = dt.date
T = dt.datetime


def fact_rows(spark, rows):
    """rows: (trans_id, ts, card, opertype, amt, result, terminal); file_date = date(ts)."""
    full = [(r[0], r[1], r[2], r[3], decimal.Decimal(str(r[4])), r[5], r[6], r[1].date()) for r in rows]
    return spark.createDataFrame(full, FACT)


def digest(df_or_rows, cols=None):
    if hasattr(df_or_rows, "collect"):
        cols = df_or_rows.columns
        rows = [tuple(r) for r in df_or_rows.collect()]
    else:
        rows = df_or_rows
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if v is None:
            return "NULL"
        if isinstance(v, decimal.Decimal):
            return format(v.normalize(), "f")
        return str(v)
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), len(lines)


def dims(spark, cards, accounts, clients):
    from cardwatch.schemas import ACCOUNTS, CARDS, CLIENTS
    return (spark.createDataFrame(cards, CARDS), spark.createDataFrame(accounts, ACCOUNTS),
            spark.createDataFrame(clients, CLIENTS))


def one_client(spark, card="C1", valid_to=D(2030, 1, 1), passport_valid_to=None, client="1",
               patronymic="P", passport="PP1"):
    return dims(spark, [(card, "A1", None, None)], [("A1", valid_to, client, None, None)],
                [(client, "Last", "First", patronymic, None, passport, passport_valid_to, "+7", None, None)])


def col_list(df, c):
    return [r[0] for r in df.select(c).collect()]


__all__ = ["D", "T", "F", "fact_rows", "digest", "dims", "one_client", "col_list"]
