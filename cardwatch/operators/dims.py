"""Card -> account -> client chain shared by all four rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.text import fio

CHAIN_COLS = ["card_num", "account", "valid_to", "client_id", "passport_num",
              "passport_valid_to", "fio", "phone"]


def card_chain(cards: DataFrame, accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """One row per card with its account and client attributes (inner joins).

    Dimension-to-dimension joins on unique keys: no skew and sizes of the
    same order, so no hint; AQE turns them into broadcast joins when the
    measured shuffle output is small.
    """
    acc = accounts.select("account", "valid_to", "client")
    cli = clients.select("client_id", "passport_num", "passport_valid_to", "phone",
                         fio("last_name", "first_name", "patronymic").alias("fio"))
    chain = cards.select("card_num", "account").join(acc, "account")
    chain = chain.join(cli, F.col("client") == F.col("client_id"))
    return chain.select(*CHAIN_COLS)


def with_blacklist(chain: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Add ``bl_entry_dt``: the first day a card's passport is on the list.

    ``passport IN (list WHERE entry_dt <= D)`` is the same as
    ``min(entry_dt) <= D``, so the list collapses to one row per passport
    (partial aggregation before the shuffle) and joins as a dimension.
    """
    first = (blacklist.filter(F.col("passport_num").isNotNull())
             .groupBy("passport_num").agg(F.min("entry_dt").alias("bl_entry_dt")))
    return chain.join(first, "passport_num", "left")
