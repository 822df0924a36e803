"""Text helpers for names, amounts and feed file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwatch.config import FEED_PREFIXES

# Fixed value: the batch date sits between the last '_' and the last '.' as ddMMyyyy.
FILE_DATE_PATTERN = r"_(\d{8})\.[^.]*$"
FILE_DATE_FORMAT = "ddMMyyyy"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fio(last, first, patronymic) -> Column:
    """'last first patronymic'; NULL when any part is NULL (SQL || semantics)."""
    return F.concat(_c(last), F.lit(" "), _c(first), F.lit(" "), _c(patronymic))


def parse_amount(col) -> Column:
    """Decimal comma or point -> decimal(18,2); unparsable text -> NULL."""
    return F.regexp_replace(F.trim(_c(col)), ",", ".").try_cast("decimal(18,2)")


def date_from_file_name(name) -> Column:
    """Batch date encoded in a feed file name; NULL when absent or invalid."""
    digits = F.regexp_extract(_c(name), FILE_DATE_PATTERN, 1)
    return F.when(digits != "", F.try_to_date(digits, FILE_DATE_FORMAT))


def feed_of_file_name(name) -> Column:
    """Feed routed by file-name prefix; NULL for an unknown prefix."""
    expr = None
    for p in FEED_PREFIXES:
        cond = _c(name).startswith(p)
        expr = F.when(cond, F.lit(p)) if expr is None else expr.when(cond, F.lit(p))
    return expr


def date_text_before_blank(col) -> Column:
    """Date part of a 'YYYY-MM-DD hh:mm:ss' text (the part before the first blank)."""
    return F.try_to_date(F.substring_index(F.trim(_c(col)), " ", 1), "yyyy-MM-dd")
