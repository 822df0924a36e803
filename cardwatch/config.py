"""Presets and thresholds.

``Semantics.INTENDED`` follows what the rules are meant to do;
``Semantics.PARITY`` reproduces the literal reading of the original SQL
(arbitrary-looking but well defined behaviour such as the chained amount
comparison or the all-versions terminal join). Never mix them in one query.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from enum import Enum


class Semantics(str, Enum):
    INTENDED = "intended"
    PARITY = "parity"


# Fixed values that must equal the original system's for identical results.
# Open-interval sentinel of the terminal history.
SENTINEL_TS = _dt.datetime(2999, 12, 31, 23, 59, 59)
# Lookback cut times on the day before a batch (strict '>' comparison).
CUT_1H = "23:00:01"
CUT_20M = "23:40:01"
# Alert type codes, stored as text.
EVENT_PASSPORT = "1"
EVENT_CONTRACT = "2"
EVENT_CITY = "3"
EVENT_AMOUNT = "4"
# Operation vocabulary.
OPER_WITHDRAW = "WITHDRAW"
RESULT_SUCCESS = "SUCCESS"
RESULT_REJECT = "REJECT"
# Feed name prefixes, in the order a day's feeds are applied.
FEED_PREFIXES = ("passport", "terminals", "transactions")
# Audit table names.
AUDIT_FACT = "DWH_FACT_transactions"
AUDIT_BLACKLIST = "DWH_DIM_passport_blacklist"
AUDIT_TERMINALS = "DWH_DIM_terminals_HIST"


def _cut_seconds(cut: str) -> int:
    h, m, s = (int(x) for x in cut.split(":"))
    return h * 3600 + m * 60 + s


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds of the four rules; all are parameters."""

    semantics: Semantics = Semantics.INTENDED
    # Rule 3: two cities within this many seconds (inclusive).
    city_max_gap_s: int = 3600
    # Rule 4: number of rejected withdrawals before the success,
    # and the strict span in seconds from the first of them to the success.
    amount_n_rejects: int = 3
    amount_max_span_s: int = 1200
    # Lookback cut on the previous day (strict), per rule.
    city_cut: str = CUT_1H
    amount_cut: str = CUT_20M
    # Report date stamped on every alert (None -> current_date()).
    report_dt: _dt.date | None = None
    # Time bucket used to split one card's timeline across tasks; each bucket
    # also receives a halo of the rule's lookback span from the bucket before.
    city_bucket_s: int = 4 * 3600
    amount_bucket_s: int = 4 * 1200
    # Bucket sizes of the timeline scan that carries the last rows over each boundary instead of a
    # halo (None: halo buckets). For cards whose operations crowd into less than the lookback span.
    carry_buckets_s: tuple[int, ...] | None = None
    # Rows up to which a dimension side is broadcast (checked by count on a
    # bounding base table). A card-chain row is ~150 bytes: 1M rows ~ 150 MB.
    broadcast_max_rows: int = 1_000_000

    @property
    def city_cut_s(self) -> int:
        return _cut_seconds(self.city_cut)

    @property
    def amount_cut_s(self) -> int:
        return _cut_seconds(self.amount_cut)

    def with_(self, **kw) -> "RuleConfig":
        d = {f: getattr(self, f) for f in self.__dataclass_fields__}
        d.update(kw)
        return RuleConfig(**d)


DEFAULT = RuleConfig()
PARITY = RuleConfig(semantics=Semantics.PARITY)
# Report date fixed for reproducible query outputs.
FIXED_REPORT_DT = _dt.date(2024, 2, 1)
