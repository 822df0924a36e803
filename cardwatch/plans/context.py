"""Lazily built inputs of the named queries for one data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cardwatch.config import DEFAULT, FIXED_REPORT_DT, RuleConfig
from cardwatch.operators import blacklist, dims, lookback, scd2
from cardwatch.operators.joins import BroadcastCheck
from cardwatch.schemas import TERMINAL_ATTRS
from cardwatch.sources import fixtures
from cardwatch.sources.fixtures import read_table


class Inputs:
    """Warehouse-shaped inputs projected from the test tables (all lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str | None, cfg: RuleConfig = DEFAULT):
        self.spark, self.sf_dir = spark, sf_dir
        self.cfg = cfg.with_(report_dt=cfg.report_dt or FIXED_REPORT_DT)

    @classmethod
    def from_frames(cls, spark: SparkSession, cfg: RuleConfig = DEFAULT, **frames: DataFrame) -> "Inputs":
        """Inputs given as DataFrames: tx, cards, accounts, clients, bl_feed, snap (and hist)."""
        x = cls(spark, None, cfg)
        for k, v in frames.items():
            x.__dict__[k] = v  # pre-fills the cached properties
        if "cards" in frames and "chain_check" not in frames:
            x.__dict__["chain_check"] = BroadcastCheck(frames["cards"].select("card_num"), cfg.broadcast_max_rows)
        return x

    @cached_property
    def tx(self) -> DataFrame:
        return fixtures.tx(self.spark, self.sf_dir)

    @cached_property
    def cards(self) -> DataFrame:
        return fixtures.cards(self.spark, self.sf_dir)

    @cached_property
    def accounts(self) -> DataFrame:
        return fixtures.accounts(self.spark, self.sf_dir)

    @cached_property
    def clients(self) -> DataFrame:
        return fixtures.clients(self.spark, self.sf_dir)

    @cached_property
    def bl_feed(self) -> DataFrame:
        return fixtures.bl_feed(self.spark, self.sf_dir)

    @cached_property
    def snap(self) -> DataFrame:
        return fixtures.snap(self.spark, self.sf_dir)

    @cached_property
    def runs(self) -> DataFrame:
        return lookback.run_dates(self.tx)

    @cached_property
    def chain(self) -> DataFrame:
        return dims.card_chain(self.cards, self.accounts, self.clients)

    @cached_property
    def bl_new(self) -> DataFrame:
        return blacklist.new_entries(self.bl_feed)

    @cached_property
    def bl_table(self) -> DataFrame:
        return blacklist.table_from_new(self.bl_new.withColumnRenamed("source_date", "source_entry_dt"))

    @cached_property
    def chain_bl(self) -> DataFrame:
        return dims.with_blacklist(self.chain, self.bl_table)

    @cached_property
    def changes(self) -> DataFrame:
        return scd2.change_events(self.snap, "terminal_id", TERMINAL_ATTRS, "snap_date")

    @cached_property
    def hist(self) -> DataFrame:
        return scd2.history_from_events(self.changes, "terminal_id", TERMINAL_ATTRS)

    @cached_property
    def chain_check(self) -> BroadcastCheck:
        """Cards bound the card chain (inner joins on unique keys)."""
        return BroadcastCheck(read_table(self.spark, self.sf_dir, "customer").select("c_custkey"),
                              self.cfg.broadcast_max_rows, stats_key=(self.sf_dir, "customer"))

    @cached_property
    def hist_check(self) -> BroadcastCheck:
        """Each snapshot row opens at most one version and one tombstone; beyond that bound the history is counted."""
        return BroadcastCheck(self.snap.select("terminal_id"), self.cfg.broadcast_max_rows, factor=2,
                              stats_key=(self.sf_dir, "snap") if self.sf_dir else None,
                              exact=self.hist.select("terminal_id"))

    def batch_joined(self, alerts_only: bool = True) -> DataFrame:
        from cardwatch.operators import rules
        return rules.batch_joined(self.tx, self.chain_bl, self.chain_check, alerts_only)
