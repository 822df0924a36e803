"""Parquet warehouse and the day-by-day load.

Layout under ``root`` (a shared folder on a cluster):

  dim/{cards,accounts,clients}   dimension copies, written once (mode ignore)
  data/<table>/<id>/             the rows of one table and day, as one load wrote them; never changed
  log/                           the commit log: which folder holds each table and day, audit counts, loaded files,
                                 refused files and their reasons

Tables by day: ``fact`` and ``rejects`` (batch day), ``alerts`` (run day), ``feed`` (passport rows as they came, by
batch day), ``blacklist`` (entry day), ``closed`` (closed terminal versions by the day that closed them) and ``open``
(the open versions, as left by the last snapshot day).

A load of a day is one commit (``commits``): it is seen whole or not at all. Re-running a day, or a further file of it,
writes the day anew from all its files; a day that comes late (later days are loaded) is worked into the history, and
the alerts of the loaded days that it bears on are raised anew. A day's feeds apply in the order passports, terminals,
transactions.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardwatch.config import AUDIT_BLACKLIST, AUDIT_FACT, AUDIT_TERMINALS, DEFAULT, FEED_PREFIXES, RuleConfig, Semantics
from cardwatch.operators import blacklist as bl
from cardwatch.operators import dims, report, rules, scd2
from cardwatch.operators.joins import BroadcastCheck
from cardwatch.operators.lookback import slice_of_run
from cardwatch.plans.commits import Commit, CommitLog
from cardwatch.schemas import (
    ACCOUNTS, ALERT_COLS, ALERTS_RUN, AUDIT, BLACKLIST, CARDS, CLIENTS, FACT, FACT_COLS, HIST_COLS, REJECTS,
    TERMINAL_ATTRS, TERMINALS_HIST,
)
from cardwatch.session import checkpoint_dir
from cardwatch.sources import feeds

ONE = _dt.timedelta(days=1)
_FEED = "passport_num string, file_date date"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, cfg: RuleConfig = DEFAULT):
        self.spark, self.root, self.cfg = spark, root.rstrip("/"), cfg
        self.log = CommitLog(spark, self.path("log"))
        self._commit: Commit | None = None   # the load under way
        self._known: dict | None = None
        checkpoint_dir(spark)  # lineage cuts go to the session's shared folder

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    # ------------------------------------------------------------ the log
    def folders(self) -> dict:
        """Folder of each table and day, with what the load under way has written so far."""
        if self._commit is None:
            return self.log.folders()
        if self._known is None:
            self._known = self.log.folders()
        return {**self._known, **self._commit.tables}

    def days(self, table: str) -> list[_dt.date]:
        """Days of which a load has been committed, without rows or with."""
        return sorted(d for t, d in self.folders() if t == table)

    @contextmanager
    def _load(self):
        """One commit for everything that is written inside; nothing is committed if it fails."""
        if self._commit is not None:  # part of a larger load
            yield self._commit
            return
        self._commit, self._known = Commit(), None
        try:
            yield self._commit
            self.log.append(self._commit)
        finally:
            self._commit, self._known = None, None

    # ------------------------------------------------------------ reads
    def _read(self, table: str, schema, days=None) -> DataFrame:
        """A table, or some of its days: only their folders are listed and read."""
        found = [f for (t, d), f in sorted(self.folders().items()) if t == table and f and (days is None or d in days)]
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*found)

    def _dim(self, name: str, schema) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.path("dim", name))
        except AnalysisException as e:  # no copies yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def cards(self) -> DataFrame:
        return self._dim("cards", CARDS)

    def accounts(self) -> DataFrame:
        return self._dim("accounts", ACCOUNTS)

    def clients(self) -> DataFrame:
        return self._dim("clients", CLIENTS)

    def fact(self, days=None) -> DataFrame:
        return self._read("fact", FACT, days)

    def rejects(self) -> DataFrame:
        """Rejected rows of all feeds: the line as it came, its file and the reason."""
        parts = [self._read(f"rejects/{feed}", REJECTS) for feed in FEED_PREFIXES]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    def blacklist(self) -> DataFrame:
        return self._read("blacklist", BLACKLIST)

    def alerts(self) -> DataFrame:
        return self._read("alerts", ALERTS_RUN)

    def audit(self) -> DataFrame:
        """Load counts per table and day: of the last load of each."""
        return self.log.latest("audit").select(F.col("day").alias("upload_dt"), F.col("table").alias("table_name"),
                                               "new_rows", "updated_rows", "deleted_rows").select(*AUDIT.fieldNames())

    def manifest(self) -> DataFrame:
        """Loaded files."""
        return self.log.frame().filter("kind = 'file'").select("file_name", "feed", F.col("day").alias("file_date"),
                                                               "committed_at")

    def refused(self) -> DataFrame:
        """Files that no load could use, and why."""
        return self.log.frame().filter("kind = 'refused'").select("file_name", "feed", F.col("day").alias("file_date"),
                                                                  "reason", "committed_at")

    def terminals_history(self, before: _dt.date | None = None) -> DataFrame:
        """The terminal history, or as it was before the merge of day ``before``."""
        hist = self._read("closed", TERMINALS_HIST).unionByName(self._read("open", TERMINALS_HIST))
        return hist if before is None else scd2.rewind(hist, before)

    # ------------------------------------------------------------ writes
    def bootstrap(self, cards: DataFrame, accounts: DataFrame, clients: DataFrame) -> None:
        """One-time dimension copies; an existing copy is kept."""
        for name, df, schema in (("cards", cards, CARDS), ("accounts", accounts, ACCOUNTS),
                                 ("clients", clients, CLIENTS)):
            df.select(*schema.fieldNames()).write.mode("ignore").parquet(self.path("dim", name))

    def _write(self, df: DataFrame, name: str, part: str | None = None, **counts) -> tuple[str, dict]:
        """Write ``df`` to a new folder; its path and the ``counts`` (aggregates) observed by the same job."""
        folder = self.path("data", name, uuid.uuid4().hex)
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()])
        w = df.write
        (w.partitionBy(part) if part else w).parquet(folder)
        return folder, {k: v or 0 for k, v in seen.get.items()}

    def _put(self, table: str, day: _dt.date, df: DataFrame, **counts) -> dict:
        """Write one day of a table."""
        folder, n = self._write(df, table, **counts)
        self._commit.tables[table, day] = folder if n["rows"] else None
        return n

    def _put_days(self, table: str, days: list[_dt.date], df: DataFrame, day: str, **counts) -> dict:
        """Write several days of a table in one job; ``day`` is a copy of the day column, for the folders."""
        per = {f"_{d:%Y%m%d}": F.count(F.when(F.col(day) == F.lit(d), 1)) for d in days}
        folder, n = self._write(df, table, day, **per, **counts)
        for d in days:
            self._commit.tables[table, d] = f"{folder}/{day}={d.isoformat()}" if n[f"_{d:%Y%m%d}"] else None
        return n

    def _counted(self, table: str, day: _dt.date, new: int, updated: int | None = None, deleted: int | None = None) -> None:
        self._commit.audits[table, day] = (new, updated, deleted)

    def _later(self, table: str, day: _dt.date) -> list[_dt.date]:
        return [d for d in self.days(table) if d > day]

    # ------------------------------------------------------------ feeds of one day
    def load_blacklist(self, day: _dt.date, feed: DataFrame) -> None:
        """Add the new passports of one feed as the rows of ``entry_dt = day``.

        The merge compares with the entries of the days before, so a re-run of the day gives the same rows. With
        later feeds loaded, a passport's first day may move: the entries from this day on are found anew, from the
        rows of those feeds as they were stored.
        """
        with self._load():
            later = self._later("feed", day)
            feed = feed.select("passport_num", F.lit(day).cast("date").alias("file_date"))
            self._put("feed", day, feed)
            feed = self._read("feed", _FEED, [day])
            before = self._read("blacklist", BLACKLIST, [d for d in self.days("blacklist") if d < day])
            if not later:
                _, rows = bl.merge_day(before, feed, day, self.cfg.semantics)
                n = self._put("blacklist", day, rows.select(*BLACKLIST.fieldNames()))["rows"]
                self._counted(AUDIT_BLACKLIST, day, n)
                return
            if self.cfg.semantics == Semantics.PARITY:
                raise ValueError(f"passports of {day}: the parity preset takes feeds in date order only")
            known = before.select("passport_num").filter("passport_num is not null")
            some = bl.new_entries(self._read("feed", _FEED, [day, *later])).join(known, "passport_num", "left_anti")
            rows = bl.table_from_new(some).withColumn("_day", F.col("entry_dt"))
            n = self._put_days("blacklist", [day, *later], rows, "_day")
            for d in [day, *later]:
                self._counted(AUDIT_BLACKLIST, d, n[f"_{d:%Y%m%d}"])

    def load_terminals(self, day: _dt.date, snapshot: DataFrame) -> None:
        """Merge one full snapshot into the history.

        The newest day reads and rewrites the open versions only; what it closes is appended. A day that runs again
        or comes late is spliced in: versions of the keys that it changes are replaced, in the days that hold them.
        """
        with self._load():
            done = [d for d in self.days("open") if d != day]
            before = max((d for d in done if d < day), default=None)
            after = min((d for d in done if d > day), default=None)
            if len(done) == len(self.days("open")) and after is None:
                self._merge_last(day, snapshot)
                return
            if self.cfg.semantics == Semantics.PARITY:
                if after is not None:
                    raise ValueError(f"terminals of {day}: the parity preset takes snapshots in date order only")
                self._replace_last(day, snapshot)
                return
            self._splice(day, snapshot, before, after)

    def _changes(self, column: str) -> dict:
        c = F.col(column)
        return {"new": F.count(F.when(c.isin(scd2.NEW, scd2.RETURNED), 1)),
                "updated": F.count(F.when(c == scd2.UPDATED, 1)), "deleted": F.count(F.when(c == scd2.DELETED, 1))}

    def _merge_last(self, day: _dt.date, snapshot: DataFrame) -> None:
        open_ = self._read("open", TERMINALS_HIST)
        hist = self.terminals_history() if self.cfg.semantics == Semantics.PARITY else None
        rows = scd2.merge_rows(open_, snapshot, day, "terminal_id", TERMINAL_ATTRS, self.cfg.semantics, hist)
        self._put_merged(day, rows)

    def _put_merged(self, day: _dt.date, rows: DataFrame) -> None:
        """Rows of a merge of the newest day: the open set is replaced, the closed rows are the day's."""
        rows = rows.withColumn("_open", scd2.is_open())
        folder, n = self._write(rows, "terminals", "_open", open=F.count(F.when(F.col("_open"), 1)), **self._changes("_change"))
        for d in self.days("open"):
            self._commit.tables["open", d] = None
        self._commit.tables["open", day] = f"{folder}/_open=true" if n["open"] else None
        self._commit.tables["closed", day] = f"{folder}/_open=false" if n["rows"] > n["open"] else None
        self._counted(AUDIT_TERMINALS, day, n["new"], n["updated"], n["deleted"])

    def _replace_last(self, day: _dt.date, snapshot: DataFrame) -> None:
        """The newest day once more, on the history from before it."""
        hist = self.terminals_history(before=day)
        rows = scd2.merge_rows(hist.filter(scd2.is_open()), snapshot, day, "terminal_id", TERMINAL_ATTRS,
                               self.cfg.semantics, hist)
        self._put_merged(day, rows)

    def _splice(self, day: _dt.date, snapshot: DataFrame, before: _dt.date | None, after: _dt.date | None) -> None:
        hist = self.terminals_history()
        found = scd2.splice(hist, snapshot, day, before, after, "terminal_id", TERMINAL_ATTRS)
        counts = {**self._changes("_change"), **{f"next_{k}": c for k, c in self._changes("_next_change").items()}}
        folder, n = self._write(found, "splice", **counts)
        found = self.spark.read.schema(found.schema).parquet(folder).filter("_new is not null")
        self._counted(AUDIT_TERMINALS, day, n["new"], n["updated"], n["deleted"])
        if after is not None:
            self._counted(AUDIT_TERMINALS, after, n["next_new"], n["next_updated"], n["next_deleted"])
        last = max([day, *self.days("open")])
        # the days whose rows change: those that closed, or now close, a version that is taken out or put in
        both = found.select(F.explode(F.concat(F.transform("_old", lambda x: x["effective_to"]),
                                               F.transform("_new", lambda x: x["effective_to"]))).alias("effective_to"))
        ends = both.select(F.when(~scd2.is_open(), F.date_add(F.to_date("effective_to"), 1)).alias("d")).distinct()
        days = sorted({r["d"] for r in ends.collect() if r["d"] is not None})  # calendar days
        old = self._read("closed", TERMINALS_HIST, days).unionByName(self._read("open", TERMINALS_HIST))
        rows = scd2.spliced(old, found, "terminal_id", TERMINAL_ATTRS)
        closed_on = F.when(scd2.is_open(), F.lit(None)).otherwise(F.date_add(F.to_date("effective_to"), 1))
        rows = rows.withColumn("_day", F.coalesce(closed_on, F.lit(_dt.date(9999, 12, 31))))
        folder, n = self._write(rows, "terminals", "_day", open=F.count(F.when(scd2.is_open(), 1)),
                                **{f"_{d:%Y%m%d}": F.count(F.when(F.col("_day") == F.lit(d), 1)) for d in days})
        for d in days:
            self._commit.tables["closed", d] = f"{folder}/_day={d.isoformat()}" if n[f"_{d:%Y%m%d}"] else None
        for d in {day, *self.days("open")}:
            self._commit.tables["open", d] = None
        self._commit.tables["open", last] = f"{folder}/_day=9999-12-31" if n["open"] else None

    def load_transactions(self, day: _dt.date, batch: DataFrame) -> None:
        """Write one day's operations and raise the four rules for run ``day``."""
        with self._load():
            folder, n = self._write(batch.select(*FACT_COLS[:-1], F.lit(day).cast("date").alias("file_date")), "fact")
            self._put_fact(day, folder, n["rows"])

    def _put_fact(self, day: _dt.date, folder: str | None, rows: int) -> None:
        self._commit.tables["fact", day] = folder if rows else None
        self._counted(AUDIT_FACT, day, rows)
        self.raise_alerts(day)

    def raise_alerts(self, day: _dt.date) -> None:
        """All four rules for run ``day``, from the tables."""
        with self._load():
            cfg = self.cfg
            chain = dims.card_chain(self.cards(), self.accounts(), self.clients())
            chain_check = BroadcastCheck(self.cards().select("card_num"), cfg.broadcast_max_rows)
            chain_bl = dims.with_blacklist(chain, self.blacklist())
            joined = rules.batch_joined(self.fact([day]), chain_bl, chain_check, True)
            pc = rules.passport_contract_alerts(joined, cfg.report_dt)
            hist = self.terminals_history()
            if cfg.semantics == Semantics.PARITY and any(d > day for d in self.days("open")):
                hist = scd2.rewind(hist, day + ONE)
            hist_check = BroadcastCheck(hist.select("terminal_id"), cfg.broadcast_max_rows)
            runs = self.spark.createDataFrame([(day,)], "run_date date")
            # both lookback slices of run `day` lie in the fact's days day-1 and day
            near = self.fact([day - ONE, day])
            recent = slice_of_run(near, day, min(cfg.city_cut_s, cfg.amount_cut_s))
            if cfg.semantics == Semantics.INTENDED and hist_check.ok:
                parts = [rules.city_amount_alerts(recent.drop("run_date"), hist, runs, chain_bl, cfg, chain_check,
                                                  cfg.report_dt, hist_check)]
            else:
                s1 = slice_of_run(near, day, cfg.city_cut_s)
                if cfg.semantics == Semantics.INTENDED:
                    hops = rules.city_hop_pair(s1, hist, runs, cfg, True, hist_check)
                else:
                    hops = rules.city_hop_rep(s1, hist, runs, cfg, False, hist_check)
                s2 = slice_of_run(near, day, cfg.amount_cut_s)
                parts = [rules.city_alerts(hops, chain, chain_check, cfg.report_dt),
                         rules.amount_alerts(rules.amount_guess(s2, runs, cfg), chain, chain_check, cfg.report_dt)]
            alerts = report.build(pc, *parts).withColumn("run_date", F.lit(day).cast("date"))
            self._put("alerts", day, alerts)

    # ------------------------------------------------------------ whole folder
    def load_folder(self, folder: str) -> list[_dt.date]:
        """Load every pending feed file of ``folder`` day by day; returns the days loaded."""
        return self.load_files(folder, feeds.discover(self.spark, folder))

    def load_files(self, folder: str, found: DataFrame, archive: str | None = None) -> list[_dt.date]:
        """Load the usable files of ``found`` (see ``feeds.classify``) that the log lacks, day by day.

        Files that cannot be used are recorded once, with the reason. ``archive``: where loaded files may have been
        moved to, in any depth.
        """
        seen = {(r["file_name"], r["reason"]) for r in self.refused().select("file_name", "reason").collect()}
        bad = found.filter(F.col("reject_reason").isNotNull())
        bad = [(r["file_name"], r["feed"], r["file_date"], r["reject_reason"]) for r in bad.collect()]
        with self._load() as commit:
            commit.files += [b for b in bad if (b[0], b[3]) not in seen]
        found = feeds.pending(found, self.manifest())
        plan = [(r["file_date"], r["feed_order"], r["feed"], r["file_name"])
                for r in found.select("file_date", "feed_order", "feed", "file_name").collect()]
        # the file list is metadata (one row per file), not data
        days = sorted({p[0] for p in plan})
        for day in days:
            self.load_day(folder, day, [p for p in plan if p[0] == day], archive)
        return days

    def load_day(self, folder: str, day: _dt.date, files: list[tuple], archive: str | None = None) -> None:
        """One day's files, as one commit."""
        by_feed: dict[str, list[str]] = {}
        for _, _, feed, name in sorted(files, key=lambda p: (p[1], p[3])):
            by_feed.setdefault(feed, []).append(name)
        # a day is written anew from all its files, so a further file of a loaded day adds to it
        before = {r["file_name"]: r["feed"] for r in self.manifest().filter(F.col("file_date") == F.lit(day)).collect()}
        fresh = [(n, f, day, None) for f, names in by_feed.items() for n in names if n not in before]
        earlier = sorted(n for n, f in before.items() if f in by_feed and n not in by_feed[f])
        for name in earlier:
            by_feed[before[name]].append(name)
        # read exactly this day's files: the folder keeps every earlier file as well
        moved = feeds.named(self.spark, archive, earlier) if archive and earlier else {}
        files_of = {f: [moved.get(n, f"{folder.rstrip('/')}/{n}") for n in names] for f, names in by_feed.items()}
        with self._load() as commit:
            anew = self._affected(day, by_feed)
            keep_null = self.cfg.semantics == Semantics.PARITY
            if "passport" in by_feed:
                rows = feeds.table_rows(self.spark, files_of["passport"], "passport", feeds.BLACKLIST_FEED)
                self.load_blacklist(day, self._parsed(feeds.classify_blacklist(rows, keep_null), "passport", day))
            if "terminals" in by_feed:
                rows = feeds.table_rows(self.spark, files_of["terminals"], "terminals", feeds.TERMINAL_SNAPSHOT)
                self.load_terminals(day, self._parsed(feeds.classify_terminals(rows, keep_null), "terminals", day))
            if "transactions" in by_feed:
                lines = feeds.scan_lines(self.spark, files_of["transactions"], "transactions*")
                # the parsed rows are the fact's rows: what was written once is not written again
                self._put_fact(day, *self._good(feeds.classify_transactions(lines), "transactions", day))
            for run in anew:
                self.raise_alerts(run)
            commit.files += fresh

    def _good(self, classified: DataFrame, feed: str, day: _dt.date) -> tuple[str | None, int]:
        """One pass over a day's files: all rows are written once, rejected ones apart; folder and number of the good ones."""
        bad = F.col("reject_reason").isNotNull()
        x = classified.withColumn("file_date", F.lit(day).cast("date")).withColumn("_bad", bad)
        folder, n = self._write(x, "parsed", "_bad", bad=F.count(F.when(F.col("_bad"), 1)))
        self._commit.tables[f"rejects/{feed}", day] = f"{folder}/_bad=true" if n["bad"] else None
        good = n["rows"] - n["bad"]
        return f"{folder}/_bad=false" if good else None, good

    def _parsed(self, classified: DataFrame, feed: str, day: _dt.date) -> DataFrame:
        folder, _ = self._good(classified, feed, day)
        if folder is None:
            return self.spark.createDataFrame([], classified.schema)
        return self.spark.read.schema(classified.schema).parquet(folder)

    def _affected(self, day: _dt.date, by_feed: dict) -> list[_dt.date]:
        """Loaded run days whose alerts a load of ``day`` may change, besides the day itself.

        Operations reach into the next day's lookback; a snapshot holds up to the next one, whose day looks back
        into it; a passport entry holds from its day on.
        """
        runs = set(self.days("fact"))
        out = {day + ONE} if "transactions" in by_feed else set()
        if "terminals" in by_feed:
            after = min(self._later("open", day), default=_dt.date.max)
            out |= {d for d in runs if day <= d <= after}
        if "passport" in by_feed:
            out |= {d for d in runs if d >= day}
        return sorted((out & runs) - ({day} if "transactions" in by_feed else set()))

    def export_report(self, out: str, fmt: str = "csv") -> None:
        report.export(self.alerts().select(*ALERT_COLS), out, fmt)
