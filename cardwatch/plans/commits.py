"""The warehouse's commit log: which folder holds the rows of each table and day.

Every write goes to a folder of its own that nothing reads yet. One commit then names the folders of all tables and
days that a load wrote, together with its audit counts, the files it loaded and the files it refused. Readers resolve
a table through the newest commit of each of its days, so a load is seen whole or not at all: a crash between any two
writes leaves the state before, and what it wrote is never read. A day without rows has a commit without a folder.

A commit is one Parquet file, put in place by one rename. The log grows with days and files, never with rows; loads
come from one job at a time (the batch load or the stream).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("kind", T.StringType()),          # table, audit, file, refused
    T.StructField("table", T.StringType()), T.StructField("day", T.DateType()),
    T.StructField("folder", T.StringType()), T.StructField("new_rows", T.LongType()),
    T.StructField("updated_rows", T.LongType()), T.StructField("deleted_rows", T.LongType()),
    T.StructField("file_name", T.StringType()), T.StructField("feed", T.StringType()),
    T.StructField("reason", T.StringType()), T.StructField("committed_at", T.TimestampType()),
])


@dataclass
class Commit:
    """What one load adds to the log."""

    tables: dict[tuple[str, _dt.date], str | None] = field(default_factory=dict)
    audits: dict[tuple[str, _dt.date], tuple] = field(default_factory=dict)
    files: list[tuple[str, str, _dt.date | None, str | None]] = field(default_factory=list)  # name, feed, day, reason

    def rows(self, seq: int, now: _dt.datetime) -> list[tuple]:
        none = (None,) * 3
        out = [(seq, "table", t, d, f, *none, *none, now) for (t, d), f in self.tables.items()]
        out += [(seq, "audit", t, d, None, *n, *none, now) for (t, d), n in self.audits.items()]
        out += [(seq, "file" if why is None else "refused", None, d, None, *none, name, feed, why, now)
                for name, feed, d, why in self.files]
        return out


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def frame(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def latest(self, kind: str) -> DataFrame:
        """The newest row of each table and day."""
        c = self.frame().filter(F.col("kind") == kind)
        return c.groupBy("table", "day").agg(F.max(F.struct("seq", *[x for x in LOG.fieldNames() if x not in (
            "seq", "table", "day")])).alias("_l")).select("table", "day", "_l.*")

    def folders(self) -> dict[tuple[str, _dt.date], str | None]:
        """Table and day to folder; one entry a table and day, so it is metadata."""
        return {(r["table"], r["day"]): r["folder"] for r in self.latest("table").select("table", "day", "folder").collect()}

    def append(self, commit: Commit) -> None:
        if not (commit.tables or commit.audits or commit.files):
            return
        seq = (self.frame().agg(F.max("seq")).first()[0] or 0) + 1
        found = commit.rows(seq, _dt.datetime.now())
        self.spark.createDataFrame(found, LOG).coalesce(1).write.mode("append").parquet(self.path)
