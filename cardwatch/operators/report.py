"""Alert report: union of the rules, optional dedup, export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.schemas import ALERT_COLS, ALERTS


def build(*alerts: DataFrame) -> DataFrame:
    """Union of rule outputs; duplicates stay (a pair may alert in two runs)."""
    return reduce(lambda a, b: a.unionByName(b), [a.select(*ALERT_COLS) for a in alerts])


def dedup(report: DataFrame) -> DataFrame:
    """Keep one row per distinct alert (all six columns)."""
    return report.dropDuplicates(ALERT_COLS)


#: order of the exported rows: by event, then by all other columns, so that it is total but for exact copies
EXPORT_ORDER = ("event_dt", "event_type", "passport", "fio", "phone", "report_dt")


def export(report: DataFrame, path: str, fmt: str = "csv", partition_by: str | None = None,
           order: tuple[str, ...] | None = None, max_records: int = 1_000_000) -> None:
    """Write the whole report anew; CSV gets a header.

    The files hold all six columns. With ``partition_by`` that column moves into the folder names. With ``order`` the
    rows are dealt into sorted ranges and every file holds at most ``max_records`` of them: read in the order of their
    names, the files are the sorted report, and no single task ever writes it all.
    """
    rows = report.select(*ALERT_COLS)
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    w = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("maxRecordsPerFile", max_records)
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """An exported CSV report with its schema, and ``export_file``, the number of the file that holds a row."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = spark.read.schema(ALERTS).option("header", True).csv(path)
    return rows.select(*ALERT_COLS, F.regexp_extract(name, r"^part-(\d+)", 1).cast("int").alias("export_file"))
