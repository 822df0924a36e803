"""Feed files: discovery, batch dating, parsing, rejects and the load manifest.

Feeds land in one folder; the prefix of a file name routes it
(``passport*``, ``terminals*``, ``transactions*``) and the ``ddMMyyyy``
between the last ``_`` and the last ``.`` dates the batch. Hidden files
(``.DS_Store``) are skipped by Spark's file sources. A day's feeds apply in
the order passports, terminals, transactions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.config import FEED_PREFIXES
from cardwatch.functions.text import date_from_file_name, date_text_before_blank, feed_of_file_name, parse_amount
from cardwatch.schemas import BLACKLIST_FEED, FACT_COLS, TERMINAL_SNAPSHOT, TX_TEXT_FIELDS


def route(names: DataFrame) -> DataFrame:
    """``names`` (file_name) with the feed its prefix names, its batch date and its place among a day's feeds."""
    order = F.array_position(F.array(*[F.lit(p) for p in FEED_PREFIXES]), F.col("feed")).cast("int")
    return names.withColumn("feed", feed_of_file_name("file_name")).withColumn(
        "file_date", date_from_file_name("file_name")).withColumn("feed_order", order)


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """Every visible file of the folder: name, feed, batch date, order, and a reason when unusable.

    Only file metadata is read (the binary content column is pruned).
    """
    return classify(spark.read.format("binaryFile").load(folder))


def classify(found: DataFrame) -> DataFrame:
    """File metadata (the binaryFile columns) -> name, feed, batch date, order, and a reason when unusable.

    Hidden files (a name that starts with a dot or an underscore) are no feed files and leave no trace.
    """
    out = route(found.select(F.col("path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
                             F.col("length"), F.col("modificationTime")))
    out = out.filter(~F.col("file_name").rlike(r"^[._]"))
    reason = F.when(F.col("feed").isNull(), "unknown prefix").when(F.col("file_date").isNull(), "no date in name")
    # passport and terminal feeds come as CSV or Parquet; anything else must not pass as an empty feed
    table_feed = F.col("feed").isin("passport", "terminals")
    reason = reason.when(table_feed & ~F.col("file_name").rlike(r"\.(csv|parquet)$"), "unreadable file type")
    return out.withColumn("reject_reason", reason)


def named(spark: SparkSession, folder: str, names: list[str]) -> dict[str, str]:
    """Paths of the files with these names below ``folder``, in any depth; those that are not there are left out."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", "{" + ",".join(names) + "}").load(folder).select("path"))
    except AnalysisException as e:  # nothing has been moved yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["path"].rsplit("/", 1)[-1]: r["path"] for r in files.collect()}  # a day's files


def pending(discovered: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Usable files not yet recorded in the manifest (by file name), in batch order."""
    ok = discovered.filter(F.col("reject_reason").isNull())
    if manifest is not None:
        ok = ok.join(manifest.select("file_name"), "file_name", "left_anti")
    return ok


# ---------------------------------------------------------------- lines, one parser for load and queries

#: columns of a rejected row, the same for every feed
REJECT_COLS = ["file_name", "feed", "file_date", "line", "reject_reason"]
#: a character that no feed holds: read with it as the separator, a line stays one column
_NO_SEP = "\u0001"


def scan_lines(spark: SparkSession, source: str | list[str], glob: str) -> DataFrame:
    """Lines of text feeds as they are, with their file name, without each file's header line."""
    paths, opts = _paths(source, glob)
    raw = (spark.read.schema("line string, _whole string").option("sep", _NO_SEP).option("quote", "")
           .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_whole")
           .options(**opts).csv(paths))
    return raw.select(F.col("_metadata.file_name").alias("file_name"), F.coalesce("_whole", "line").alias("line"))


def parse_lines(lines: DataFrame, fields: list[str], sep: str, quote: str) -> DataFrame:
    """``lines`` (file_name, line) plus the text fields and ``_bad``, the line where their number does not fit.

    Fields are trimmed; an empty field is NULL.
    """
    ddl = ", ".join([*[f"`{c}` string" for c in fields], "_bad string"])
    opts = {"sep": sep, "quote": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad",
            "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    return lines.withColumn("_p", F.from_csv(F.trim("line"), ddl, opts)).select("file_name", "line", "_p.*")


def _classified(x: DataFrame, feed: str, values: dict, reason) -> DataFrame:
    """One frame of good and rejected rows: the feed's columns, then file_name, feed, file_date, line and reject_reason.

    A good row has no reason and no line; a rejected one has only its line and the reason.
    """
    x = x.withColumn("reject_reason", reason)
    ok = F.col("reject_reason").isNull()
    return x.select(*[F.when(ok, v).alias(c) for c, v in values.items()], "file_name", F.lit(feed).alias("feed"),
                    date_from_file_name("file_name").alias("file_date"), F.when(~ok, F.col("line")).alias("line"), "reject_reason")


def split_good(classified: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    return (classified.filter(F.col("reject_reason").isNull()).select(*cols),
            classified.filter(F.col("reject_reason").isNotNull()).select(*REJECT_COLS))


def classify_transactions(lines: DataFrame) -> DataFrame:
    """Transaction lines (file_name, line) -> good rows in the fact layout and rejected rows.

    Rejected: another number of fields than seven, a quoted field (the format has no quotes), a missing field,
    an unreadable time or amount. The batch date comes from the file name.
    """
    x = parse_lines(lines, TX_TEXT_FIELDS, ";", "")
    ts = F.try_to_timestamp(F.col("transe_date"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    missing, quoted = F.lit(False), F.lit(False)
    for c in TX_TEXT_FIELDS:
        missing = missing | F.col(c).isNull()
        quoted = quoted | F.coalesce(F.col(c).contains('"'), F.lit(False))
    x = x.withColumn("_ts", ts).withColumn("_amt", parse_amount("amt"))
    reason = (F.when(F.col("_bad").isNotNull(), "field count").when(quoted, "quoted field")
              .when(missing, "missing field").when(F.col("_ts").isNull(), "bad date")
              .when(F.col("_amt").isNull(), "bad amount"))
    values = {c: F.col(c) for c in FACT_COLS[:-1]} | {"transe_date": F.col("_ts"), "amt": F.col("_amt")}
    return _classified(x, "transactions", values, reason)


def classify_blacklist(rows: DataFrame, keep_null: bool = False) -> DataFrame:
    """Parsed passport rows (file_name, line, date, passport, _bad) -> good and rejected rows.

    A row without a passport is rejected, unless ``keep_null`` (the parity preset stores it).
    """
    x = rows.withColumn("_num", F.trim("passport"))
    reason = F.when(F.col("_bad").isNotNull(), "field count")
    if not keep_null:
        reason = reason.when(F.coalesce(F.col("_num"), F.lit("")) == "", "null passport")
    return _classified(x, "passport", {"passport_num": F.col("_num"),
                                       "source_entry_dt": date_text_before_blank("date")}, reason)


def classify_terminals(rows: DataFrame, keep_null: bool = False) -> DataFrame:
    """Parsed terminal rows (file_name, line, the snapshot's columns, _bad) -> good and rejected rows."""
    names = TERMINAL_SNAPSHOT.fieldNames()
    reason = F.when(F.col("_bad").isNotNull(), "field count")
    if not keep_null:
        reason = reason.when(F.coalesce(F.trim("terminal_id"), F.lit("")) == "", "null terminal")
    return _classified(rows, "terminals", {c: F.trim(c) for c in names}, reason)


def _paths(source: str | list[str], glob: str) -> tuple[str | list[str], dict]:
    """A folder (filtered by name glob) or an explicit list of files (read as given)."""
    if isinstance(source, (list, tuple)):
        return list(source), {}
    return source, {"pathGlobFilter": glob}


def read_transactions(spark: SparkSession, source: str | list[str],
                      glob: str = "transactions*") -> tuple[DataFrame, DataFrame]:
    """Scan transaction text files (a folder, or the files of one batch); (fact rows with file_date, rejects)."""
    return split_good(classify_transactions(scan_lines(spark, source, glob)), FACT_COLS)


def table_rows(spark: SparkSession, source: str | list[str], prefix: str, schema) -> DataFrame:
    """Rows of tabular feed files of one prefix, ``*.csv`` (header line) and ``*.parquet``: file_name, line, the
    schema's columns by position, ``_bad``.

    ``source`` is a folder or the explicit files of one batch. A Parquet file of another number of columns has
    only bad rows. The line of a Parquet row is its values as CSV.
    """
    names = schema.fieldNames()
    if isinstance(source, (list, tuple)):
        csv_src: str | list[str] = [p for p in source if p.endswith(".csv")]
        pq_src: str | list[str] = [p for p in source if p.endswith(".parquet")]
        pq_opts: dict = {}
    else:
        csv_src, pq_src = source, source
        pq_opts = {"pathGlobFilter": f"{prefix}*.parquet"}
    parts = []
    if csv_src:
        parts.append(parse_lines(scan_lines(spark, csv_src, f"{prefix}*.csv"), names, ",", '"'))
    if pq_src:
        try:
            pq = spark.read.options(**pq_opts).parquet(*([pq_src] if isinstance(pq_src, str) else pq_src))
        except AnalysisException as e:  # no Parquet feed of this kind in the folder
            if isinstance(source, (list, tuple)) or e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        else:
            cols = [F.col(f"`{c}`").cast("string") for c in pq.columns]
            line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cols])
            fits = len(cols) == len(names)
            text = F.lit(None).cast("string")
            parts.append(pq.select(F.col("_metadata.file_name").alias("file_name"), line.alias("line"),
                                   *[(cols[i] if fits else text).alias(n) for i, n in enumerate(names)],
                                   (text if fits else line).alias("_bad")))
    if not parts:
        return spark.createDataFrame([], "file_name string, line string, " + ", ".join(f"`{n}` string" for n in names)
                                     + ", _bad string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_blacklist(spark: SparkSession, folder: str | list[str], prefix: str = "passport") -> DataFrame:
    """Blacklist feed rows ``(date, passport)`` -> (passport_num, source_entry_dt, file_date)."""
    return split_good(classify_blacklist(table_rows(spark, folder, prefix, BLACKLIST_FEED)),
                      ["passport_num", "source_entry_dt", "file_date"])[0]


def read_terminals(spark: SparkSession, folder: str | list[str], prefix: str = "terminals") -> DataFrame:
    """Terminal snapshot rows with their snapshot day."""
    found = classify_terminals(table_rows(spark, folder, prefix, TERMINAL_SNAPSHOT))
    return split_good(found, [*TERMINAL_SNAPSHOT.fieldNames(), "file_date"])[0].withColumnRenamed("file_date", "snap_date")
