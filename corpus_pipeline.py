"""The corpus pipeline: language ID, SimHash near duplicates, decontamination, PII surrogates, packing.

Each stage works on what its predecessor kept; all but the last return the columns of ``documents``.

Defined results of all stages: rows are judged one by one, so repeated and NULL doc_ids never take another row along;
rows that repeat as a whole are near duplicates of each other, and one stays; NULL and empty texts have no language and go
with the first stage; very long texts are read whole; extra columns stay as they are; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import keep, table
from cardwatch.llm.decontam import contaminated
from cardwatch.llm.langid import keep_languages, trained
from cardwatch.llm.packing import pack
from cardwatch.llm.pii import replace
from cardwatch.llm.simhash import SimHashConfig, cluster


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number for every row (_row), written with it: rows are told apart whatever their doc_id."""
    return keep(docs.sparkSession, docs.withColumn("_row", F.monotonically_increasing_id()), name)


def by_row(docs: DataFrame) -> DataFrame:
    """Row number (as doc_id) and text, as the operators read documents."""
    return docs.select(F.col("_row").alias("doc_id"), "text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose main language is recognised; those without letters or without a main language go."""
    langs, model = trained(docs)
    return keep_languages(docs, langs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (three-word shingles, three bits) one row: of the smallest doc_id (NULL last, then the
    first in the table). Empty and NULL texts have one fingerprint and are one group."""
    rows = numbered(docs, "duplicate-rows")
    found = cluster(by_row(rows), SimHashConfig(shingle=3, max_bits=3)).select(
        F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_row")
    grouped = rows.select("doc_id", "_row").join(found, "_row")
    first = grouped.groupBy("_group").agg(F.min(place).alias("_first"))
    # the rows that go are few beside those that stay, so the texts need not move for them
    gone = grouped.join(first, "_group").filter(F.col("_row") != F.col("_first._row")).select("_row")
    return rows.join(keep(spark, gone, "duplicates"), "_row", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; each row is judged by its own text, NULL texts stay."""
    rows = numbered(docs, "leak-rows")
    found = contaminated(by_row(rows), table(spark, sf_dir, "benchmark"))
    leaks = keep(spark, found.select(F.col("doc_id").alias("_row")).distinct(), "leaks")
    return rows.join(leaks, "_row", "left_anti").select(*docs.columns)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with surrogates for personal data."""
    return replace(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in the training sequences."""
    return pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("private_data", private_data), ("packed", packed)]

#: learned models, a random walk and a tokenizer: SQL cannot express the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = keep(spark, docs, name)
    return docs
