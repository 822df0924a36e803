"""Helpers shared by the operators: tables, kept intermediates, bounded text batches, vectorised words."""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import checkpoint_dir

#: Text bytes that one vectorised step holds at a time inside a Python worker.
CHUNK_BYTES = 1 << 20
#: Rows of a training sample's ids and labels that may be broadcast (two numbers a row).
SAMPLE_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint folder and read it back.

    A written table survives the loss of any executor and is computed once, however often it is read.
    """
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(col: str, mod: int):
    """crc32 of a number's decimal text, modulo ``mod`` (NULL for NULL)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(mod))


def sampled(df: DataFrame, by: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most for each value of ``by``, chosen by a hash of doc_id.

    Only for fitting a model. The number of values of ``by`` must be small (languages, classes).
    """
    counts = {r[0]: r[1] for r in df.groupBy(by).count().collect()}
    keep_all = [v for v, n in counts.items() if n <= bound]
    cond = F.col(by).isin(keep_all) if keep_all else F.lit(False)
    h = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_000))
    for v, n in counts.items():
        if n > bound:
            cond = cond | ((F.col(by) == F.lit(v)) & (h < int(1_000_000 * bound / n)))
    return df.filter(cond)


def labelled_sample(docs: DataFrame, labels: DataFrame, by: str, bound: int) -> DataFrame:
    """doc_id, text and ``by`` of the documents with a label in the sample of ``labels`` (see ``sampled``).

    The sampled ids are written and counted. They are broadcast, so that the texts stay where they are, if there
    are no more than SAMPLE_ROWS; more come about only by ids with very many labels, and Spark picks the join then.
    """
    some = keep(docs.sparkSession, sampled(labels, by, bound).select(F.col("doc_id").alias("_id"), by), "sample-ids")
    side = F.broadcast(some) if some.count() <= SAMPLE_ROWS else some
    d = docs.select("doc_id", "text")
    return d.join(side, F.col("doc_id") == F.col("_id")).select("doc_id", "text", by)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process (functions are pickled by value)."""
    return sys.__dict__.setdefault("_cardwatch_llm", {}).setdefault(name, {})


def chunks(batches, text: int = 1, limit: int = CHUNK_BYTES):
    """Slices of Arrow batches whose ``text`` column holds about ``limit`` bytes (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(b.column(text)), 0)).astype(np.int64)
        end = np.cumsum(size)
        at = 0
        while at < b.num_rows:
            base = end[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(end, base + limit, side="right")))
            yield b.slice(at, to - at)
            at = to


def letter_table() -> np.ndarray:
    """Per code point: 1 for a letter, 2 for another word character (digit, combining mark), else 0."""
    c = worker_cache("letters")
    if "t" not in c:
        t = np.zeros(0x110000, np.uint8)
        for i in range(0x34000):  # the last letters that Unicode has given out lie below
            ch = chr(i)
            t[i] = 1 if ch.isalpha() else 2 if ch.isalnum() or 0x300 <= i < 0x370 else 0
        c["t"] = t
    return c["t"]


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by a line break, and each text's start (plus the end)."""
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return codes, bounds


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wraps)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    d = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run codes[start:end] (runs disjoint, in order, not empty)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = ends - starts
    first = np.cumsum(n) - n
    inside = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(first, n)
    pos = inside + np.repeat(starts, n)
    power = np.full(int(n.max()), 0x5851F42D4C957F2D, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    h = np.add.reduceat((codes[pos].astype(np.uint64) + np.uint64(7)) * power[inside], first)
    return mix64(h)


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (runs of letters and digits) and each text's first word (plus the end)."""
    codes, bounds = codes_of([t.lower() for t in texts])
    starts, ends = runs(letter_table()[codes] > 0)
    return run_hashes(codes, starts, ends), np.searchsorted(starts, bounds)


def column(batch: pa.RecordBatch, i: int) -> list[str]:
    """A string column as Python strings; NULL becomes the empty text."""
    return [x or "" for x in batch.column(i).to_pylist()]
