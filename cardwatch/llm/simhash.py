"""Operator 8: SimHash near-duplicates with pivot distance tables.

A fingerprint has 64 bits; each is set if it is set in over half of the hashes of the text's word shingles. Copies
of a fingerprint are one node. Its row of the pivot table holds its Hamming distances to ``pivots`` reference
fingerprints. By the triangle inequality two fingerprints at ``max_bits`` or less differ by no more than that in any
column, so a pair is discarded by its largest column difference; the survivors are verified bit by bit.

Pairs come from tables of agreeing blocks: the bits are cut into ``blocks`` parts, of which ``blocks - max_bits`` at
least agree in any linked pair; there is one table for each choice of that many parts. Within a key a task keeps
only links that join parts (a spanning forest), so a group of near copies never becomes all its pairs; keys with
more than ``chunk`` fingerprints are cut into chunks, each pair of chunks being a task's run of its own.

Defined results: NULL, empty or blank text has fingerprint 0, linked like any other; rows with NULL doc_id are not
nodes (their component is NULL); a doc_id in several rows takes part with each row's fingerprint, and its
component is the smallest doc_id that one of them reaches, row by row; other columns are not read; ties do not
arise; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, column, keep, shuffle_partitions, table
from .unionfind import components, spanning


@dataclass(frozen=True)
class SimHashConfig:
    shingle: int = 3
    max_bits: int = 3
    pivots: int = 24
    blocks: int = 5                # 10 tables keyed by 25 or 26 bits
    chunk: int = 8192              # fingerprints of one key that meet in one run
    seed: int = 42


def fingerprint(text: str, cfg: SimHashConfig) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(cfg.shingle, len(words))
    joined = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - np.array([len(w) for w in words])
    digest, seed = xxhash.xxh64_intdigest, cfg.seed
    h = np.array([digest(joined[a:b], seed) for a, b in zip(start[: len(words) - k + 1].tolist(),
                                                            end[k - 1:].tolist(), strict=True)], np.uint64)
    n = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        n += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * n > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, cfg: SimHashConfig = SimHashConfig()) -> DataFrame:
    """doc_id and fingerprint ``fp`` (its 64 bits as a long) of every row."""
    def run(batches):
        for b in chunks(batches):
            fp = np.array([fingerprint(t, cfg) for t in column(b, 1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def tables(cfg: SimHashConfig) -> list[int]:
    """One mask for each choice of blocks that must agree."""
    cut = [round(64 * i / cfg.blocks) for i in range(cfg.blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(cut, cut[1:])]
    return [sum(c) for c in combinations(block, cfg.blocks - cfg.max_bits)]


def references(cfg: SimHashConfig) -> np.ndarray:
    """The reference fingerprints: fixed pseudo-random words."""
    return np.random.default_rng(cfg.seed).integers(0, 2**64, cfg.pivots, dtype=np.uint64)


def pivot_table(fp: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)


def links_of_runs(run: np.ndarray, fp: np.ndarray, cfg: SimHashConfig) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (places) between linked fingerprints of the same run (``run`` is sorted)."""
    n = len(fp)
    dist = pivot_table(fp, references(cfg))
    label = np.arange(n)
    out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    left = np.flatnonzero(np.append(run[1:] == run[:-1], False))
    step = 1
    while len(left):
        other = left + step
        near = np.ones(len(left), bool)
        for p in range(0, cfg.pivots, 4):  # discard by the largest difference of the table's columns
            some = np.flatnonzero(near)
            if not len(some):
                break
            d = np.abs(dist[left[some], p:p + 4] - dist[other[some], p:p + 4]).max(axis=1)
            near[some[d > cfg.max_bits]] = False
        some = np.flatnonzero(near)
        some = some[np.bitwise_count(fp[left[some]] ^ fp[other[some]]) <= cfg.max_bits]
        a, b = spanning(left[some], other[some], n, label)
        out[0].append(a)
        out[1].append(b)
        step += 1
        left = left[left + step < n]
        left = left[run[left] == run[left + step]]
    return np.concatenate(out[0]), np.concatenate(out[1])


def links(nodes: DataFrame, cfg: SimHashConfig = SimHashConfig()) -> DataFrame:
    """Links (a, b: node numbers) that connect what fingerprints at ``max_bits`` or less connect.

    ``nodes`` has distinct ``fp`` and ``node``.
    """
    spark = nodes.sparkSession
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in tables(cfg)]
    keyed = nodes.select("fp", "node", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("t", "key"))
    size = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    size = size.select(F.col("t").alias("_t"), F.col("key").alias("_key"), "n")
    met = keyed.join(size, (F.col("t") == F.col("_t")) & (F.col("key") == F.col("_key")))
    # a key with c chunks: a fingerprint of chunk i joins the runs (i, j) of all j, so any two chunks meet
    parts = F.ceil(F.col("n") / cfg.chunk)
    mine = F.pmod(F.xxhash64("fp"), parts)
    met = met.select("fp", "node", "t", "key", mine.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
                     .alias("j"))
    run = F.xxhash64("t", "key", F.least("i", "j"), F.greatest("i", "j"))
    met = met.select("fp", "node", run.alias("run"))
    met = met.repartition(shuffle_partitions(spark), "run").sortWithinPartitions("run", "fp")

    def find(batches):
        rest: list = []

        def flush(some):
            t = pa.Table.from_batches(some)
            r, f, v = (t.column(c).to_numpy() for c in ("run", "fp", "node"))
            a, b = links_of_runs(r, f.view(np.uint64), cfg)
            return pa.RecordBatch.from_arrays([pa.array(v[a]), pa.array(v[b])], names=["a", "b"])

        for batch in batches:  # whole runs only: the last run of a batch waits for the next batch
            if not batch.num_rows:
                continue
            r = batch.column("run").to_numpy()
            cut = int(np.searchsorted(r == r[-1], True))
            if cut or (rest and rest[-1].column("run")[0].as_py() != r[-1]):
                yield flush([*rest, batch.slice(0, cut)])
                rest = []
            rest.append(batch.slice(cut))
        if rest:
            yield flush(rest)

    return met.select("run", "fp", "node").mapInArrow(find, "a long, b long")


def cluster(docs: DataFrame, cfg: SimHashConfig = SimHashConfig()) -> DataFrame:
    """doc_id, fp and component_id of every row."""
    spark = docs.sparkSession
    fps = keep(spark, fingerprints(docs, cfg), "fingerprints")
    nodes = keep(spark, fps.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    found = components(links(nodes, cfg)).withColumnRenamed("node", "_n")
    roots = nodes.join(found, nodes.node == found["_n"], "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component", "node").alias("_c"))
    return fps.join(roots, fps.fp == roots["_fp"], "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("_c")).alias("component_id"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cluster(table(spark, sf_dir, "documents"))
    return c.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
