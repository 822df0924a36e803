"""Operator 11: mixing sources to target token counts by entropy balancing.

Every source has a target number of tokens. Among all rates (expected copies of each document, at most ``most``) that
meet the targets, entropy balancing takes those closest to one copy each in relative entropy. The solution is an
exponential tilt, rate = min(most, exp(lambda * size / mean size)), with one multiplier lambda a source. The
multipliers maximise a concave dual, whose gradient is the gap between taken and wanted tokens; each Newton iteration
is one aggregation over the sources' histograms of sizes, in Spark, with a bracket that keeps the steps safe. Sums are
exact decimals, so reruns agree to the last digit whatever the order of the tasks.

Rates are rounded into whole copies by carrying each document's rounding error to the next one, longest documents
first, so the short ones at the end absorb it. Sources are cut into buckets of documents for that, so no source, however
large, is walked through by one task. Rows of equal document, source and size count as one group with a multiplicity.

Targets: the sources by name (code points, NULL last) weigh ``weights`` in turn and share ``share`` of all tokens; no
target exceeds ``most`` times its source's tokens, and the excess is shared anew by weight among the others.

Defined results: NULL text has size 0; NULL sources form one source; NULL or repeated doc_ids are rows like any other;
documents of size 0 take 0; rows equal in document, source and size share their copies as evenly as possible; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, table

WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5             # of all tokens
    most: int = 2                  # copies of a document
    gap: float = 1e-7              # largest gap of a source's tokens to its target, relative
    rounds: int = 200              # Newton steps; the bracket alone halves within them
    bucket: int = 2_000            # groups of rows rounded together, about


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) of every row."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       size.alias("size"))


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``sources`` (one row each) with ``rank`` from 0 by name, NULL last: sorted ranges, counted one by one."""
    spark = sources.sparkSession
    s = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    inside = F.monotonically_increasing_id()
    s = keep(spark, s.withColumn("_part", F.shiftright(inside, 33)).withColumn(
        "_at", inside.bitwiseAND(F.lit((1 << 33) - 1))), "sources")
    sizes = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return s.join(before, "_part").withColumn("rank", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def targets(sources: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """``sources`` (source, source_size) with their target: the level is lowered on those that are full, until none is above.

    A round is one aggregation; only the level (one number) goes through the driver.
    """
    spark = sources.sparkSession
    weight = F.element_at(F.array(*[F.lit(w) for w in cfg.weights]), (F.col("rank") % len(cfg.weights) + 1).cast("int"))
    s = keep(spark, ranked_sources(sources).withColumn("weight", weight).withColumn(
        "most", F.lit(cfg.most) * F.col("source_size")).drop("rank"), "weights")
    wanted = cfg.share * (s.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.lit(level) * F.col("weight") > F.col("most")
        used, free, n = s.agg(F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)),
                              F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
                              F.count(F.when(full, 1))).first()
        new = (wanted - used) / free if free else math.inf
        if new <= level or not free:  # none is above any more
            break
        level = new
    target = F.least(F.lit(level) * F.col("weight"), F.col("most").cast("double"))
    return s.select("source", "source_size", target.alias("target"))


def multipliers(sizes: DataFrame, wanted: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """source, lam (NULL: every document at ``most``), mean of every source, by Newton iterations on the dual.

    ``sizes`` is the histogram (source, size, n) of positive sizes, ``wanted`` has source, source_size and target.
    """
    spark = sizes.sparkSession
    mean = sizes.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    at = wanted.withColumnRenamed("source", "_s").join(mean, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    full = F.col("target") >= cfg.most * F.col("source_size") * (1 - cfg.gap)
    at = keep(spark, at.select("source", "mean", "target", full.alias("full"), F.lit(0.0).alias("lam"),
                               F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
                               F.lit(1.0).alias("off")), "dual")
    exact = "decimal(38,12)"
    h = sizes.withColumnRenamed("source", "_s")
    for _ in range(cfg.rounds):
        open_ = at.filter(~F.col("full") & (F.col("off") > cfg.gap))
        x = F.col("size") / F.col("mean")
        j = h.join(open_.select("source", "mean", "lam"), F.col("_s").eqNullSafe(F.col("source")))
        tilt = F.exp(F.least(F.col("lam") * x, F.lit(math.log(cfg.most) + 1)))
        j = j.select("source", (F.col("n") * F.col("size") * F.least(tilt, F.lit(float(cfg.most)))).cast(exact).alias("_t"),
                     F.when(tilt < cfg.most, F.col("n") * F.col("size") * x * tilt).otherwise(0).cast(exact).alias("_d"))
        step = j.groupBy("source").agg(F.sum("_t").cast("double").alias("_t"), F.sum("_d").cast("double").alias("_d")) \
            .withColumnRenamed("source", "_s")
        moved = at.join(step, F.col("_s").eqNullSafe(F.col("source")), "left")
        gap = F.col("_t") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.when(F.col("_d") > 0, F.col("lam") - gap / F.col("_d"))
        # outside the bracket (or with no slope left): halve it, or go on outwards where it is open
        inside = newton.isNotNull() & (lo.isNull() | (newton > lo)) & (hi.isNull() | (newton < hi))
        outwards = F.when(lo.isNull(), hi - F.greatest(F.abs(hi), F.lit(1.0))).when(
            hi.isNull(), lo + F.greatest(F.abs(lo), F.lit(1.0))).otherwise((lo + hi) / 2)
        off = F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0))
        off = F.when((hi - lo) <= 1e-15 * F.greatest(F.abs(lo), F.lit(1.0)), 0.0).otherwise(off)
        new_lam = F.when(off <= cfg.gap, F.col("lam")).when(inside, newton).otherwise(outwards)
        live = F.col("_t").isNotNull()
        at = keep(spark, moved.select(
            "source", "mean", "target", "full", F.when(live, new_lam).otherwise(F.col("lam")).alias("lam"),
            F.when(live, lo).otherwise(F.col("lo")).alias("lo"), F.when(live, hi).otherwise(F.col("hi")).alias("hi"),
            F.when(live, off).otherwise(F.col("off")).alias("off")), "dual")
        if at.filter(~F.col("full") & (F.col("off") > cfg.gap)).limit(1).count() == 0:
            break
    return at.select("source", "mean", F.when(~F.col("full"), F.col("lam")).alias("lam"))


def groups_of(found: DataFrame) -> DataFrame:
    """doc_id, source, size, n: rows of ``sized`` that are alike, counted."""
    return found.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))


def rounded(groups: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """``groups`` (with rate and source_size) with ``copies``, the copies of all their rows together."""
    def run(key, t):
        size, n, rate = (t.column(c).to_pylist() for c in ("size", "n", "rate"))
        rank = t.column("_h").to_pylist()
        out, carry = [0] * len(size), 0.0
        for i in sorted(range(len(size)), key=lambda i: (-size[i], rank[i])):
            s, k, want = size[i], n[i], rate[i] * size[i] * n[i] + carry
            if s:
                out[i] = min(max(math.floor(want / s + 0.5), 0), cfg.most * k)
                carry = want - out[i] * s
            else:
                out[i] = k
        return t.drop_columns(["_h", "_b"]).append_column("copies", pa.array(out, pa.int64()))

    h = F.xxhash64("doc_id", "size")
    per = groups.groupBy("source").agg(F.count(F.lit(1)).alias("_g")).withColumnRenamed("source", "_s")
    x = groups.join(per, F.col("_s").eqNullSafe(F.col("source"))).withColumn("_h", h).withColumn(
        "_b", F.pmod(h, F.ceil(F.col("_g") / cfg.bucket))).drop("_s", "_g")
    schema = ("doc_id long, source string, size long, n long, source_size long, target double, rate double, "
              "copies long")
    return x.groupBy("source", "_b").applyInArrow(run, schema)


def plan(found: DataFrame, cfg: MixConfig = MixConfig(), goals: DataFrame | None = None) -> DataFrame:
    """Groups of rows of ``found`` (doc_id, source, size) with source_size, target, rate and copies.

    ``goals`` (source, source_size, target) may give other targets than the weights do.
    """
    spark = found.sparkSession
    groups = keep(spark, groups_of(found), "mix-groups")
    if goals is None:
        goals = targets(groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), cfg)
    goals = keep(spark, goals, "mix-targets")
    sizes = keep(spark, groups.filter("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n")), "mix-sizes")
    lam = multipliers(sizes, goals, cfg).withColumnRenamed("source", "_l")
    tilts = goals.withColumnRenamed("source", "_s").join(lam, F.col("_l").eqNullSafe(F.col("_s")), "left").drop("_l")
    rate = F.least(F.exp(F.col("lam") * F.col("size") / F.col("mean")), F.lit(float(cfg.most)))
    rate = F.when(F.col("size") == 0, 1.0).otherwise(F.coalesce(rate, F.lit(float(cfg.most))))
    rated = groups.join(tilts, F.col("_s").eqNullSafe(F.col("source"))).select(
        "doc_id", "source", "size", "n", "source_size", "target", F.round(rate, 9).alias("rate"))
    return rounded(rated, cfg)


def _of_row(j):
    """Copies of row ``j`` (from 0) of a group's n rows."""
    upto = [F.floor((j + d) * F.col("copies") / F.col("n")) for d in (0, 1)]
    return upto[1] - upto[0]


def takes(found: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken of every row of ``found``."""
    p = keep(found.sparkSession, plan(found, cfg), "mix-plan")
    # a group of very many rows is spread over tasks before its rows are written out
    step = 10_000
    p = p.withColumn("_a", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(step))))
    big = p.filter(F.col("n") > step).repartition("doc_id", "source", "size", "_a")
    p = p.filter(F.col("n") <= step).unionByName(big)
    rows = p.withColumn("_j", F.explode(F.expr(f"sequence(_a, least(_a + {step}, n) - 1)")))
    copies = _of_row(F.col("_j")).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as the mix takes it.

    Rows alike in document, source and size are numbered per partition of the written table and then across, so a
    large group of them is numbered by many tasks.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    d = keep(spark, docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_d"),
                                F.col("source").cast("string").alias("_s"), size.alias("_z"),
                                F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id")), "mix-docs")
    p = plan(d.select(F.col("_d").alias("doc_id"), F.col("_s").alias("source"), F.col("_z").alias("size")), cfg)
    like = Window.partitionBy("_d", "_s", "_z")
    parts = d.groupBy("_d", "_s", "_z", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = parts.select("_d", "_s", "_z", "_part", F.coalesce(F.sum("_n").over(
        like.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy("_d", "_s", "_z", "_part").orderBy("_id")) - 1
    b = before.toDF("bd", "bs", "bz", "bp", "_before")
    x = d.withColumn("_here", here).join(
        b, F.col("_d").eqNullSafe(F.col("bd")) & F.col("_s").eqNullSafe(F.col("bs")) & (F.col("_z") == F.col("bz"))
        & (F.col("_part") == F.col("bp")))
    x = x.join(p.select("doc_id", "source", "size", "n", "copies"), F.col("_d").eqNullSafe(F.col("doc_id"))
               & F.col("_s").eqNullSafe(F.col("source")) & (F.col("_z") == F.col("size")))
    copies = _of_row(F.col("_before") + F.col("_here"))
    return x.withColumn("_c", copies).filter("_c > 0").select(
        "_row", F.explode(F.sequence(F.lit(1), F.col("_c")))).select("_row.*")


def op11_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = takes(sized(table(spark, sf_dir, "documents")))
    return got.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")
