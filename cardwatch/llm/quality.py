"""Operator 3: quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear score of its text features. Preference pairs (a label 1 document beats a label 0
document) fit the weights: logistic loss on the feature differences, ridge-penalised, by Newton steps. The decision
threshold is a quantile of the scores: the share of label 0 among the labelled rows. The weights come from a bounded
sample; the share and the quantile are exact, over all labelled rows that are not held out. The reported score is
the logistic of the distance to that threshold, shifted so that the threshold itself gets ``cut``.

Defined results: NULL text counts as empty; empty texts get the score of their (zero) features; without rows of both
labels every score is 0.5; NULL labels are not learned from; several labels of a doc_id are several training rows;
repeated documents are scored alike, row by row; NULL doc_id stays NULL and is not held out; only doc_id and text
are read, so other columns and clashing names do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, codes_of, column, crc_mod, keep, labelled_sample, letter_table, run_hashes, runs, table

SYMBOLS = "#*$%&|<>"
STOPS = ".!?…:;\"'”»)"


@dataclass(frozen=True)
class QualityConfig:
    train_per_label: int = 4000    # bound of the training sample: documents of each label, about
    pairs_per_loser: int = 40      # preference pairs drawn for each label 0 document of the sample
    ridge: float = 1.0
    newton_steps: int = 12
    cut: float = 0.3               # score at the threshold


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(x))
        return ((x - self.mean) / self.scale) @ self.weights


def _repeated(doc: np.ndarray, h: np.ndarray, docs: int) -> np.ndarray:
    """How many of each document's hashes equal an earlier one of the same document."""
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    same = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    return np.bincount(d[1:][same], minlength=docs)


def features(texts: list[str]) -> np.ndarray:
    """One row of features for each text; counts over the whole text."""
    codes, bounds = codes_of(texts)
    k = len(texts)
    doc = np.repeat(np.arange(k), np.diff(bounds))
    kind = letter_table()[codes]
    low = codes < 128
    ascii_ = np.where(low, codes, 0).astype(np.uint8)

    def per_doc(mask):
        return np.bincount(doc[mask], minlength=k).astype(float)

    def one_of(chars):
        t = np.zeros(128, bool)
        t[[ord(c) for c in chars if ord(c) < 128]] = True
        return t[ascii_] & low

    space = one_of("\t\n\v\f\r ")
    chars = np.maximum(np.diff(bounds) - 1, 1).astype(float)
    letters = per_doc(kind == 1)
    upper_code = np.zeros(0x250, bool)
    upper_code[[i for i in range(0x250) if chr(i).isupper()]] = True
    upper = per_doc((codes < 0x250) & upper_code[np.minimum(codes, 0x24F)])
    starts, ends = runs(~space)
    word_doc = doc[starts] if len(starts) else np.zeros(0, int)
    n = np.bincount(word_doc, minlength=k).astype(float)
    word_hash = run_hashes(codes, starts, ends)
    three = word_hash[:-2] * np.uint64(3) + word_hash[1:-1] * np.uint64(5) + word_hash[2:] * np.uint64(7)
    inside = word_doc[:-2] == word_doc[2:] if len(word_doc) > 2 else np.zeros(0, bool)
    breaks = codes == 10
    ls, le = runs(~breaks)
    line_doc = doc[ls] if len(ls) else np.zeros(0, int)
    lines = np.bincount(line_doc, minlength=k).astype(float)
    last = codes[le - 1] if len(ls) else codes[:0]
    unstopped = np.bincount(line_doc[~np.isin(last, [ord(c) for c in STOPS])], minlength=k)
    w, ln = np.maximum(n, 1), np.maximum(lines, 1)
    return np.column_stack([
        np.log1p(n), np.log1p(lines), letters / chars, upper / np.maximum(letters, 1), per_doc(kind == 2) / chars,
        *(per_doc(one_of(c)) / w for c in (SYMBOLS, "!", ".", ",", "|", "?", "@/:=_")),
        per_doc(one_of(SYMBOLS)) / chars, letters / w, np.log1p(n / ln),
        _repeated(word_doc, word_hash, k) / w, _repeated(line_doc, run_hashes(codes, ls, le), k) / ln,
        _repeated(word_doc[:-2][inside], three[inside], k) / w, unstopped / ln,
        n < 10, n < 50,
    ])


WIDTH = features([""]).shape[1]


def pairs(y: np.ndarray, per_loser: int) -> tuple[np.ndarray, np.ndarray]:
    """Winner and loser row numbers: each label 0 row meets ``per_loser`` label 1 rows, spread evenly."""
    win, lose = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    m = min(per_loser, len(win))
    if not m or not len(lose):
        return win[:0], lose[:0]
    step = np.arange(len(lose) * m)
    return win[(step * 7919 + step // max(len(win), 1)) % len(win)], np.repeat(lose, m)


def fit_ranking(x: np.ndarray, y: np.ndarray, cfg: QualityConfig) -> QualityModel:
    """Bradley-Terry weights from the pairs of the rows; the threshold is still to be set."""
    a, b = pairs(y, cfg.pairs_per_loser)
    if not len(a):
        return QualityModel(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(0), 0.0, cfg.cut)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1
    z = (x - mean) / scale
    d = z[a] - z[b]
    w = np.zeros(x.shape[1])
    for _ in range(cfg.newton_steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))  # chance that the loser would win
        hess = (d * (p * (1 - p))[:, None]).T @ d + cfg.ridge * np.eye(len(w))
        w = w + np.linalg.solve(hess, d.T @ p - cfg.ridge * w)
    return QualityModel(mean, scale, w, 0.0, cfg.cut)


def extract(docs: DataFrame, extra: str | None = None) -> DataFrame:
    """doc_id, the feature row ``x`` (and the column ``extra``) of every document."""
    def run(batches):
        for b in chunks(batches):
            x = features(column(b, 1))
            cols = [b.column(0), pa.array(list(x), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*cols, *b.columns[2:]], names=["doc_id", "x", "y"][: b.num_columns])

    cols = [F.col("doc_id").cast("long"), "text", *([F.col(extra).cast("long")] if extra else [])]
    return docs.select(*cols).mapInArrow(run, "doc_id long, x array<double>" + (", y long" if extra else ""))


def kth_smallest(df: DataFrame, k: int) -> float:
    """The ``k``-th smallest value (from 1) of the column ``s``, exactly: counts of ever finer ranges."""
    lo, hi = df.agg(F.min("s"), F.max("s")).first()
    while lo < hi:
        width = (hi - lo) / 4096
        part = F.least(F.floor((F.col("s") - lo) / F.lit(width)), F.lit(4095))
        ranges = df.filter(F.col("s").between(lo, hi)).groupBy(part.alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).collect()
        for r in sorted(ranges, key=lambda r: r["p"]):
            lo, hi = r["lo"], r["hi"]
            if k <= r["n"]:
                break
            k -= r["n"]
    return lo


def threshold(strong: DataFrame, lab: DataFrame) -> float:
    """Quantile of the labelled rows' strengths at the share of label 0, halfway to the next strength."""
    rows = strong.join(lab.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id")).select("s", "y")
    rows = keep(strong.sparkSession, rows, "labelled-strengths")
    k = rows.filter("y = 0").count()
    at = kth_smallest(rows, k)
    above = rows.agg(F.count(F.when(F.col("s") <= at, 1)), F.min(F.when(F.col("s") > at, F.col("s")))).first()
    return at if above[0] > k or above[1] is None else (at + above[1]) / 2


def learned(labels: DataFrame) -> DataFrame:
    """doc_id and label ``y`` of the rows that are learned from: labelled and not held out."""
    return labels.select("doc_id", F.col("quality").alias("y")).filter("y in (0, 1)").filter(crc_mod("doc_id", 5) != 0)


def fit_weights(docs: DataFrame, lab: DataFrame, cfg: QualityConfig = QualityConfig()) -> QualityModel:
    """Weights from a sample of the labelled rows bounded by ``train_per_label``."""
    rows = extract(labelled_sample(docs, lab, "y", cfg.train_per_label), "y").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    x = np.stack(rows.x.to_list()) if len(rows) else np.zeros((0, WIDTH))
    return fit_ranking(x, rows.y.to_numpy(), cfg)


def fit(docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> QualityModel:
    """Model of the labelled rows that are not held out: weights from the sample, threshold from all of them."""
    lab = learned(labels)
    model = fit_weights(docs, lab, cfg)
    return replace(model, threshold=threshold(strengths(docs, model), lab)) if len(model.weights) else model


def strengths(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and strength ``s`` of every row."""
    def run(batches):
        for b in chunks(batches):
            s = model.strength(features(column(b, 1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc_id", "s"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, s double")


def scored(strong: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score and predicted (the score reaches the cut, as the strength does the threshold) of rows with strengths."""
    if not len(model.weights):
        return strong.select("doc_id", F.lit(0.5).alias("score"), F.lit(int(0.5 >= model.cut)).alias("predicted"))
    shift = float(np.log(model.cut / (1 - model.cut)))
    far = F.greatest(F.least(F.col("s") - F.lit(model.threshold) + F.lit(shift), F.lit(500.0)), F.lit(-500.0))
    # rounding must not move a strength at the threshold across the cut: ``predicted`` is read off the score
    score_ = 1 / (1 + F.exp(-far))
    below = float(np.nextafter(model.cut, 0.0))
    score_ = F.when(F.col("s") >= F.lit(model.threshold), F.greatest(score_, F.lit(model.cut))).otherwise(
        F.least(score_, F.lit(below)))
    return strong.select("doc_id", score_.alias("score")).withColumn(
        "predicted", (F.col("score") >= F.lit(model.cut)).cast("int"))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score and predicted of every row."""
    return scored(strengths(docs, model), model)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lab = learned(table(spark, sf_dir, "labels"))
    model = fit_weights(docs, lab)
    strong = keep(spark, strengths(docs, model), "strengths")  # texts are read for features once
    if len(model.weights):
        model = replace(model, threshold=threshold(strong, lab))
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return scored(strong, model).select("doc_id", held.alias("held_out"), "score", "predicted")
