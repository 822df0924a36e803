"""Operator 9: toxicity by cumulative-link (proportional odds) ordinal regression.

Severity grades 0..3 are ordered; ``P(grade > k) = logistic(w . x - theta_k)`` with one weight vector shared by all
thresholds. Features are sparse and binary: a word or a word beginning (3 to 7 letters) occurs, occurs twice or
more at a rate of 0.4 %, or at a rate of 1 %. The result is the expected severity, the sum of the probabilities.

``labels.toxic`` is binary, so the training grades are made from it: toxic 0 is grade 0; the toxic rows are graded
1, 2, 3 by the thirds of the number of the model's features that they have. A feature leans if ``min_df`` toxic sample
rows have it and its smoothed log-odds towards toxic rows reach ``lean``. Of these the model's features are picked
one by one, by their association with toxic rows that no earlier pick explains; an L1 penalty shrinks the weights.
The sample is balanced by class, so the regression weights each of its rows by its class's full count over its sampled
count: thresholds and severities are those of all labelled rows. The log-odds compare rates within the classes, which
a sample by class leaves as they are.

Defined results: NULL or empty texts have no feature and get the base severity; without both classes every severity
is 0 and nothing is toxic; NULL labels are not learned from; repeated rows are scored alike, row by row; NULL
doc_id stays NULL and is not held out; only doc_id and text are read, so clashing names do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, codes_of, column, crc_mod, keep, labelled_sample, letter_table, mix64, run_hashes, runs, table


@dataclass(frozen=True)
class ToxicConfig:
    train_per_label: int = 4000    # bound of the training sample: documents of each label, about
    min_df: int = 4                # toxic sample rows that a feature needs at least
    lean: float = 2.5              # log-odds that make a feature toxic-leaning
    association: float = 16.0      # least likelihood-ratio statistic of a feature that gets a weight
    l1: float = 1e-4
    steps: int = 2000
    toxic_at: float = 0.5          # P(grade > 0) that flags a document


@dataclass(frozen=True)
class ToxicModel:
    vocab: np.ndarray              # sorted feature hashes
    base: np.ndarray               # sorted plain tokens behind the features
    weights: np.ndarray
    theta: np.ndarray              # three ordered thresholds (empty: no model)

    def probabilities(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(margin[:, None] - self.theta[None, :], -500, 500)))


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of every word and of its beginnings of 3 to 7 letters; number of words of each text."""
    codes, bounds = codes_of([t.lower() for t in texts])
    starts, ends = runs(letter_table()[codes] > 0)
    row = np.searchsorted(bounds, starts, side="right") - 1
    n = ends - starts
    whole = np.flatnonzero((n < 3) | (n > 7))
    rows, hashes = [row[whole]], [run_hashes(codes, starts[whole], ends[whole])]
    for k in range(3, 8):
        long = np.flatnonzero(n >= k)
        acc, power = np.zeros(len(long), np.uint64), np.uint64(1)
        for i in range(k):
            acc = acc + (codes[starts[long] + i].astype(np.uint64) + np.uint64(7)) * power
            power = np.uint64((int(power) * 0x5851F42D4C957F2D) % 2**64)
        rows.append(row[long])
        hashes.append(mix64(acc))
    return np.concatenate(rows), np.concatenate(hashes), np.bincount(row, minlength=len(texts))


def leveled(row, h, total) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature hash: each distinct token of a row, and again for each level that its count and rate reach."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(h)))
    row, h = row[at], h[at]
    rate = np.where(n >= 2, n / np.maximum(total[row], 1), 0)
    reached = [rate >= 0, rate >= 0.004, rate >= 0.01]
    return (np.concatenate([row[m] for m in reached]),
            np.concatenate([h[m] if not k else mix64(h[m] + np.uint64(k)) for k, m in enumerate(reached)]))


def lookup(vocab: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted vocabulary, or -1."""
    out = np.full(len(h), -1)
    if len(vocab):
        low = np.zeros(1 << 16, bool)
        low[vocab & np.uint64(0xFFFF)] = True
        some = np.flatnonzero(low[h & np.uint64(0xFFFF)])
        at = np.minimum(np.searchsorted(vocab, h[some]), len(vocab) - 1)
        out[some] = np.where(vocab[at] == h[some], at, -1)
    return out


def present(texts: list[str], vocab: np.ndarray, base: np.ndarray):
    """Row and vocabulary place of each text's features.

    ``base`` holds the plain token behind every vocabulary entry (sorted), so other tokens need no sort.
    """
    row, h, total = tokens(texts)
    some = lookup(base, h) >= 0
    row, h = leveled(row[some], h[some], total)
    at = lookup(vocab, h)
    return row[at >= 0], at[at >= 0]


def grades(toxic: np.ndarray, found: np.ndarray) -> np.ndarray:
    """0 for a clean row, else 1..3 by the thirds of the toxic rows' numbers of features."""
    edges = np.quantile(found[toxic == 1], [1 / 3, 2 / 3])
    return np.where(toxic == 1, 1 + np.searchsorted(edges, found, side="left"), 0)


def explaining(row, col, toxic: np.ndarray, width: int, least: float, lean: float,
               cover: int = 4) -> np.ndarray:
    """Columns picked one by one: the word most associated with the toxic rows that no earlier pick explains.

    The measure is a likelihood-ratio statistic; picking ends below ``least``. Only words with log-odds of ``lean``
    count (else the commonest words of the toxic rows' language would explain them all). Words that only come along with a
    pick (the prose of a copied toxic document) gain nothing once its rows are explained, by ``cover`` picks each.
    """
    picked: list[int] = []
    supports: list[np.ndarray] = []
    explained = np.zeros(len(toxic), int)
    by_col = np.argsort(col, kind="stable")
    start = np.searchsorted(col[by_col], np.arange(width + 1))
    b = np.bincount(col[toxic[row] == 0], minlength=width).astype(float)
    n0 = float((toxic == 0).sum())

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    while True:  # every pick explains rows of the sample, each at most ``cover`` times
        left = explained < cover
        n1 = float((left & (toxic == 1)).sum())
        if not n1:
            break
        a = np.bincount(col[(left & (toxic == 1))[row]], minlength=width).astype(float)
        ok = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1)) >= lean
        x, z, g2 = a[ok], b[ok], np.zeros(width)
        rate = (x + z) / (n1 + n0)
        g2[ok] = 2 * (part(x, n1 * rate) + part(z, n0 * rate) + part(n1 - x, n1 * (1 - rate))
                      + part(n0 - z, n0 * (1 - rate)))
        if not ok.any():
            break
        best = int(np.argmax(g2))
        if g2[best] < least:
            break
        rows = row[by_col[start[best]:start[best + 1]]]
        rows = rows[toxic[rows] == 1]
        b[best] = np.inf  # not again
        if any(np.isin(rows, p).sum() > 0.6 * len(np.union1d(rows, p)) for p in supports):
            continue  # a near copy of a pick: another beginning of the same words
        supports.append(rows)
        picked.append(best)
        explained[row[by_col[start[best]:start[best + 1]]]] += 1
    out = np.zeros(width, bool)
    out[picked] = True
    return out


def fit_ordinal(row, col, weight: np.ndarray, grade: np.ndarray, width: int, cfg: ToxicConfig) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds of the L1-penalised logistic losses, by accelerated proximal steps."""
    k = 3
    n = len(grade)
    y = (grade[:, None] > np.arange(k)).astype(float)
    top, u = 1.0, np.ones(width)
    for _ in range(30):  # largest eigenvalue of the features' second moments
        u = np.bincount(col, (weight * np.bincount(row, u[col], minlength=n))[row], minlength=width)
        top = max(np.linalg.norm(u), 1e-9)
        u = u / top
    step = 4 / (k * (top + 2))  # one over a bound of the gradient's Lipschitz constant
    now = np.concatenate((np.zeros(width), [1.0, 2.0, 3.0]))
    ahead, t = now.copy(), 1.0
    for _ in range(cfg.steps):
        margin = np.bincount(row, ahead[:width][col], minlength=n)
        err = (1 / (1 + np.exp(-np.clip(margin[:, None] - ahead[width:], -500, 500))) - y) * weight[:, None]
        g = np.concatenate((np.bincount(col, err.sum(axis=1)[row], minlength=width), -err.sum(axis=0)))
        new = ahead - step * g
        new[:width] = np.sign(new[:width]) * np.maximum(np.abs(new[:width]) - step * cfg.l1, 0)
        new[width:] = np.maximum.accumulate(new[width:])
        t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, now = new + (was - 1) / t * (new - now), new
    return now[:width], now[width:]


def fit(docs: DataFrame, labels: DataFrame, cfg: ToxicConfig = ToxicConfig()) -> ToxicModel:
    """Model of the labelled rows that are not held out (crc32 of doc_id modulo 5 is not 0), from a bounded sample."""
    lab = labels.select("doc_id", F.col("toxic").alias("y")).filter("y in (0, 1)").filter(crc_mod("doc_id", 5) != 0)
    sample = labelled_sample(docs, lab, "y", cfg.train_per_label)
    sample = sample.select(F.col("doc_id").cast("long"), "text", F.col("y").cast("long"))
    sample = keep(docs.sparkSession, sample, "toxic-sample")
    none = ToxicModel(*[np.zeros(0, np.uint64)] * 2, np.zeros(0), np.zeros(0))
    n = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    if len(n) < 2:
        return none
    # labelled rows of each class in all, for every sampled one
    full = docs.select("doc_id").join(lab, "doc_id").groupBy("y").count().collect()
    stands_for = {int(r[0]): r[1] / n[r[0]] for r in full}

    def count(batches):
        for b in chunks(batches):
            row, h, total = tokens(column(b, 1))
            y = b.column(2).to_numpy(zero_copy_only=False)
            plain = np.sort(np.unique(h))
            row, h = leveled(row, h, total)
            key, inv = np.unique(h, return_inverse=True)
            one = np.bincount(inv, y[row], minlength=len(key)).astype(np.int64)
            all_ = np.bincount(inv, minlength=len(key))
            of = np.zeros(len(key), np.int64)  # the plain token behind a level
            for k in range(3):
                at = lookup(key, plain if not k else mix64(plain + np.uint64(k)))
                of[at[at >= 0]] = plain[at >= 0].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(of), pa.array(one), pa.array(all_ - one)],
                names=["h", "of", "a", "b"])

    odds = F.log((F.col("a") + 0.5) / (n[1] + 1)) - F.log((F.col("b") + 0.5) / (n[0] + 1))
    lean = (sample.mapInArrow(count, "h long, of long, a long, b long").groupBy("h")
            .agg(F.min("of").alias("of"), F.sum("a").alias("a"), F.sum("b").alias("b"))
            .filter(F.col("a") >= cfg.min_df).filter(odds >= cfg.lean)
            .orderBy(F.desc("a"), "h").toPandas())  # features of the bounded sample's rows
    vocab = np.sort(lean.h.to_numpy(np.int64).view(np.uint64))
    base = np.unique(lean.of.to_numpy(np.int64).view(np.uint64))

    def run(batches):
        for b in chunks(batches):
            row, at = present(column(b, 1), vocab, base)
            order = np.argsort(row, kind="stable")
            cut = np.searchsorted(row[order], np.arange(b.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(at[order]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), lists], names=["doc_id", "y", "at"])

    got = sample.mapInArrow(run, "doc_id long, y long, at array<long>").toPandas()
    got = got.sort_values("doc_id", kind="stable").reset_index(drop=True)
    toxic = got.y.to_numpy(np.int64)
    row = np.repeat(np.arange(len(got)), got["at"].map(len).to_numpy(int))
    col = np.concatenate(got["at"].to_list()).astype(np.int64)
    picked = explaining(row, col, toxic, len(vocab), cfg.association, cfg.lean)
    row, col = row[picked[col]], (np.cumsum(picked) - 1)[col[picked[col]]]
    grade = grades(toxic, np.bincount(row, minlength=len(got)))
    # a toxic row is also learned from with each of its features alone, as the mildest grade: one is enough to flag
    alone = toxic[row] == 1
    parts = np.bincount(row, minlength=len(got)).astype(float)
    weight = np.where(toxic == 1, stands_for[1], stands_for[0])
    weight = np.concatenate((weight, stands_for[1] / parts[row[alone]]))
    row = np.concatenate((row, len(got) + np.arange(alone.sum())))
    col = np.concatenate((col, col[alone]))
    grade = np.concatenate((grade, np.ones(alone.sum(), grade.dtype)))
    w, theta = fit_ordinal(row, col, weight / weight.sum(), grade, int(picked.sum()), cfg)
    return ToxicModel(vocab[picked], base, w, theta)


def score(docs: DataFrame, model: ToxicModel, cfg: ToxicConfig = ToxicConfig()) -> DataFrame:
    """doc_id, expected_severity (0 to 3), grade (thresholds passed) and toxic (grade over 0) of every row."""
    def run(batches):
        for b in chunks(batches):
            if not len(model.theta):
                sev, grade = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int32)
            else:
                row, at = present(column(b, 1), model.vocab, model.base)
                p = model.probabilities(np.bincount(row, model.weights[at], minlength=b.num_rows).astype(float))
                sev, grade = p.sum(axis=1), (p >= cfg.toxic_at).sum(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sev), pa.array(grade), pa.array(grade > 0)],
                                             names=["doc_id", "expected_severity", "grade", "toxic"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, expected_severity double, grade int, toxic boolean")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "expected_severity", "grade", "toxic")
