"""Operator 2: language ID by multilingual mixture inference.

Each language has an n-gram model (letters seen with both neighbours, word ends included). A document is a mixture:
every word is written in one of the languages, and expectation-maximisation estimates the document's language
proportions from the words' n-gram likelihoods. The language set is chosen by penalised likelihood: the nested set of
its largest languages grows for as long as the log-likelihood minus ``penalty`` times half the number of languages
times the log of the number of words rises. The prediction and its score are the largest share within that set.
Every label gets a model; beyond ``full_langs`` labels the n-gram table of each gets smaller, so memory stays bounded.

Defined results: NULL, empty or letterless text -> ``und``, score 0, no languages; no training rows -> ``und`` for
all; ties go to the language that sorts first; repeated rows are predicted alike, row by row; columns other than
doc_id and text are never read, so clashing names do no harm; NULL doc_id stays NULL and is not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks, codes_of, column, crc_mod, letter_table, mix64, runs, sampled, table

UND = "und"


@dataclass(frozen=True)
class LangConfig:
    buckets: int = 1 << 17         # n-gram hash table of each language
    train_per_lang: int = 3000     # bound of the training sample: documents of each language, about
    full_langs: int = 64           # labels up to which each has ``buckets``; more share the same memory
    smoothing: float = 0.1
    iterations: int = 8            # of expectation-maximisation for each language set
    penalty: float = 1.0


def grams(texts: list[str], buckets: int):
    """For every letter the bucket of its 3-gram; word starts; each text's first word."""
    codes, bounds = codes_of([t.lower() for t in texts])
    letter = letter_table()[codes] == 1
    starts, ends = runs(letter)
    c = np.where(letter, codes, 32).astype(np.uint64)
    c = np.concatenate((np.array([32], np.uint64), c, np.array([32], np.uint64)))
    h = mix64(c[:-2] * np.uint64(0x1F0A2B3C5) ^ c[1:-1] * np.uint64(0x9D39247E33) ^ c[2:] * np.uint64(0x2AF7398005))
    n = ends - starts
    return (h[letter] % np.uint64(buckets)).astype(np.int64), np.cumsum(n) - n, np.searchsorted(starts, bounds)


def fit(docs: DataFrame, cfg: LangConfig = LangConfig()) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and the log-likelihoods [bucket, language] from the labelled rows of ``docs``.

    Fitted on about ``train_per_lang`` documents of each language; what reaches the driver is one count for each
    language and bucket at most.
    """
    rows = docs.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    if not langs:
        return [], np.zeros((cfg.buckets, 0), np.float32)
    sample = sampled(rows, "lang", cfg.train_per_lang).select("lang", "text")
    buckets = max(1, cfg.buckets * cfg.full_langs // max(cfg.full_langs, len(langs)))
    place = {x: i for i, x in enumerate(langs)}

    def count(batches):
        for b in chunks(batches):
            of = np.array([place[x] for x in b.column(0).to_pylist()])
            g, first, doc = grams(column(b, 1), buckets)
            if not len(g):
                continue
            words = np.diff(np.append(first, len(g)))
            lang = np.repeat(np.repeat(of, np.diff(doc)), words)
            key, n = np.unique(lang * buckets + g, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["k", "n"])

    found = (sample.mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((len(langs), buckets))
    counts.reshape(-1)[found.k.to_numpy(np.int64)] = found.n.to_numpy(np.float64)
    counts += cfg.smoothing
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()


def _em(lik: np.ndarray, peak: np.ndarray, word_doc: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int):
    """Proportions [doc, lang] and log-likelihood of each document, languages outside ``allowed`` kept at zero."""
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    n = np.diff(np.append(first, len(lik))).astype(np.float32)[:, None]
    for _ in range(rounds):
        r = lik * pi[word_doc]
        r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-30)
        pi = np.add.reduceat(r, first, axis=0) / n
    mix = np.maximum((lik * pi[word_doc]).sum(axis=1), 1e-30)
    return pi, np.add.reduceat(np.log(mix) + peak, first)


def infer(texts: list[str], model: np.ndarray, cfg: LangConfig):
    """Index of the language (-1: none), its share and the chosen set (as a 0/1 row) for each text."""
    langs = model.shape[1]
    pred, score, chosen = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros((len(texts), langs), bool)
    g, first, doc = grams(texts, len(model))
    full = np.flatnonzero(np.diff(doc))
    if not len(g) or not langs:
        return pred, score, chosen
    ll = np.add.reduceat(model[g], first, axis=0)
    peak = ll.max(axis=1)
    lik = np.exp(ll - peak[:, None])
    at = doc[full]
    n = np.diff(doc)[full]
    word_doc = np.repeat(np.arange(len(full)), n)
    pi, _ = _em(lik, peak, word_doc, at, np.ones((len(full), langs), np.float32), cfg.iterations)
    order = np.argsort(-pi, axis=1, kind="stable")
    rows = np.arange(len(full))
    value = np.add.reduceat(ll, at, axis=0)[rows, order[:, 0]] - cfg.penalty * 0.5 * np.log(n + 1)
    share = np.zeros((len(full), langs), np.float32)
    share[rows, order[:, 0]] = 1
    size, rising, m = np.ones(len(full), int), rows, 2
    while len(rising) and m <= langs:
        words = np.isin(word_doc, rising)
        count = n[rising]
        allowed = np.zeros((len(rising), langs), np.float32)
        np.put_along_axis(allowed, order[rising, :m], 1, axis=1)
        got_pi, got = _em(lik[words], peak[words], np.repeat(np.arange(len(rising)), count), np.cumsum(count) - count,
                          allowed, cfg.iterations)
        got = got - cfg.penalty * 0.5 * m * np.log(count + 1)
        up = got > value[rising]
        rising = rising[up]
        value[rising], share[rising], size[rising] = got[up], got_pi[up], m
        m += 1
    pred[full], score[full] = share.argmax(axis=1), np.minimum(1, share.max(axis=1))
    for m in range(size.max()):
        chosen[full[size > m], order[size > m, m]] = True
    return pred, score, chosen


def _limit(langs: int, cfg: LangConfig) -> int:
    """Text bytes held at a time: the likelihoods have a column for each language."""
    return max(1, CHUNK_BYTES * cfg.full_langs // max(cfg.full_langs, langs))


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, cfg: LangConfig = LangConfig()) -> DataFrame:
    """doc_id, lang_pred, score (share of that language), langs (the chosen set, comma-joined) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x full_langs floats at most
    names = np.array([*langs, UND])

    def run(batches):
        for b in chunks(batches, limit=_limit(len(langs), cfg)):
            pred, score, chosen = infer(column(b, 1), shared.value, cfg)
            sets = [",".join(names[:-1][c]) for c in chosen]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names[pred]), pa.array(score), pa.array(sets, pa.string())],
                names=["doc_id", "lang_pred", "score", "langs"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, langs string")


def trained(docs: DataFrame, cfg: LangConfig = LangConfig()):
    """Model of the rows that are not held out (crc32 of doc_id modulo 3 is not 1)."""
    return fit(docs.filter(crc_mod("doc_id", 3) != 1), cfg)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, model = trained(docs)
    return predict(docs, langs, model).withColumn(
        "held_out", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    ).select("doc_id", "held_out", "lang_pred", "score", "langs")


def keep_languages(docs: DataFrame, langs: list[str], model: np.ndarray, min_score: float = 0.4,
                   cfg: LangConfig = LangConfig()) -> DataFrame:
    """Rows of ``docs`` (all columns) with a language whose share reaches ``min_score``; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for b in chunks(batches, at, _limit(len(langs), cfg)):
            pred, score, _ = infer(column(b, at), shared.value, cfg)
            yield b.filter(pa.array((pred >= 0) & (score >= min_score)))

    return docs.mapInArrow(run, docs.schema)
