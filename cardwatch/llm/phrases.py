"""Operator 13: phrase collocations from sorted count streams.

Counting is external: every task turns slices of its texts into sorted runs of (lang, phrase, count), Spark merges the
runs by key, and the merged counts are kept twice, in prefix order (words left to right) and in suffix order (words
right to left). The counts that a candidate needs are then read off by merge joins of sorted streams, with no hash
table of phrases anywhere:

* left counts: candidates cut after their first k words, in lockstep with the prefix-ordered stream;
* right counts: the rest of each cut, in lockstep with the suffix-ordered stream;
* extension counts: the shorter phrases inside longer candidates, merged to the largest count for each.

Words and pairs are counted in a first pass. A phrase of three or four words can only be frequent if each pair in it
is, so the second pass counts only phrases whose pairs pass a bit filter of the frequent pairs. The filter has no false
negatives and a bounded size (``filter_bits``); a false positive costs work only, since every count is exact.

Defined results: NULL text is empty; NULL lang is ``und``; NULL or repeated doc_ids play no part (every row counts);
words are kept whole at any length, and long texts are worked through in slices whose phrases across the cuts are
counted once; ties of a cut go to the smallest k, ties of a rank to the larger count, then to the smaller phrase in byte
order; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, mix64, run_hashes, runs, table

COUNTS = "lang string, phrase string, c long"


@dataclass(frozen=True)
class PhraseConfig:
    least: int = 30                # occurrences of a candidate
    longest: int = 4               # words of a candidate, 2 to 4
    covered: int = 80              # per cent of a phrase's count in a longer one that drop it
    top: int = 2000                # phrases returned for each lang
    slice_bytes: int = 2 << 20     # text that one vectorised step holds
    filter_bits: int = 1 << 27     # most bits of the pair filter


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: 0 inside a word, 1 blank, 2 end of a piece; and A-Z to a-z."""
    kind = np.zeros(256, np.uint8)
    kind[[0x20, 0x09]] = 1
    kind[list(b".,;:!?\n\x0b\x0c\r")] = 2
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    return kind, low


def cut_text(text: bytes, limit: int, carry: int):
    """(bytes, words at its start that were counted before) of the slices of a text.

    A slice ends at the end of a piece, or else at a blank; then the next one starts with the last ``carry`` words.
    """
    kind, _ = _tables()
    seen = 0     # bytes of carried words at the start of text
    words = 0
    while len(text) > limit:
        k = kind[np.frombuffer(text, np.uint8)[seen:max(limit, seen + 1)]]
        ends, blanks = np.flatnonzero(k == 2), np.flatnonzero(k == 1)
        if len(ends):
            at, whole = seen + int(ends[-1]), True
        elif len(blanks) and (len(blanks) > 1 or blanks[0] > 0):
            at, whole = seen + int(blanks[-1]), False
        else:  # one word longer than the limit
            after = np.flatnonzero(kind[np.frombuffer(text, np.uint8)[seen + len(k):]])
            if not len(after):
                break
            at = seen + len(k) + int(after[0])
            whole = kind[text[at]] == 2
        part = text[:at]
        yield part, words
        if whole:
            text, seen, words = text[at + 1:], 0, 0
        else:  # the words of the last piece
            last = np.flatnonzero(kind[np.frombuffer(part, np.uint8)] == 2)
            tail = part[int(last[-1]) + 1 if len(last) else 0:].replace(b"\t", b" ").split(b" ")
            tail = [w for w in tail if w][-carry:] if carry else []
            head = b"".join(w + b" " for w in tail)
            text, seen, words = head + text[at + 1:], len(head), len(tail)
    yield text, words


def slices(batches, limit: int, carry: int):
    """(langs, texts, words counted before) of slices of about ``limit`` bytes; columns are lang and text."""
    langs, texts, known, size = [], [], [], 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            text = text.as_py()
            if not text:
                continue
            for part, words in cut_text(text, limit, carry):
                if texts and size + len(part) > limit:
                    yield langs, texts, known
                    langs, texts, known, size = [], [], [], 0
                langs.append(lang)
                texts.append(part)
                known.append(words)
                size += len(part)
    if texts:
        yield langs, texts, known


class Words:
    """The words of a slice: rank among the slice's sorted words, lang, piece, and whether they are counted here."""

    def __init__(self, langs: list[str], texts: list[bytes], known: list[int]):
        kind, low = _tables()
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        kinds = kind[data]
        inside = kinds == 0
        starts, ends = runs(inside)
        size = np.array([len(t) + 1 for t in texts], np.int64)
        first = np.cumsum(size) - size
        doc = np.searchsorted(first, starts, side="right") - 1
        self.piece = np.searchsorted(np.flatnonzero(kinds == 2), starts)
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(low[data[inside]].tobytes())]).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words = coded.dictionary.take(pa.array(order))
        self.rank = rank[coded.indices.to_numpy()] if len(starts) else np.zeros(0, np.int64)
        names, code = np.unique(np.array(langs, object).astype(str), return_inverse=True)
        self.langs = pa.array(names.tolist(), pa.string())
        self.lang = code[doc]
        place = np.arange(len(starts)) - np.searchsorted(doc, np.arange(len(texts)))[doc]
        self.fresh = place >= np.array(known, np.int64)[doc]

    def phrases(self, n: int) -> np.ndarray:
        """Whether the n words from each place are in one piece and end in a word that is counted here."""
        m = max(len(self.rank) - n + 1, 0)
        return (self.piece[:m] == self.piece[n - 1:n - 1 + m]) & self.fresh[n - 1:n - 1 + m]

    def pair_hashes(self) -> np.ndarray:
        """Hash of each word and the next."""
        offsets = np.frombuffer(self.words.buffers()[1], np.int64)[self.words.offset:self.words.offset + len(self.words) + 1]
        h = run_hashes(np.frombuffer(self.words.buffers()[2], np.uint8), offsets[:-1], offsets[1:])[self.rank]
        return pair_hash(h[:-1], h[1:])

    def batch(self, lang: np.ndarray, ranks: list[np.ndarray], count: np.ndarray):
        for at in range(0, len(count), 1 << 17):
            to = slice(at, at + (1 << 17))
            parts = [self.words.take(pa.array(r[to])) for r in ranks]
            text = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
            yield pa.RecordBatch.from_arrays(
                [self.langs.take(pa.array(lang[to])), text.cast(pa.binary()).cast(pa.string()), pa.array(count[to], pa.int64())],
                names=["lang", "phrase", "c"])


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _short_run(w: Words):
    """Sorted counts of a slice's words and pairs; the empty phrase counts all words of a lang."""
    v = max(len(w.words), 1)
    total = np.bincount(w.lang[w.fresh], minlength=len(w.langs))
    yield pa.RecordBatch.from_arrays([w.langs, pa.array([""] * len(w.langs), pa.string()), pa.array(total, pa.int64())],
                                     names=["lang", "phrase", "c"])
    key, n = np.unique((w.lang * v + w.rank)[w.fresh], return_counts=True)
    yield from w.batch(key // v, [key % v], n)
    at = np.flatnonzero(w.phrases(2))
    key, n = np.unique((w.lang[at] * v + w.rank[at]) * v + w.rank[at + 1], return_counts=True)
    yield from w.batch(key // v // v, [key // v % v, key % v], n)


def _long_run(w: Words, bits: np.ndarray, longest: int):
    """Sorted counts of a slice's phrases of three and four words all of whose pairs pass the filter."""
    if len(w.rank) < 3:
        return
    h = w.pair_hashes() & np.uint64(64 * len(bits) - 1)
    frequent = (bits[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) > 0
    del h
    frequent &= w.piece[:-1] == w.piece[1:]
    v = len(w.words)
    at = np.flatnonzero(frequent)
    key, code = np.unique((w.lang[at] * v + w.rank[at]) * v + w.rank[at + 1], return_inverse=True)
    pair = np.zeros(len(frequent), np.int32)   # numbers of the frequent pairs, by place
    pair[at] = code
    for n in range(3, longest + 1):
        some = w.phrases(n)
        for k in range(n - 1):
            some &= frequent[k:k + len(some)]
        at = np.flatnonzero(some)
        if n == 3:
            two, c = np.unique(pair[at].astype(np.int64) * v + w.rank[at + 2], return_counts=True)
            first, rest = key[two // v], [two % v]
        else:
            two, c = np.unique(pair[at].astype(np.int64) * len(key) + pair[at + 2], return_counts=True)
            first, other = key[two // len(key)], key[two % len(key)]
            rest = [other // v % v, other % v]
        yield from w.batch(first // v // v, [first // v % v, first % v, *rest], c)


def _merged(runs_: DataFrame, least: int) -> DataFrame:
    """The runs merged to exact counts; those that can matter stay."""
    return runs_.groupBy("lang", "phrase").agg(F.sum("c").alias("c")).filter((F.col("c") >= least) | (F.col("phrase") == ""))


def pair_filter(pairs: DataFrame, most_bits: int) -> np.ndarray:
    """Bit filter of the pairs (64 bits a number): 16 bits a pair up to ``most_bits``."""
    want = 16 * pairs.count()
    bits = 1 << 16
    while bits < min(want, most_bits):
        bits *= 2

    def places(batches):
        for b in batches:
            text = b.column(0).cast(pa.large_binary())
            if not len(text):
                continue
            parts = pc.split_pattern(text, b" ").flatten()
            offsets = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset:parts.offset + len(parts) + 1]
            h = run_hashes(np.frombuffer(parts.buffers()[2], np.uint8), offsets[:-1], offsets[1:])
            h = pair_hash(h[::2], h[1::2]) & np.uint64(bits - 1)
            one = np.uint64(1) << (h & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(6)).astype(np.int64)), pa.array(one.view(np.int64))],
                                             names=["i", "b"])

    found = pairs.select("phrase").mapInArrow(places, "i long, b long").groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found.column("i").to_numpy()] = found.column("b").to_numpy().view(np.uint64)
    return out


def phrase_counts(docs: DataFrame, cfg: PhraseConfig = PhraseConfig()) -> DataFrame:
    """lang, phrase, c of every phrase of one to ``longest`` words with at least ``least`` occurrences.

    The empty phrase has the number of all words of the lang.
    """
    spark = docs.sparkSession
    d = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    limit, carry = cfg.slice_bytes, cfg.longest - 1

    def short(batches):
        for part in slices(batches, limit, carry):
            yield from _short_run(Words(*part))

    first = keep(spark, _merged(d.mapInArrow(short, COUNTS), cfg.least), "phrases-short")
    if cfg.longest < 3:
        return first
    pairs = first.filter(F.col("phrase").contains(" "))
    bits = spark.sparkContext.broadcast(pair_filter(pairs, cfg.filter_bits))  # at most filter_bits, whatever the input

    def long(batches):
        for part in slices(batches, limit, carry):
            yield from _long_run(Words(*part), bits.value, cfg.longest)

    second = keep(spark, _merged(d.mapInArrow(long, COUNTS), cfg.least), "phrases-long")
    return first.unionByName(second)


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _stream(spark: SparkSession, counts: DataFrame, order: Column, name: str) -> DataFrame:
    """The count stream in the order of ``order``, written as sorted ranges."""
    s = counts.withColumn("_order", order).repartitionByRange("lang", "_order").sortWithinPartitions("lang", "_order")
    return keep(spark, s.select("lang", "phrase", "c"), name)


def scored_phrases(counts: DataFrame, cfg: PhraseConfig = PhraseConfig()) -> DataFrame:
    """lang, phrase, a, l, r, score of all candidates among ``counts`` that no longer one covers."""
    spark = counts.sparkSession
    real = counts.filter("phrase <> ''")
    words = F.split("phrase", " ", -1)
    prefix = _stream(spark, real, words, "phrases-prefix")
    suffix = _stream(spark, real, F.reverse(words), "phrases-suffix")
    cand = prefix.filter(F.col("phrase").contains(" ")).withColumn("w", words).withColumnRenamed("c", "a")
    size = F.size("w")

    cut = cand.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("first"),
        F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("rest"))
    left = prefix.select("lang", F.col("phrase").alias("first"), F.col("c").alias("l")).hint("merge")
    right = suffix.select("lang", F.col("phrase").alias("rest"), F.col("c").alias("r")).hint("merge")
    score = F.expr("(CAST(2000000 AS DECIMAL(8,0)) * CAST(a AS DECIMAL(20,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))

    # shorter phrases inside a longer candidate: those that start it, those that end it, and the middle
    inner = cand.filter(size > 2).select("lang", "w", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    inner = inner.select("lang", "w", "a", "m", F.explode(F.expr("sequence(1, size(w) - m + 1)")).alias("at")).select(
        "lang", F.expr("array_join(slice(w, at, m), ' ')").alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer")).hint("merge")
    open_ = F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(cfg.covered) * F.col("a"))
    left_over = best.join(longer, ["lang", "phrase"], "left").filter(open_)
    return left_over.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score"))


def ranked(found: DataFrame, top: int) -> DataFrame:
    """``found`` with the rank in its lang, the first ``top`` of each.

    A lang is cut to ``top`` in 512 parts, then in 16, before it meets in one task, which so never reads more than 16
    times ``top`` rows.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for parts in (512, 16, 1):
        part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        rank = F.row_number().over(Window.partitionBy("lang", "_p").orderBy(*order)).cast("long")
        found = found.withColumn("_p", part).withColumn("rank", rank).filter(F.col("rank") <= top)
    return found.drop("_p")


def collocations(docs: DataFrame, cfg: PhraseConfig = PhraseConfig()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of each lang."""
    counts = phrase_counts(docs, cfg)
    total = counts.filter("phrase = ''").select("lang", F.col("c").alias("n"))
    first = ranked(scored_phrases(counts, cfg), cfg.top)
    return first.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: DuckDB: all phrases of one to four words, counted plainly
SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m, count(*) AS c
          FROM spots, (SELECT unnest([1, 2, 3, 4]) AS m) s WHERE i + m - 1 <= len(w) GROUP BY 1, 2, 3),
total AS (SELECT lang, sum(c) AS n FROM grams WHERE m = 1 GROUP BY 1),
cand AS (SELECT *, string_split(phrase, ' ') AS p FROM grams WHERE m > 1 AND c >= 30),
cuts AS (SELECT lang, phrase, p, m, c, unnest(range(1, m)) AS k FROM cand),
scored AS (
  SELECT x.lang, x.phrase, x.c AS a, k, l.c AS l, r.c AS r,
         (2000000::HUGEINT * x.c) // (l.c + r.c) AS score
  FROM cuts x JOIN grams l ON l.lang = x.lang AND l.phrase = array_to_string(p[1:k], ' ')
              JOIN grams r ON r.lang = x.lang AND r.phrase = array_to_string(p[k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, p, m, c, unnest(range(2, m)) AS size FROM cand),
inner2 AS (SELECT lang, p, c, size, unnest(range(1, m - size + 2)) AS spot FROM inner_),
longer AS (SELECT lang, array_to_string(p[spot:spot + size - 1], ' ') AS phrase, max(c) AS longer FROM inner2 GROUP BY 1, 2),
open AS (SELECT b.* FROM best b LEFT JOIN longer x USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM open o JOIN total t ON t.lang = o.lang
QUALIFY rank <= 2000
"""
