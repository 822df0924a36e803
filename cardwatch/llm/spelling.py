"""Operator 12: spelling variants by asymmetric chunks.

Words within one edit (a code point inserted, deleted or replaced) are found by a join on chunks. The shorter word of a
pair gives two disjoint chunks, its halves; the longer one gives its positional grams of the same lengths. One edit
harms at most one half, so the other is found in the longer word at its own place or one place further (its distance
from the end is kept instead). Joined words are verified by their edit distance.

A half is shared by very many words (``inter...``), and joining on it alone would bring all of them together. So the
half that may hold the edit is cut in two chunks once more: one of these is unharmed as well, and the join is on both
chunks together. This splits every group, hot or not, in the same way, and loses no pair.

A word's form is its near word of largest count, if that is ``ratio`` times its own; forms are followed to their root
by pointer doubling.

Defined results: NULL text has no words; NULL doc_id is written as empty text in the hash; repeated rows count each;
a run is one word at any length, and long texts are worked through in slices; ties of a form go to the smallest word in
code-point order; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, runs, table


@dataclass(frozen=True)
class SpellingConfig:
    least_length: int = 6          # code points of a word
    least_count: int = 5           # occurrences of a word
    ratio: int = 5                 # a form occurs so many times as often
    typo: int = 199                # runs whose hash this divides lose a code point
    slice_bytes: int = 8 << 20     # text that one vectorised step holds


def in_run(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[A-Za-z\\u00C0-\\u00FF]`` in UTF-8: ASCII letters, and C3 with the byte after it."""
    lead = data == 0xC3
    mask = ((data | 32) >= 97) & ((data | 32) <= 122) | lead
    mask[1:] |= lead[:-1]
    return mask


def slices(batches, limit: int):
    """(doc_id texts, texts) of slices of about ``limit`` bytes; longer texts are cut between runs."""
    ids, texts, size = [], [], 0
    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            text = text.as_py()
            while text:
                if len(text) <= limit:
                    part, text = text, b""
                else:
                    gaps = np.flatnonzero(~in_run(np.frombuffer(text, np.uint8)[:limit]))
                    if len(gaps):
                        cut = int(gaps[-1]) + 1
                    else:  # a run longer than the limit
                        after = np.flatnonzero(~in_run(np.frombuffer(text, np.uint8))[limit:])
                        cut = limit + int(after[0]) + 1 if len(after) else len(text)
                    part, text = text[:cut], text[cut:]
                if texts and size + len(part) > limit:
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append("" if doc is None else str(doc))
                texts.append(part)
                size += len(part)
    if texts:
        yield ids, texts


def count_slice(ids: list[str], texts: list[bytes], cfg: SpellingConfig) -> pa.RecordBatch:
    """word, n of a slice: runs lower-cased, hashed with their document, and shortened where the hash says so."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    inside = in_run(data)
    starts, ends = runs(inside)
    lead = np.cumsum(np.concatenate(([0], data == 0xC3)))
    points = ends - starts - (lead[ends] - lead[starts])
    some = points >= cfg.least_length      # losing a code point never lengthens a run
    starts, ends = starts[some], ends[some]
    if not len(starts):
        return pa.RecordBatch.from_arrays([pa.array([], pa.string()), pa.array([], pa.int64())], names=["word", "n"])
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] = 1
    edge[ends] -= 1
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(low[np.cumsum(edge[:-1]) > 0].tobytes())]).dictionary_encode()
    words = coded.dictionary.to_pylist()
    code = coded.indices.to_numpy().astype(np.int64)
    size = np.array([len(t) + 1 for t in texts], np.int64)
    doc = np.searchsorted(np.cumsum(size) - size, starts, side="right") - 1
    key, n = np.unique(doc * len(words) + code, return_counts=True)
    doc, code = key // len(words), key % len(words)
    begun = [zlib.crc32(f"{i}:".encode()) for i in ids]
    crc = zlib.crc32
    h = np.fromiter((crc(words[c], begun[d]) for c, d in zip(code.tolist(), doc.tolist())), np.int64, len(code))
    typo = h % cfg.typo == 0
    plain = np.bincount(code[~typo], n[~typo], minlength=len(words)).astype(np.int64)
    at = np.flatnonzero(plain)
    out, counts = [words[i].decode() for i in at.tolist()], plain[at].tolist()
    for c, k, hash_ in zip(code[typo].tolist(), n[typo].tolist(), h[typo].tolist()):
        w = words[c].decode()
        w = w[:hash_ % len(w)] + w[hash_ % len(w) + 1:]
        if len(w) >= cfg.least_length:
            out.append(w)
            counts.append(k)
    return pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])


def word_counts(docs: DataFrame, cfg: SpellingConfig = SpellingConfig()) -> DataFrame:
    """word, n of all words long and frequent enough."""
    def run(batches):
        for ids, texts in slices(batches, cfg.slice_bytes):
            yield count_slice(ids, texts, cfg)

    parts = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= cfg.least_count)


def chunk_keys(word: Column, size: Column) -> list[Column]:
    """The chunks of ``word`` that an unharmed word of ``size`` code points would have, for each place of the edit.

    ``size`` is the length of the shorter word; half = size div 2. First half whole and the second half's first or
    last part; or second half whole and the first half's first or last part. Chunks before the edit keep their place
    from the start, those after it their place from the end (shift one in a longer word).
    """
    half = F.floor(size / 2).cast("int")
    rest = size - half
    ends = [(half + F.floor(rest / 2).cast("int"), F.lit(0)), (half, rest - F.floor(rest / 2).cast("int")),
            (F.floor(half / 2).cast("int"), rest), (F.lit(0), size - F.floor(half / 2).cast("int"))]
    n = F.char_length(word)
    return [F.concat(F.substring(word, F.lit(1), p), F.lit("|"), F.substring(word, n - s + 1, s)) for p, s in ends]


def near_pairs(words: DataFrame) -> DataFrame:
    """u, un, v, vn of all pairs of ``words`` (word, n) within one edit, each once."""
    size = F.char_length("word")

    def keyed(role: str, length: Column, prefix: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(k).alias("kind"), key.alias("key"))
                         for k, key in enumerate(chunk_keys(F.col("word"), length))])
        x = words.select(F.col("word").alias(prefix), F.col("n").alias(prefix + "n"), length.cast("int").alias("_l"),
                         F.explode(keys).alias("_x"))
        return x.select(prefix, prefix + "n", "_l", F.col("_x.kind").alias("_kind"), F.col("_x.key").alias("_key"))

    chunks = keyed("chunks", size, "u")
    grams = keyed("grams", size, "v").unionByName(keyed("grams", size - 1, "v"))
    joined = chunks.join(grams, ["_l", "_kind", "_key"])
    ordered = (F.char_length("v") > F.col("_l")) | (F.col("u") < F.col("v"))
    one = F.levenshtein("u", "v", 1) == 1
    return joined.filter(ordered & one).select("u", "un", "v", "vn").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: ``forms`` (word, form) followed to the end, by doubling; counts grow along it, so it ends."""
    spark = forms.sparkSession
    at = keep(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_far"))
        new = keep(spark, at.join(ahead, "root", "left").select(
            "word", F.coalesce("_far", "root").alias("root"), F.col("_far").isNotNull().alias("_moved")), "roots")
        if new.filter("_moved").limit(1).count() == 0:
            return new.select("word", "root")
        at = new.select("word", "root")


def variants(docs: DataFrame, cfg: SpellingConfig = SpellingConfig()) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    spark = docs.sparkSession
    words = keep(spark, word_counts(docs, cfg), "words")
    pairs = keep(spark, near_pairs(words), "near")
    both = pairs.select(F.col("u").alias("word"), F.col("v").alias("o"), F.col("vn").alias("on")).unionByName(
        pairs.select(F.col("v").alias("word"), F.col("u").alias("o"), F.col("un").alias("on")))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("on")).alias("m"), F.col("o").alias("o"))).alias("b"))
    found = words.join(near, "word", "left").withColumn("_is", -F.col("b.m") >= cfg.ratio * F.col("n"))
    found = keep(spark, found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("_is"), F.col("b.o")).alias("form"), F.when(F.col("_is"), -F.col("b.m")).alias("form_n")), "forms")
    r = roots(found.filter("form is not null"))
    return found.join(r, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("form_n").cast("long").alias("form_n"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


#: DuckDB: crc32 by its table over the UTF-8 bytes; near words share a word with one code point left out
SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                          lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END) AS c
    FROM range(256) r(i))),
found AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents)),
per_doc AS (SELECT doc_id, run, count(*) AS k FROM found WHERE length(run) >= 6 GROUP BY 1, 2),
bytes AS (
  SELECT doc_id, run, k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM per_doc),
hashed AS (
  SELECT run, k, xor(4294967295::UBIGINT, list_reduce(
      list_concat([4294967295::UBIGINT], list_transform(range(1, length(x)::BIGINT, 2),
        lambda i: ((instr('0123456789ABCDEF', x[i]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 1]) - 1)::UBIGINT)),
      lambda a, b: xor(a // 256, t[(xor(a, b) % 256 + 1)::BIGINT]))) AS h
  FROM bytes, crc_table),
dropped AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT)
              ELSE run END AS word, k FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM dropped WHERE length(word) >= 6 GROUP BY 1 HAVING sum(k) >= 5),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS c
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT * FROM (
    SELECT a.word, a.n, b.word AS o, b.n AS om FROM cut a JOIN cut b ON a.c = b.c AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.c = b.word
    UNION ALL SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.c = b.word)),
best AS (SELECT word, count(*) OVER (PARTITION BY word) AS n_near, o, om FROM near
         QUALIFY row_number() OVER (PARTITION BY word ORDER BY om DESC, o) = 1),
form AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN om >= 5 * w.n THEN o END AS form,
                CASE WHEN om >= 5 * w.n THEN om END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (SELECT word, word AS root, 0 AS step FROM words
         UNION ALL SELECT w.word, f.form, step + 1 FROM walk w JOIN form f ON f.word = w.root WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, step) AS root FROM walk GROUP BY 1)
SELECT f.word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM form f JOIN last l ON l.word = f.word
"""
