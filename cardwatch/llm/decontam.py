"""Operator 1: benchmark decontamination by CGK embedding and bit-sampling LSH, with exact edit verification.

Words are compared. The CGK random walk embeds a sequence of n words: at each of 2n steps it writes the current
word and moves on, or stays, by a random bit of (step, word). Near sequences by edit distance become near
ones by Hamming distance, so sampled places that agree make a hash key. Each table has its own walk and sample; their
number is taken, for each item size, from the measured agreement of walks over pairs at exactly the edit limit, so
that ``recall`` of them share a key. Walks of longer items agree less: keys get fewer places there. Windows of an item's size whose key equals
the item's in some table are candidates; the edit distance, computed exactly, decides (``similarity`` of the words).

Windows are formed at every start where a match is possible: an item within k edits of a window, cut into k + 1
runs of words, has one of them unharmed there, at most k words from its place. This rules out starts without loss.

Defined results: one row for each (document, item) match, its best window (fewest edits, then first). NULL or wordless
texts and items match nothing; items under ``1 / (1 - similarity)`` words match only exactly; equal items match
alike; repeated rows of a document give one row; rows with NULL ids are not matched; other columns are not read; an
empty table gives an empty result. The benchmark is broadcast in blocks of ``block_chars`` characters.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, column, mix64, table, words_of

#: cells (table, row, word) that one step of the embedding holds
EMBED_CELLS = 4_000_000
RESULT = "doc_id long, item_id long, edits int, similarity double, start_word int"


@dataclass(frozen=True)
class DecontamConfig:
    similarity: float = 0.8
    recall: float = 0.995          # of windows at the similarity threshold, per window
    sampled: int = 3               # places in a key at most; fewer if that takes over
    many_tables: int = 64          # tables; one place takes as many tables as it needs
    block_chars: int = 8_000_000   # benchmark text that is broadcast at a time
    seed: int = 20

    def tables(self, n: int) -> tuple[int, int]:
        """Number of tables and places in a key for items of n words."""
        if n > 64:  # one measurement serves the sizes up to a quarter longer; the longer walk agrees less
            n = math.ceil(64 * 1.25 ** math.ceil(math.log(n / 64, 1.25) - 1e-9))
        share = agreement(n, edits_allowed(n, self.similarity), self.seed)
        for places in range(self.sampled, 0, -1):
            q = (share ** places).mean(axis=1)  # chance of a key for each pair
            few, many = 0, 1
            while np.mean((1 - q) ** many) > 1 - self.recall:
                few, many = many, 2 * many
            while many - few > 1:
                t = (few + many) // 2
                few, many = (few, t) if np.mean((1 - q) ** t) <= 1 - self.recall else (t, many)
            if many <= self.many_tables or places == 1:
                return many, places


def edits_allowed(n: int, similarity: float) -> int:
    return int((1 - similarity) * n + 1e-9)


@lru_cache(maxsize=4096)
def agreement(n: int, k: int, seed: int, pairs: int = 256, walks: int = 32) -> np.ndarray:
    """Share of equal places [pair, walk] of the walks over n words and over the same after k random edits.

    An edit inserts, removes or changes a word, and the text goes on after the item, as in a window.
    """
    rng = np.random.default_rng([seed, n, k])
    a = rng.integers(1, 1 << 62, (pairs, n)).astype(np.uint64)
    b = np.empty_like(a)
    for i, row in enumerate(a.tolist()):
        at = np.sort(rng.choice(n, k, replace=False))[::-1].tolist()
        for place, kind, word in zip(at, rng.integers(0, 3, k).tolist(), rng.integers(1, 1 << 62, k).tolist()):
            row[place:place + (kind > 0)] = [word] * (kind < 2)
        b[i] = (row + rng.integers(1, 1 << 62, k).tolist())[:n]
    ends = np.zeros((pairs, 1), np.uint64)
    a, b = np.concatenate((a, ends), axis=1), np.concatenate((b, ends), axis=1)
    row = np.arange(pairs)[:, None]
    salt = rng.integers(1, 1 << 62, (2 * n, walks)).astype(np.uint64)
    at_a, at_b = np.zeros((pairs, walks), np.int64), np.zeros((pairs, walks), np.int64)
    same = np.zeros((pairs, walks))
    for step in salt:
        x, y = a[row, at_a], b[row, at_b]
        same += (x == y) & (x != 0)
        at_a = np.minimum(at_a + (mix64(x ^ step) & np.uint64(1)).astype(np.int64), n)
        at_b = np.minimum(at_b + (mix64(y ^ step) & np.uint64(1)).astype(np.int64), n)
    return same / (2 * n)


def embed(rows: np.ndarray, places: np.ndarray, ended: int) -> np.ndarray:
    """LSH keys [table, row] of word sequences (rows of one length) from the CGK walks of all tables.

    ``places[t]`` are the sampled steps of table t. The random bit of (table, step, word) is a bit of the word's hash
    under the table's salt, 64 steps from each hash. A walk past the end stays on an empty word; a key
    of such places alone says nothing and becomes ``ended``, which must differ between items and windows.
    """
    tables, n = len(places), rows.shape[1]
    if len(rows) > 1 and tables * len(rows) * (n + 1) > EMBED_CELLS:
        half = len(rows) // 2
        return np.concatenate((embed(rows[:half], places, ended), embed(rows[half:], places, ended)), axis=1)
    text = np.concatenate((rows, np.zeros((len(rows), 1), np.uint64)), axis=1)
    flat = text.ravel()
    base = (np.arange(len(rows)) * (n + 1))[None, :]
    salt = mix64(np.arange(1, 2 * tables * (2 * n // 64 + 1) + 1, dtype=np.uint64)).reshape(-1, tables)
    table_at = (np.arange(tables) * flat.size)[:, None]
    at = np.zeros((tables, len(rows)), np.int64)
    key = np.zeros((tables, len(rows)), np.uint64)
    past = np.ones((tables, len(rows)), bool)
    for step in range(int(places.max()) + 1):
        if step % 64 == 0:
            bits = mix64(flat[None, :] ^ salt[step // 64][:, None]).ravel()
        idx = base + at
        for t in np.flatnonzero((places == step).any(axis=1)):
            key[t] = mix64(key[t] * np.uint64(31) + flat[idx[t]])
            past[t] &= flat[idx[t]] == 0
        move = (bits[table_at + idx] >> np.uint64(step % 64)) & np.uint64(1)
        at = np.minimum(at + move.astype(np.int64), n)
    key[past] = ended
    return key


def edit_distance(items: np.ndarray, n: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits from items[i][:n[i]] to a beginning of texts[i], and that beginning's length (rows padded).

    Item padding is never read past n; text padding must differ from every word.
    """
    pairs, width = len(items), texts.shape[1]
    j = np.arange(width + 1)
    row = np.broadcast_to(j, (pairs, width + 1)).astype(np.int32)
    best, length = np.full(pairs, 1 << 30), np.zeros(pairs, np.int64)
    for i in range(1, int(n.max()) + 1):
        cost = (texts != items[:, i - 1:i]).astype(np.int32)
        new = np.empty_like(row)
        new[:, 0] = i
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + cost)
        row = np.minimum.accumulate(new - j, axis=1) + j
        ends = np.flatnonzero(n == i)
        if len(ends):
            length[ends] = row[ends].argmin(axis=1)
            best[ends] = row[ends].min(axis=1)
    return best, length


class Items:
    """A block of benchmark items: word hashes, the runs that seed windows, and the LSH keys of every table."""

    def __init__(self, ids: list[int], texts: list[str], cfg: DecontamConfig):
        self.cfg = cfg
        words, first = words_of(texts)
        n = np.diff(first)
        some = np.flatnonzero(n)
        self.ids, self.n = np.asarray(ids, np.int64)[some], n[some]
        self.k = np.array([edits_allowed(int(x), cfg.similarity) for x in self.n], np.int64)
        self.words = [words[first[i]:first[i + 1]] for i in some]
        seeds = defaultdict(list)  # run length -> (hash, size, offset, k)
        for w, x, k in zip(self.words, self.n.tolist(), self.k.tolist()):
            q = x // (k + 1)
            for p in range(k + 1):
                o = p * x // (k + 1)
                seeds[q].append((int(run_hash(w[o:o + q], q)[0]), x, o, k))
        self.seeds = {}
        for q, rows in seeds.items():
            a = np.array(sorted(set(rows)), dtype=object)
            self.seeds[q] = (a[:, 0].astype(np.uint64), a[:, 1:].astype(np.int64))
        # windows are embedded once for each distinct item size; keys are looked up among the items of that size
        rng = np.random.default_rng(cfg.seed)
        self.samples = {}
        for x in np.unique(self.n).tolist():  # a walk passes a sequence's end after 2n steps, on average
            tables, places = cfg.tables(x)
            self.samples[x] = np.stack([
                np.sort(rng.choice(2 * x, min(places, 2 * x), replace=False)) for _ in range(tables)])
        self.by_size = {}
        for x, places in self.samples.items():
            of = np.flatnonzero(self.n == x)
            keys = []
            for h in embed(np.stack([self.words[i] for i in of]), places, 1):
                order = np.argsort(h, kind="stable")
                keys.append((h[order], of[order]))
            self.by_size[x] = keys


def run_hash(words: np.ndarray, q: int) -> np.ndarray:
    """Hash of every run of q words."""
    if len(words) < q:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(words) - q + 1, np.uint64)
    for i in range(q):
        h = mix64(h * np.uint64(31) + words[i:len(words) - q + 1 + i])
    return h


def spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the ranges lo[i]..hi[i]-1 and the range each is of."""
    n = np.maximum(hi - lo, 0)
    of = np.repeat(np.arange(len(n)), n)
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), of


def windows(words: np.ndarray, first: np.ndarray, items: Items) -> dict[int, np.ndarray]:
    """For each item size the window starts at which an item of that size may match."""
    found = defaultdict(list)
    for q, (hashes, rows) in items.seeds.items():
        h = run_hash(words, q)
        low = np.zeros(1 << 20, bool)
        low[hashes & np.uint64(0xFFFFF)] = True
        at = np.flatnonzero(low[h & np.uint64(0xFFFFF)])
        lo, hi = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
        seed, of = spread(lo, hi)
        pos = at[of]
        size, offset, k = rows[seed].T if len(seed) else np.zeros((3, 0), np.int64)
        doc = np.searchsorted(first, pos, side="right") - 1
        start, of = spread(pos - offset - k, pos - offset + k + 1)
        ok = (start >= first[doc[of]]) & (start < first[doc[of] + 1])
        # a window reaches over its document's end by k words at most
        ok &= start + size[of] - k[of] <= first[doc[of] + 1]
        for x in np.unique(size[of[ok]]):
            found[int(x)].append(np.unique(start[ok][size[of[ok]] == x]))
    return {x: np.unique(np.concatenate(s)) for x, s in found.items()}


def matches(texts: list[str], items: Items) -> list[tuple[int, int, int, int]]:
    """(text, item, edits, start word) of every window that an item matches."""
    words, first = words_of(texts)
    if not len(words):
        return []
    out = []
    for size, start in windows(words, first, items).items():
        doc = np.searchsorted(first, start, side="right") - 1
        pairs = [np.zeros(0, np.int64)]
        for at in range(0, len(start), 1024):
            place = start[at:at + 1024, None] + np.arange(size)
            inside = place < first[doc[at:at + 1024] + 1][:, None]
            text = np.where(inside, words[np.minimum(place, len(words) - 1)], np.uint64(0))
            for h, (keys, of) in zip(embed(text, items.samples[size], 2), items.by_size[size]):
                w, hit = spread(np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right"))
                pairs.append((at + hit) * len(items.n) + of[w])
        pairs = np.unique(np.concatenate(pairs))
        k = int(items.k[items.n == size][0])
        for at in range(0, len(pairs), 4096):
            win, item = np.divmod(pairs[at:at + 4096], len(items.n))
            place = start[win][:, None] + np.arange(size + k)
            inside = place < first[doc[win] + 1][:, None]
            text = np.where(inside, words[np.minimum(place, len(words) - 1)], np.uint64(0))
            own = np.stack([items.words[i] for i in item])
            got, _ = edit_distance(own, np.full(len(item), size), text)
            ok = got <= k
            out += zip(doc[win][ok].tolist(), item[ok].tolist(), got[ok].tolist(),
                       (start - first[doc])[win][ok].tolist())
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, cfg: DecontamConfig = DecontamConfig()) -> DataFrame:
    """The best match of every (document, item) within the edit limit."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col("item_id").cast("long"), "text").filter("item_id is not null and text is not null")
    chars = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // cfg.block_chars))
    d = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null and text is not null")
    out = None
    for i in range(blocks):
        rows = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).orderBy("item_id").collect()
        items = Items([r[0] for r in rows], [r[1] for r in rows], cfg)
        # arrays only, no class of this package: executors need no copy of it
        shared = spark.sparkContext.broadcast({k: v for k, v in vars(items).items() if k != "cfg"})
        found = d.mapInArrow(_finder(shared), RESULT)
        out = found if out is None else out.unionByName(found)
    best = F.min(F.struct("edits", "start_word", "similarity")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.edits", "b.similarity", "b.start_word")


def _finder(shared):
    def run(batches):
        items = SimpleNamespace(**shared.value)
        for b in chunks(batches):
            best: dict = {}
            for doc, item, edits, start in matches(column(b, 1), items):
                best[doc, item] = min(best.get((doc, item), (edits, start)), (edits, start))
            ids = b.column(0).to_pylist()
            rows = [(ids[d], int(items.ids[i]), e, 1 - e / int(items.n[i]), s) for (d, i), (e, s) in best.items()]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "item_id", "edits", "similarity", "start_word"])

    return run


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
