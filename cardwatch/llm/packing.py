"""Operator 6: best-fit packing with certified bin counts.

Texts become token ids; each document ends with id 0; documents longer than a sequence are cut into whole sequences
and a last piece. Pieces are packed by best-fit decreasing, partition by partition. Dual-feasible functions turn a
partition's piece lengths into a lower bound on its number of sequences. A partition that reaches its bound is
certified and done; one with a gap keeps its full sequences, and the pieces of the others are exchanged with those
of the other partitions with gaps (dealt anew into fewer partitions) and packed again by best-fit decreasing.

Defined results: NULL text is an empty text, which is one piece of length 1 (id 0); repeated rows are packed as
pieces of their own; ties between lengths go by doc_id and piece; NULL doc_id is packed like any other; extra columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, column, keep, table, worker_cache

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


@dataclass(frozen=True)
class PackConfig:
    size: int = 2048
    tokenizer: str = "word_bpe_49k.json"   # a file of the public tokenizers, or a path
    end_id: int = 0
    cache_words: int = 1_200_000           # words whose ids a worker remembers, and as many units
    group: int = 40_000                    # pieces packed together, about
    rounds: int = 3                        # exchanges between partitions with gaps


class WordIds:
    """Ids of whole texts, word by word: for plain Latin text the tokenizer's words never cross white space.

    A word's ids are remembered, and so are those of its units (runs of letters, digits, runs of marks), which the
    tokenizer cuts first: ``tree``, ``tree,`` and ``(tree`` share one. Units not met before go through the
    tokenizer in one call; each ends with an id that closes a unit. Both memories have two generations: when the
    young one is full it becomes the old one, and what is met again moves back, so frequent words are never lost.
    Other texts go through the tokenizer whole.
    """

    #: characters for which lower-casing and normal form work letter by letter and white space is space, \\t, \\n, \\r
    _PLAIN = bytes(i for i in range(256) if 32 <= i < 127 or i in (9, 10, 13) or i > 160)
    #: the tokenizer's own units, on such text
    _UNIT = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_\xb2\xb3\xb9\xbc\xbd\xbe]+|[0-9\xb2\xb3\xb9\xbc\xbd\xbe]|(?:[^\w\s]|_)+"

    def __init__(self, path: str, cache_words: int):
        import re

        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        closing = [t.endswith("</w>") for t, _ in sorted(self.tok.get_vocab().items(), key=lambda x: x[1])]
        self.closes = np.array(closing)
        self.unit = re.compile(self._UNIT)
        self.words: tuple[dict, dict] = ({}, {})
        self.units: tuple[dict, dict] = ({}, {})
        self.most = cache_words

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _fill(self, known: tuple[dict, dict], wanted: set, find) -> tuple[dict, dict]:
        """``known`` with everything ``wanted`` in its young generation; ``find`` gives the bytes of new ones."""
        young, old = known
        missing = [w for w in wanted if w not in young]
        if len(young) + len(missing) > self.most // 2:
            young, old = {}, young
            missing = list(wanted)
        new = []
        for w in missing:
            if w in old:
                young[w] = old[w]
            else:
                new.append(w)
        young.update(zip(new, find(new)))
        return young, old

    def _new_units(self, units: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(units), 8192):
            part = units[at:at + 8192]
            ids = np.array(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
            if len(ends) != len(part):  # not one closing id a unit: one by one
                out += [self.whole(u) for u in part]
                continue
            raw, a = ids.tobytes(), 0
            for b in ends.tolist():
                out.append(raw[a:b])
                a = b
        return out

    def _new_words(self, words: list[str]) -> list[bytes]:
        mixed = {w: self.unit.findall(w) for w in words if not w.isalpha()}
        self.units = self._fill(self.units, set(words).difference(mixed).union(*mixed.values()), self._new_units)
        get = self.units[0].__getitem__
        return [b"".join(map(get, mixed[w])) if w in mixed else get(w) for w in words]

    def __call__(self, texts: list[str]) -> list[bytes]:
        split: list[list[str] | None] = []
        for t in texts:
            try:
                plain = not t.encode("latin-1").translate(None, self._PLAIN) and "<|" not in t
            except UnicodeEncodeError:
                plain = False
            split.append(t.lower().split() if plain else None)
        self.words = self._fill(self.words, set().union(*[ws for ws in split if ws]), self._new_words)
        get = self.words[0].__getitem__
        return [self.whole(t) if ws is None else b"".join(map(get, ws)) for t, ws in zip(texts, split)]


def tokenizer_path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(docs: DataFrame, cfg: PackConfig = PackConfig()) -> DataFrame:
    """The pieces of every document, with the crc of their ids."""
    def run(batches):
        import gc
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache = worker_cache("word-ids")
        if cfg.tokenizer not in cache:
            cache[cfg.tokenizer] = WordIds(tokenizer_path(cfg.tokenizer), cfg.cache_words)
        ids_of, end, wide = cache[cfg.tokenizer], np.array([cfg.end_id], "<u4").tobytes(), 4 * cfg.size
        gc.disable()  # the memories hold strings and bytes only: nothing for the collector to find
        for b in chunks(batches):
            out: list[tuple] = []
            for doc, ids in zip(b.column(0).to_pylist(), ids_of(column(b, 1)), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), wide)):
                    part = ids[at:at + wide]
                    out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = zip(*out)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Sequences needed at least: the largest bound of two families of dual-feasible functions.

    - U_e: above size - e counts as a whole sequence, below e as nothing, else as itself (every length e);
    - u_k: multiples of size / (k + 1) as themselves, others rounded down to multiples of size / k.
    """
    if not len(lengths):
        return 0
    n = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    count, mass = np.cumsum(n), np.cumsum(n * np.arange(size + 1))
    best = -(-int(mass[size]) // size)
    e = np.arange(0, size // 2 + 1)
    large = count[size] - count[size - e]
    middle = mass[size - e] - np.where(e > 0, mass[np.maximum(e - 1, 0)], 0)
    best = max(best, int((large + -(-middle // size)).max()))
    at = np.arange(size + 1)
    for k in range(1, 101):
        whole = (k + 1) * at % size == 0
        value = np.where(whole, k * at, ((k + 1) * at // size) * size)  # times k * size
        best = max(best, -(-int((n * value).sum()) // (k * size)))
    return best


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Bin of each length (given in decreasing order), by best fit; number of bins.

    A bit set of the free sizes finds the tightest open bin.
    """
    bins = np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(size + 1)]
    open_, used = 0, 0
    for i, n in enumerate(lengths.tolist()):
        fits = open_ >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                open_ ^= 1 << room
        else:
            room, b = size, used
            used += 1
        bins[i] = b
        left = room - n
        if left:
            if not free[left]:
                open_ |= 1 << left
            free[left].append(b)
    return bins, used


def _pack_round(rows: DataFrame, size: int, groups: int, tag: int, last: bool) -> DataFrame:
    """Deal rows into groups, pack each; rows of sequences that stay get a sequence_id and offset, others NULL."""
    def run(key, t):
        n, doc, piece = (t.column(c).to_numpy(zero_copy_only=False) for c in ("length", "doc_id", "piece"))
        order = np.lexsort((piece, np.nan_to_num(doc.astype(float)), -n))
        n = n[order]
        bins, used = best_fit(n, size)
        fill = np.bincount(bins, n, minlength=used).astype(np.int64)
        stays = np.ones(used, bool) if last or used == lower_bound(n, size) else fill == size
        by = np.argsort(bins, kind="stable")
        before = np.cumsum(n[by]) - n[by]
        first = np.searchsorted(bins[by], np.arange(used))
        offset = np.empty(len(n), np.int64)
        offset[by] = before - before[first][bins[by]]
        seq = (np.int64(tag) << 58) + (np.int64(key[0].as_py()) << 26) + bins
        gone = ~stays[bins]
        out = t.take(pa.array(order)).drop_columns(["_g"])
        return out.append_column("sequence_id", pa.array(seq, mask=gone)).append_column(
            "offset", pa.array(offset, mask=gone))

    g = F.pmod(F.xxhash64(F.lit(tag), "doc_id", "piece", "ids_crc32"), F.lit(groups))
    return rows.withColumn("_g", g).groupBy("_g").applyInArrow(run, PLACED)


def pack(docs: DataFrame, cfg: PackConfig = PackConfig()) -> DataFrame:
    """Every piece with its sequence and place."""
    spark = docs.sparkSession
    found = keep(spark, pieces(docs, cfg), "pieces")
    whole = F.col("length") == cfg.size
    # a full piece is a sequence of its own: its number follows from its place in the table
    done = found.filter(whole).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn(
        "offset", F.lit(0).cast("long"))
    rest = found.filter(~whole)
    parts = []
    for tag in range(cfg.rounds + 1):
        groups = max(1, -(-rest.count() // cfg.group))
        last = tag == cfg.rounds or groups == 1
        got = keep(spark, _pack_round(rest, cfg.size, groups, tag, last), "packed")
        parts.append(got.filter("sequence_id is not null"))
        rest = got.filter("sequence_id is null").drop("sequence_id", "offset")
        if last:
            break
    for p in parts:
        done = done.unionByName(p)
    return done


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
