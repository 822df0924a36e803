"""Operator 4: exact substring dedup by suffix arrays.

Every byte is removed that a ``window``-byte string covers which also starts in a document with a smaller doc_id.

1. Documents are cut into shards of about ``shard_bytes`` (written once; a row is a shard).
2. A window's anchor is the smallest hash among its ``gram``-byte strings, so equal windows have equal anchors.
   Each shard sends its distinct anchors (a few per cent of its positions) to the bucket of their hash, which answers
   which of them occur in several documents. All other windows are unique: this rules them out without loss.
3. Windows with a shared anchor go, as strings (runs of windows with one anchor), to the bucket of that anchor.
   Equal strings of a shard are sent once, with their smallest doc_id. An anchor with more than ``hot`` different
   strings in the corpus (a passage with many different surroundings) has its windows sent one by one instead,
   dealt by their own hash: no bucket gathers a hot passage's surroundings.
4. A bucket builds suffix arrays of blocks of its strings (Larsson-Sadakane refinement), finds equal windows by
   Kasai's common prefixes, and merges the blocks' sorted windows by binary search; so every window gets the
   smallest doc_id that it starts in. The answer for a string is one bit for each of its windows.
5. Shards apply the bits.

Bytes are compared as they are; hashes only deal out work. Defined results: NULL or empty text has 0 bytes, none
removed; a NULL doc_id counts as larger than any other; rows of one doc_id do not remove each other's bytes; repeated
rows are judged alike, row by row; other columns are not read; an empty table gives an empty result; a text longer
than a shard is a shard of its own.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, keep, mix64, shuffle_partitions, table

#: stands for a NULL doc_id, larger than any
LAST = np.iinfo(np.int64).max
#: positions hashed at a time
PIECE = 1 << 15


@dataclass(frozen=True)
class SubstringConfig:
    window: int = 50
    gram: int = 24                 # window - gram + 1 is at most 32, the bits of an answer
    shard_bytes: int = 4 << 20
    bucket_bytes: int = 6 << 20    # input bytes for each bucket, about
    block_bytes: int = 4 << 20     # string bytes of one suffix array
    hot: int = 20_000


def squeeze(a: np.ndarray) -> bytes:
    """A compressed array; byte planes of the differences, so sorted numbers take little."""
    d = np.diff(a.astype(np.uint64), prepend=np.uint64(0))
    raw = d.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(a).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def unsqueeze(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(b[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def squeeze_bytes(b: bytes) -> bytes:
    return len(b).to_bytes(8, "little") + (pa.compress(b, "zstd", asbytes=True) if b else b"")


def unsqueeze_bytes(b: bytes) -> bytes:
    n = int.from_bytes(b[:8], "little")
    return pa.decompress(b[8:], n, "zstd", asbytes=True) if n else b""


def words(data: np.ndarray, order: str = "<") -> np.ndarray:
    """The 8 bytes from each position as a number, and from the end; zeros follow the last byte."""
    pad = np.zeros(len(data) + 8, np.uint8)
    pad[:len(data)] = data
    return np.ndarray((len(data) + 1,), f"{order}u8", pad, strides=(1,)).astype(np.uint64)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each position, by words of 8 bytes; the last may overlap the one before."""
    n, r, word = max(len(data) - k + 1, 0), 0x9E3779B97F4A7C15, words(data)
    if k < 8:
        return mix64(word[:n] & np.uint64((1 << 8 * k) - 1))
    out = np.zeros(n, np.uint64)
    for a in [*range(0, k - 7, 8), *[k - 8] * (k % 8 > 0)]:
        out *= np.uint64(r)
        out += word[a:a + n]
    return mix64(out)


def anchors_of(data: np.ndarray, cfg: SubstringConfig) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the gram from each position and anchor of the window from each, in pieces that stay in the cache."""
    n = len(data) - cfg.window + 1
    grams, anchor = np.empty(len(data) - cfg.gram + 1, np.uint64), np.empty(n, np.uint64)
    for a in range(0, n, PIECE):
        b = min(a + PIECE, n)
        h = gram_hashes(data[a:b + cfg.window - 1], cfg.gram)
        grams[a:a + len(h)] = h
        anchor[a:b] = sliding_min(h, cfg.window - cfg.gram + 1) >> np.uint64(16)
    return grams, anchor


def spread(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def distinct_sorted(a: np.ndarray) -> np.ndarray:
    """By sorting, which is faster here than the hash table of ``np.unique``."""
    a = np.sort(a)
    return a[np.append(True, a[1:] != a[:-1])[:len(a)]]


def by_value(b: np.ndarray) -> list[np.ndarray]:
    """The places of each value of small numbers, in ascending order of both."""
    if not len(b):
        return []
    order = np.argsort(b.astype(np.uint16) if b.max() < 1 << 16 else b, kind="stable")  # short ones by radix
    return np.split(order, np.flatnonzero(np.diff(b[order])) + 1)


def distinct(texts: dict[bytes, int], raw: bytes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Places in ``texts`` of the strings of ``raw``; new strings are added."""
    return np.array([texts.setdefault(raw[a:b], len(texts)) for a, b in zip(start.tolist(), stop.tolist())], np.int64)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while 2 * span <= w:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[:len(h) - (w - span)], h[w - span:]) if w > span else h


class Shard:
    """A shard's documents, and its units: runs of up to 32 windows of a document with one anchor."""

    def __init__(self, row: dict, cfg: SubstringConfig, counts: bool = True):
        """``counts``: also in how many documents and in what variety each anchor occurs (``multi``, ``kinds``)."""
        self.id = row["shard"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.lens = np.frombuffer(row["lens"], np.int64)
        self.bytes = unsqueeze_bytes(row["data"])
        data = np.frombuffer(self.bytes, np.uint8)
        w = cfg.window
        self.start = np.cumsum(self.lens) - self.lens
        empty = np.zeros(0, np.int64)
        self.at = self.n = self.doc = self.key_at = empty
        self.keys, self.kinds = np.zeros(0, np.uint64), empty
        self.multi = np.zeros(0, bool)
        if len(data) < w:
            return
        grams, anchor = anchors_of(data, cfg)
        some = self.lens >= w
        end = self.start + np.where(some, self.lens - w + 1, 0)  # where the windows of a document end
        at = distinct_sorted(np.concatenate(
            (np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, self.start[some], end[some])))
        n = np.diff(at, append=len(anchor))
        # a document shorter than a window may share its start with the next one
        own = at < end[np.searchsorted(self.start, at, side="right") - 1]
        at, n = at[own], n[own]
        parts = -(-n // 32)
        if len(parts) and parts.max() > 1:
            k = spread(parts)
            left = np.repeat(n, parts) - 32 * k
            at, n = np.repeat(at, parts) + 32 * k, np.minimum(left, 32)
        self.at, self.n = at, n
        self.doc = np.searchsorted(self.start, at, side="right") - 1
        self.keys, self.key_at = np.unique(anchor[at], return_inverse=True)
        if not counts or not len(at):
            return
        # in how many documents, and with how many different units, an anchor occurs here
        pair = distinct_sorted(self.key_at * len(self.ids) + self.doc)
        self.multi = np.bincount(pair // len(self.ids), minlength=len(self.keys)) > 1
        shape = mix64(grams[at] ^ mix64(grams[at + n - 1 + w - cfg.gram] + n.astype(np.uint64)))
        bits = 64 - len(self.keys).bit_length()
        kind = distinct_sorted(self.key_at.astype(np.uint64) << np.uint64(bits) | shape >> np.uint64(64 - bits))
        self.kinds = np.bincount((kind >> np.uint64(bits)).astype(np.int64), minlength=len(self.keys))

    def by_bucket(self, buckets: int):
        """(bucket, places of its keys) of the shard's sorted keys."""
        b = (mix64(self.keys) % np.uint64(buckets)).astype(np.int64)
        return [(int(b[g[0]]), g) for g in by_value(b)]

    def strings(self, answers: dict[int, bytes], buckets: int, cfg: SubstringConfig):
        """(bucket, strings to compare, smallest doc_id of each, who uses them) of the shard.

        Users are every unit or single window: string's place, first window, windows, document.
        """
        shared, hot = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        bucket_of = np.zeros(len(self.keys), np.int64)
        for bucket, g in self.by_bucket(buckets):
            bits = np.unpackbits(np.frombuffer(answers[bucket], np.uint8))[: 2 * len(g)].astype(bool)
            shared[g], hot[g], bucket_of[g] = bits[:len(g)], bits[len(g):], bucket
        w, use = cfg.window, shared[self.key_at]
        boil = use & hot[self.key_at]
        use &= ~boil
        bucket, a, n, doc = bucket_of[self.key_at[use]], self.at[use], self.n[use], self.doc[use]
        if boil.any():
            times = self.n[boil]
            alone = np.repeat(self.at[boil], times) + spread(times)
            data = np.frombuffer(self.bytes, np.uint8)
            dealt = np.concatenate([gram_hashes(np.lib.stride_tricks.sliding_window_view(data, w)[p].ravel(), w)[::w]
                                    for p in np.array_split(alone, -(-len(alone) // PIECE))]) % np.uint64(buckets)
            bucket, a = np.append(bucket, dealt.astype(np.int64)), np.append(a, alone)
            n, doc = np.append(n, np.ones(len(alone), np.int64)), np.append(doc, np.repeat(self.doc[boil], times))
        for g in by_value(bucket):
            texts: dict[bytes, int] = {}
            place = distinct(texts, self.bytes, a[g], a[g] + n[g] + (w - 1))
            least = np.full(len(texts), LAST)
            np.minimum.at(least, place, self.ids[doc[g]])
            yield int(bucket[g[0]]), texts, least, (place, a[g], n[g], doc[g])


def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes in order, by Larsson-Sadakane refinement.

    Ranks by the first 8 bytes are refined by the rank of a later suffix, doubling the sorted depth; only the
    groups of several suffixes are sorted again. (Kasai's walk needs the full order, not one to a window's depth.)
    """
    n = len(data)
    key = words(data, ">")[:n]
    sa = np.argsort(key)  # ties are one group, whatever their order
    key = key[sa]
    rank = np.zeros(n + 1, np.int64)
    place, h = np.arange(n), 8

    def regroup(key: np.ndarray) -> np.ndarray:
        """Ranks the suffixes at the places by their sorted keys; the places in groups of two or more."""
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        rank[sa[place]] = np.maximum.accumulate(np.where(new, place, 0))
        return place[~(new & np.append(new[1:], True))]

    place = regroup(key)
    while len(place):
        s = sa[place]
        then = s + h
        # past the end, the shorter suffix comes first (their zeros there are no bytes)
        both = (rank[s] << 32) | np.where(then < n, rank[np.minimum(then, n)] + h, n + h - 1 - then)
        order = np.argsort(both)
        sa[place] = s[order]
        place = regroup(both[order])
        h *= 2
    return sa


def kasai(data: np.ndarray, sa: np.ndarray, cap: int, lanes: int = 4096) -> np.ndarray:
    """Common prefix with the suffix before, for each place of the suffix array, up to ``cap``.

    Kasai's walk over the text keeps the last length less one; here many stretches of the text walk side by side,
    by up to 8 bytes a step. ``sa`` may hold some of the suffixes only, in their order: the length is then kept
    where both suffixes without their first byte are among them.
    """
    n = len(data)
    word = words(np.concatenate((data, np.zeros(cap + 8, np.uint8))))
    before, inside = np.full(n, n, np.int64), np.zeros(n + 2, bool)  # n: none
    before[sa[1:]] = sa[:-1]
    inside[sa] = True
    at = np.flatnonzero(inside)
    prev = before[at]
    most = np.minimum(n - np.maximum(at, prev), cap)
    holds = np.zeros(len(at) + 1, bool)
    holds[1:-1] = (at[1:] == at[:-1] + 1) & inside[prev[:-1] + 1]
    out = np.zeros(n, np.int64)
    width = max(-(-len(at) // lanes), 1)
    i = np.arange(0, len(at), width)
    stop = np.minimum(i + width, len(at))
    h = np.zeros(len(i), np.int64)
    while len(i):
        differ = word[at[i] + h] ^ word[prev[i] + h]
        h = np.minimum(h + (np.bitwise_count((differ & -differ) - np.uint64(1)) >> 3), most[i])  # 8 if all are equal
        done = (differ != 0) | (h == most[i])
        out[at[i[done]]] = h[done]
        i = i + done
        h = np.where(done, np.maximum(h - 1, 0) * holds[i], h)
        on = i < stop
        if not on.all():
            i, stop, h = i[on], stop[on], h[on]
    return out[sa]


def block_windows(texts: list[bytes], least: np.ndarray, w: int, alone: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows of a block (sorted), smallest doc_id of each, and each window's place, in text order."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    lens = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(lens) - lens
    n = lens - w + 1
    at = np.repeat(start, n) + spread(n)
    sa, whole = suffix_array(data), np.zeros(len(data), bool)
    whole[at] = True
    sa = sa[whole[sa]]  # suffixes that start with a window
    cls = np.empty(len(data), np.int64)
    cls[sa] = np.cumsum(kasai(data, sa, w) < w) - 1  # those with w bytes in common are one class, in sorted order
    place = cls[at]
    small = np.full(int(cls[sa[-1]]) + 1, LAST)
    np.minimum.at(small, place, np.repeat(least, n))
    if alone:  # no other block to merge with
        return np.zeros(0, f"S{w}"), small, place
    one = np.empty(len(small), np.int64)
    one[place] = at
    rows = np.lib.stride_tricks.sliding_window_view(data, w)[one]
    return np.ascontiguousarray(rows).view(f"S{w}").ravel(), small, place


def smallest_docs(texts: list[bytes], least: np.ndarray, cfg: SubstringConfig) -> np.ndarray:
    """The smallest doc_id of each window of the texts, one text after the other.

    Blocks have suffix arrays of their own; their sorted windows are merged by binary search. (Fixed-width byte
    strings compare exactly: trailing zero bytes count as padding of the same width.)
    """
    w = cfg.window
    size = np.cumsum([len(t) for t in texts])
    cuts = np.searchsorted(size, np.arange(cfg.block_bytes, size[-1] + cfg.block_bytes, cfg.block_bytes), "left") + 1
    blocks, a = [], 0
    for b in np.unique(np.minimum(cuts, len(texts))).tolist():
        if b > a:
            blocks.append(block_windows(texts[a:b], least[a:b], w, not a and b == len(texts)))
            a = b
    if len(blocks) == 1:
        return blocks[0][1][blocks[0][2]]
    merged, small = blocks[0][0], blocks[0][1].copy()
    for keys, low, _ in blocks[1:]:
        at = np.searchsorted(merged, keys)
        hit = merged[np.minimum(at, len(merged) - 1)] == keys
        small[at[hit]] = np.minimum(small[at[hit]], low[hit])
        merged, small = np.insert(merged, at[~hit], keys[~hit]), np.insert(small, at[~hit], low[~hit])
    return np.concatenate([small[np.searchsorted(merged, keys)][place] for keys, _, place in blocks])


def shards(docs: DataFrame, cfg: SubstringConfig = SubstringConfig()) -> DataFrame:
    """Rows (shard, n_bytes, ids, lens, data) of about ``shard_bytes`` of documents each."""
    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row():
            data = b"".join(texts)
            return pa.RecordBatch.from_arrays([
                pa.array([part << 32 | count], pa.int64()), pa.array([len(data)], pa.int64()),
                pa.array([np.array([LAST if i is None else i for i in ids], np.int64).tobytes()], pa.binary()),
                pa.array([np.array([len(t) for t in texts], np.int64).tobytes()], pa.binary()),
                pa.array([squeeze_bytes(data)], pa.binary())], names=["shard", "n_bytes", "ids", "lens", "data"])

        for b in chunks(batches):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                t = t or b""
                if texts and size + len(t) > cfg.shard_bytes:
                    yield row()
                    ids, texts, size, count = [], [], 0, count + 1
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield row()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "shard long, n_bytes long, ids binary, lens binary, data binary")


def _rows(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def dedup(docs: DataFrame, cfg: SubstringConfig = SubstringConfig()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    spark = docs.sparkSession
    cut = keep(spark, shards(docs, cfg), "shards")
    total = cut.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(shuffle_partitions(spark), int(total // cfg.bucket_bytes))
    binary = pa.binary()

    def anchors(batches):
        for r in _rows(batches):
            s = Shard(r, cfg)
            out = [(b, s.id, squeeze(s.keys[g]), squeeze_bytes(np.concatenate(
                (s.multi[g].astype(np.uint32), s.kinds[g].astype(np.uint32))).tobytes()))
                for b, g in s.by_bucket(buckets)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), binary, binary))],
                    names=["bucket", "shard", "keys", "info"])

    def shared(key, t):
        keys = [unsqueeze(x) for x in t.column("keys").to_pylist()]
        info = [np.frombuffer(unsqueeze_bytes(x), np.uint32).reshape(2, -1) for x in t.column("info").to_pylist()]
        all_, inv = np.unique(np.concatenate(keys), return_inverse=True)
        multi, kinds = np.concatenate(info, axis=1)
        many = (np.bincount(inv, minlength=len(all_)) > 1) | (np.bincount(inv, multi, minlength=len(all_)) > 0)
        hot = np.bincount(inv, kinds, minlength=len(all_)) > cfg.hot
        ends = np.cumsum([len(k) for k in keys])
        bits = [np.packbits(np.concatenate((many[i], hot[i]))).tobytes() for i in np.split(inv, ends[:-1])]
        return pa.table({"shard": t.column("shard"), "bucket": t.column("bucket"), "bits": pa.array(bits, binary)})

    def answered(answer: DataFrame, name: str) -> DataFrame:
        """Shards with their answers; a shard has one for each bucket that it asked, so the list is its own size."""
        a = answer.groupBy(F.col("shard").alias("_s")).agg(F.collect_list(F.struct(
            *[c for c in answer.columns if c != "shard"])).alias(name))
        return cut.join(a, cut.shard == a["_s"], "left").drop("_s")

    known = keep(spark, cut.mapInArrow(anchors, "bucket long, shard long, keys binary, info binary")
                 .groupBy("bucket").applyInArrow(shared, "shard long, bucket long, bits binary"), "anchors")
    def asked(r: dict, s: Shard):
        return s.strings({x["bucket"]: x["bits"] for x in r["known"] or []}, buckets, cfg)

    def strings(batches):
        for r in _rows(batches):
            out = []
            s = Shard(r, cfg, counts=False)
            for b, texts, least, (place, a, n, doc) in asked(r, s):
                whole = least[place] < s.ids[doc]  # the shard itself has the string in a smaller document
                out.append((b, s.id, squeeze_bytes(b"".join(texts)),
                            squeeze_bytes(np.array([len(x) for x in texts], np.uint16).tobytes()),
                            squeeze_bytes(least.tobytes()),
                            squeeze_bytes(np.concatenate((place, np.diff(a, prepend=0), 2 * n + whole))
                                          .astype(np.int32).tobytes())))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), *[binary] * 4))],
                    names=["bucket", "shard", "texts", "lens", "least", "users"])

    def judged(key, t):
        texts, places, lows = {}, [], []
        for x, n, low in zip(t.column("texts"), t.column("lens"), t.column("least")):
            n = np.frombuffer(unsqueeze_bytes(n.as_py()), np.uint16).astype(np.int64)
            ends = np.cumsum(n)
            places.append(distinct(texts, unsqueeze_bytes(x.as_py()), ends - n, ends))
            lows.append(np.frombuffer(unsqueeze_bytes(low.as_py()), np.int64))
        own, low = np.concatenate(places), np.concatenate(lows)
        least = np.full(len(texts), LAST)
        np.minimum.at(least, own, low)
        small = np.append(smallest_docs(list(texts), least, cfg), np.full(32, LAST))
        count = np.array([len(x) - cfg.window + 1 for x in texts], np.int64)
        at, n = (np.cumsum(count) - count)[own], count[own]
        mask = np.zeros(len(own), np.uint32)
        for j in range(int(n.max())):
            mask |= ((j < n) & (small[at + j] < low)).astype(np.uint32) << np.uint32(j)
        bits = [squeeze_bytes(x.tobytes()) for x in np.split(mask, np.cumsum([len(x) for x in places])[:-1])]
        return pa.table({"shard": t.column("shard"), "users": t.column("users"), "bits": pa.array(bits, binary)})

    verdict = keep(spark, answered(known, "known").mapInArrow(
        strings, "bucket long, shard long, texts binary, lens binary, least binary, users binary")
        .groupBy("bucket").applyInArrow(judged, "shard long, users binary, bits binary"), "verdict")

    def applied(batches):
        for r in _rows(batches):
            raw = unsqueeze_bytes(r["data"])
            ids, lens = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["lens"], np.int64)
            first = np.zeros(len(raw) + 1, bool)  # of a removed window
            for x in r["answers"] or []:
                place, a, n = np.frombuffer(unsqueeze_bytes(x["users"]), np.int32).reshape(3, -1).astype(np.int64)
                mask = np.frombuffer(unsqueeze_bytes(x["bits"]), "<u4")[place]
                mask = np.where(n & 1, (1 << (n >> 1)) - 1, mask).astype("<u4")
                user, j = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little"))
                first[np.cumsum(a)[user] + j] = True
            first = np.flatnonzero(first)
            edge = np.zeros(len(raw) + 1, np.int8)  # of runs of windows that overlap or touch
            far = np.diff(first) > cfg.window
            if len(first):
                edge[first[np.append(True, far)]] = 1
                edge[first[np.append(far, True)] + cfg.window] = -1
            gone = np.cumsum(edge[:-1], dtype=np.int8) > 0
            data = np.frombuffer(raw, np.uint8)
            out = []
            for i, a, n in zip(ids.tolist(), (np.cumsum(lens) - lens).tolist(), lens.tolist()):
                g = gone[a:a + n]
                removed = int(g.sum())
                spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if removed else 0
                kept = data[a:a + n][~g] if removed else data[a:a + n]
                out.append((None if i == LAST else i, n, removed, spans, hashlib.sha256(kept.tobytes()).hexdigest()))
            kinds = (pa.int64(),) * 4 + (pa.string(),)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return answered(verdict, "answers").mapInArrow(applied, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
