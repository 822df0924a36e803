"""Operators 11 to 13: against DuckDB or brute force, and the defined results of edge cases."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from cardwatch.llm import mixing, phrases, queries, spelling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, phrase string, size int, copies string"
LONG = "lorem ipsum dolor sit. " * 3000   # more words in one piece are too much for the plain SQL
EDGES = [(1, None, "en", "a"), (2, "", None, "a"), (3, "   \n\t ", "en", None), (4, "one", "en", "b"),
         (5, "The same wording, twice over, in two rows.", "en", "a"), (5, "The same wording, twice over, in two rows.", "en", "a"),
         (6, LONG, None, "a"), (None, "no id here, wording", "de", None), (None, "no id here, wording", "de", None),
         (7, "x" * 700, "de", "b"), (8, "ÄÖ ß Ünï çà.\nпривет мир\n日本語 ÷×÷×÷×", "de", "b"), (9, "12345 !!! ###", "en", "b")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0, "clash", "clash", 1, "clash") for i, t, lang, s in rows], SCHEMA)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def in_duck(spark, df, sql, cols):
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    return sorted((tuple(r) for r in con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()), key=repr)


WORDS = ["word", "form", "root", "n", "n_near", "form_n"]
RANKS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


SECRETS = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example", "max_repos"]


@pytest.mark.parametrize("name,cols", [("op10_secrets", SECRETS), ("op12_spelling_variants", WORDS), ("op13_collocations", RANKS)])
def test_sql(spark, name, cols):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.QUERIES[name](spark, SF)
    assert tuples(got.select(*cols)) == in_duck(spark, docs, queries.SQL[name], cols)


# ---- 11

def brute_rate(sizes, target, most=2):
    """Rates closest to one copy in relative entropy, by bisection on the multiplier."""
    mean = sum(sizes) / len(sizes)
    lo, hi = -1e4, 1e4
    for _ in range(300):
        mid = (lo + hi) / 2
        t = sum(x * min(most, math.exp(min(mid * x / mean, 50))) for x in sizes)
        lo, hi = (mid, hi) if t < target else (lo, mid)
    return {x: min(most, math.exp(min(lo * x / mean, 50))) for x in sizes}


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    got, share = {}, 1.5 * sum(sizes.values())
    open_ = list(names)
    while True:
        w = sum(weight[s] for s in open_)
        above = [s for s in open_ if share * weight[s] / w > 2 * sizes[s]] if open_ else []
        if not above:
            got.update({s: share * weight[s] / w for s in open_})
            return got
        for s in above:
            got[s] = 2 * sizes[s]
            share -= got[s]
            open_.remove(s)


def check_mix(rows):
    """rows: (doc_id, source, size, source_size, target, rate, copies, taken)"""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    sizes = {s: sum(r[2] for r in x) for s, x in by.items()}
    want = brute_targets(sizes)
    for s, x in by.items():
        assert all(r[3] == sizes[s] for r in x)
        assert all(r[4] == pytest.approx(want[s], rel=1e-9) for r in x)
        assert all(r[7] == r[6] * r[2] and 0 <= r[7] <= 2 * r[2] for r in x)
        some = [r[2] for r in x if r[2]]
        if some and want[s] < 2 * sizes[s] * (1 - 1e-9):
            rate = brute_rate(some, want[s])
            assert all(r[5] == pytest.approx(rate[r[2]], abs=1e-6) for r in x if r[2])
        # the carried error ends below half of a short document, unless the last ones are full
        assert abs(sum(r[7] for r in x) - want[s]) <= max(min(some, default=0), 0.01 * want[s])


COLS = ["doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken"]


def test_mix_against_bisection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = tuples(mixing.takes(mixing.sized(docs)).select(*COLS))
    assert len(rows) == docs.count()
    check_mix(rows)
    assert rows == tuples(mixing.takes(mixing.sized(docs.repartition(7))).select(*COLS))


def test_mix_hot_source_buckets_and_repeats(spark):
    rnd = random.Random(3)
    rows = [(i, "w " * rnd.randint(0, 60), "en", rnd.choice(["hot", "hot", "b", "Ab", "é", None])) for i in range(900)]
    rows += [(None, "five words in this one", "en", "hot")] * 300   # alike in all columns
    docs = frame(spark, rows)
    cfg = mixing.MixConfig(bucket=50)
    got = tuples(mixing.takes(mixing.sized(docs), cfg).select(*COLS))
    assert len(got) == len(rows)
    check_mix(got)
    mixed = mixing.mixed(docs, cfg)
    assert mixed.columns == docs.columns
    assert Counter(r[0] for r in mixed.select("doc_id").collect()) == Counter(
        {d: n for d, n in Counter(r[0] for r in got for _ in range(r[6])).items()})


def test_mix_edges(spark):
    got = tuples(mixing.takes(mixing.sized(frame(spark, EDGES))).select("doc_id", "size", "taken", "source"))
    assert len(got) == len(EDGES)
    assert all(t <= 2 * s for _, s, t, _ in got)
    assert [(s, t) for d, s, t, _ in got if d in (1, 2, 3)] == [(0, 0)] * 3
    assert mixing.takes(mixing.sized(frame(spark, []))).count() == 0
    nothing = frame(spark, [(1, None, None, None), (2, "", None, "x")])
    assert [r[1:] for r in tuples(mixing.takes(mixing.sized(nothing)).select("doc_id", "target", "taken"))] == [(0.0, 0)] * 2


# ---- 12

def test_near_pairs_brute(spark):
    rnd = random.Random(5)
    words = set()
    while len(words) < 500:
        words.add("".join(rnd.choice("abé") for _ in range(rnd.randint(6, 10))))

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    want = {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = spelling.near_pairs(df).select("u", "v").collect()
    assert len(got) == len(want) and {frozenset(r) for r in got} == want


def test_spelling_edges(spark):
    docs = frame(spark, EDGES)
    assert tuples(spelling.variants(docs).select(*WORDS)) == in_duck(spark, docs, spelling.SQL, WORDS)
    small = spelling.SpellingConfig(slice_bytes=64, least_count=1)
    large = spelling.SpellingConfig(least_count=1)
    assert tuples(spelling.variants(docs, small)) == tuples(spelling.variants(docs, large))
    assert spelling.variants(frame(spark, [])).count() == 0


def test_spelling_very_long_texts(spark):
    text = "wording " * 200_000 + "x" * 300_000 + " wordings " * 7
    cfg = spelling.SpellingConfig(slice_bytes=100_000, typo=1 << 40)
    got = {r[0]: (r[3], r[4]) for r in spelling.variants(frame(spark, [(1, text, "en", "s")]), cfg).select(*WORDS).collect()}
    assert got == {"wording": (200_000, 1), "wordings": (7, 1)}


def test_phrases_of_very_long_texts(spark):
    text = "aa bb " * 100_000 + "z" * 300_000 + " aa bb" * 3
    cfg = phrases.PhraseConfig(slice_bytes=100_000)
    got = {r["phrase"]: r["a"] for r in phrases.collocations(frame(spark, [(1, text, "en", "s")]), cfg).collect()}
    counts = {r["phrase"]: r["c"] for r in phrases.phrase_counts(frame(spark, [(1, text, "en", "s")]), cfg).collect()}
    assert counts == {"": 200_007, "aa": 100_003, "bb": 100_003, "aa bb": 100_003, "bb aa": 100_001, "aa bb aa": 100_001,
                      "bb aa bb": 100_001, "aa bb aa bb": 100_001, "bb aa bb aa": 99_999}
    assert got


def test_spelling_typo_and_roots(spark):
    run = "wording"
    d = next(i for i in range(10_000) if zlib.crc32(f"{i}:{run}".encode()) % 199 == 0)
    h = zlib.crc32(f"{d}:{run}".encode()) % len(run)
    lost = run[:h] + run[h + 1:]
    rows = [(d, (run + " ") * 6, "en", "s"), (d + 1, "WORDING " * 40, "en", "s"), (d + 2, "wordings " * 900, "en", "s")]
    got = {r[0]: tuple(r)[1:] for r in spelling.variants(frame(spark, rows)).select(*WORDS).collect()}
    assert got == {lost: (run, "wordings", 6, 1, 40), run: ("wordings", "wordings", 40, 2, 900),
                   "wordings": (None, "wordings", 900, 1, None)}


# ---- 13

def test_phrases_across_slices(spark):
    rnd = random.Random(9)
    voc = ["a", "bé", "c", "dd"]
    text = "".join(rnd.choice(voc) + rnd.choice([" ", " ", "\t", "  ", ", ", "\n"]) for _ in range(1500))
    docs = frame(spark, [(1, text, "en", "s"), (2, text.upper(), None, "s"), (3, None, "en", "s"), (4, "z" * 300, "en", "s")])
    want = in_duck(spark, docs, phrases.SQL, RANKS)
    assert len(want) > 20
    for size in (97, 1 << 20):
        cfg = phrases.PhraseConfig(slice_bytes=size)
        if size > 97:
            cfg = phrases.PhraseConfig(filter_bits=64)   # a filter that lets nearly all pass loses nothing
        got = phrases.collocations(docs, cfg)
        assert tuples(got.select(*RANKS)) == want


def test_cut_text_keeps_every_word():
    rnd = random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choice("ab  \t.\n") for _ in range(rnd.randint(0, 60))).encode()
        words = [w for p in text.replace(b"\n", b".").split(b".") for w in p.split()]
        got = []
        for part, known in phrases.cut_text(text, rnd.randint(1, 12), 3):
            got += [w for p in part.replace(b"\n", b".").split(b".") for w in p.split()][known:]
        assert got == words


def test_phrase_edges(spark):
    docs = frame(spark, EDGES)
    got = phrases.collocations(docs)
    assert tuples(got.select(*RANKS)) == in_duck(spark, docs, phrases.SQL, RANKS)
    assert phrases.collocations(frame(spark, [])).count() == 0


def test_ranks_are_cut_in_parts(spark):
    rnd = random.Random(6)
    rows = [("en" if i % 5 else "de", f"p {i}", rnd.randrange(30), rnd.randrange(4)) for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, phrase string, score long, a long")
    got = sorted((r["lang"], r["rank"], r["phrase"]) for r in phrases.ranked(df, 40).collect())
    want = [(lang, k + 1, r[1]) for lang in ("de", "en") for k, r in enumerate(sorted(
        (r for r in rows if r[0] == lang), key=lambda r: (-r[2], -r[3], r[1].encode()))[:40])]
    assert got == want
