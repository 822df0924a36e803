
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import decontam, langid, pii, quality, rules, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_threshold_is_of_all_labelled_rows(spark, docs):
    """Labels that overlap in score, one in seven 0: a sample cut to equal classes must not move the threshold."""
    ids = [r[0] for r in docs.select("doc_id").distinct().collect()]
    y = {i: int(zlib.crc32(f"x{i}".encode()) % 7 != 0) for i in ids}
    labels = spark.createDataFrame([(i, v, 0) for i, v in y.items()], "doc_id long, quality int, toxic int")
    learned = [i for i in ids if zlib.crc32(str(i).encode()) % 5]
    model = quality.fit(docs, labels, quality.QualityConfig(train_per_label=15))
    s = dict(quality.strengths(docs, model).collect())
    low, zeros = sum(s[i] < model.threshold for i in learned), sum(1 - y[i] for i in learned)
    assert abs(low - zeros) <= 1
    got = quality.score(docs, model).filter(F.col("doc_id").isin(learned))
    assert got.filter("predicted = 0").count() == low


def test_kth_smallest(spark):
    v = sorted([0.5] * 40 + [1e-9 * i for i in range(300)] + [-3.0, 1e6])
    df = spark.createDataFrame([(x,) for x in v], "s double")
    for k in (1, 2, 150, 301, 302, 320, 341, 342):
        assert quality.kth_smallest(df, k) == v[k - 1]


def test_toxicity_probabilities_keep_the_class_shares(spark):
    """Two words that tell little: the mean P(toxic) of the labelled rows is their toxic share, sampled or not."""
    rows, labels = [], []
    for i in range(3000):
        bad = zlib.crc32(f"t{i}".encode()) % 10 == 0
        marked = zlib.crc32(f"m{i}".encode()) % 100 < (60 if bad else 3)
        rows.append((i, "plain text here " + ("grimword" if marked else "calm")))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    cfg = toxicity.ToxicConfig(train_per_label=150)
    base = {}
    for c in (toxicity.ToxicConfig(), cfg):
        model = toxicity.fit(docs, lab, c)
        got = dict(toxicity.score(docs, model, c).select("doc_id", "expected_severity").collect())
        base[c.train_per_label] = sum(got.values()) / len(got)
    assert base[150] == pytest.approx(base[4000], rel=0.3)


def test_toxicity_learns_words_of_few_toxic_rows(spark):
    """Four of about 320 toxic rows (1.25 %) share a word that no clean row has."""
    few = [i for i in range(0, 4000, 10) if zlib.crc32(str(i).encode()) % 5][:4]
    rows = [(i, "some vileword" if i in few else "a grimword here" if i % 10 == 0 else "calm words here") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab)
    probe = spark.createDataFrame([(1, "more vileword"), (2, "more words")], "doc_id long, text string")
    sev = dict(toxicity.score(probe, model).select("doc_id", "expected_severity").collect())
    assert sev[1] > sev[2]


def test_rules_padded_lines_fail_like_unpadded(spark):
    bad = ["read more", "Home menu"]
    rows = [(i, f"{line}{pad}") for i, (line, pad) in enumerate((x, p) for x in bad for p in ("", " " * 10, "\t" * 9))]
    rows.append((9, "It ends." + " " * 10))
    got = rules.judge(spark.createDataFrame(rows, "doc_id long, text string"))
    fails = {r["doc_id"]: r["n_failed_lines"] for r in got.collect()}
    assert fails == {**dict.fromkeys(range(6), 1), 9: 0}


def test_pii_more_entities_than_slots(spark):
    """All 26 one-letter mailboxes of a domain, and more short names than short surrogates."""
    mails = [f"{c}@x-corp.org" for c in "abcdefghijklmnopqrstuvwxyz"]
    names = [a + b + c for a in "BCDFGHKLMNPRSTVW" for b in "aeiou" for c in "bcdfghklmnprstvz"]
    rows = [(i, x) for i, x in enumerate(mails + [f"Mrs {n}" for n in names])]
    out = [r[1] for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
    assert len(names) > 980 and len(set(out)) == len(rows) and not set(out) & {t for _, t in rows}
    assert len({x.split("@")[1] for x in out[:26]}) == 1


def test_pii_widened_surrogates_keep_their_kind():
    for kind, canon in (("ssn", "123456789"), ("card", "4111111111111111"), ("iban", "DE44500105175407324931"),
                        ("phone", "0175557713"), ("email", "a@b.org"), ("ip", "10.1.2.3"), ("name-f", "Ida")):
        wide = [pii.surrogate(kind, canon, n, b"k") for n in range(40)]
        assert len(set(wide[20:])) == 20
        assert all(pii.luhn(x) for x in wide) if kind == "card" else True
    assert re.fullmatch(r"\d{3}-\d{2}-\d{5}", pii.in_shape("ssn", "123-45-6789", "9876543210"))


@pytest.mark.parametrize("n", [50, 100, 200, 400])
def test_decontam_recall_at_the_edit_limit(n):
    """Items with exactly the allowed number of mixed edits, for every length."""
    rnd, count = random.Random(n), 60 if n <= 100 else 16
    items, texts = [], []
    for i in range(count):
        w = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
        items.append(" ".join(w))
        for p in sorted(rnd.sample(range(n), decontam.edits_allowed(n, 0.8)), reverse=True):
            kind = rnd.randrange(3)
            w[p:p + (kind > 0)] = [f"x{rnd.randrange(10**6)}"] * (kind < 2)
        texts.append(" ".join([f"p{j}x{i}" for j in range(40)] + w + [f"q{j}x{i}" for j in range(n)]))
    block = decontam.Items(list(range(count)), items, decontam.DecontamConfig())
    found = {(a, b) for a, b, _, _ in decontam.matches(texts, block)}
    assert found <= {(i, i) for i in range(count)} and len(found) >= count - 1


def test_langid_every_label_and_large_sets(spark):
    """Seventy languages of their own letters: each is recognised, and a document of five has all five."""
    words = {f"l{k:02d}": " ".join(chr(0x4E00 + 40 * k + j) * 2 for j in range(30)) for k in range(70)}
    rows = [(i, t, x) for i, (x, t) in enumerate(words.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, model = langid.fit(docs)
    assert langs == sorted(words)
    assert all(r["lang_pred"] == rows[r["doc_id"]][2] for r in langid.predict(docs, langs, model).collect())
    five = spark.createDataFrame([(1, " ".join(words[x] for x in langs[:5]))], "doc_id long, text string")
    row = langid.predict(five, langs, model).first()
    assert row["langs"] == ",".join(langs[:5]) and 0.15 < row["score"] < 0.3
