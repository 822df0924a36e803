"""Probes of the last review, each as a test."""

import os
import random
import subprocess
import sys
import textwrap
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import pii, quality, secrets

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
KEY = "AKIA" + "Q7W2E9R4T6Y1U8I3"


def frame(spark, rows, schema="doc_id long, text string, source string"):
    return spark.createDataFrame(rows, schema)


def test_secrets_verdict_of_repeated_and_null_ids(spark):
    text = f"key {KEY} end"
    docs = frame(spark, [(1, text, "a"), (1, text, "a"), (None, text, "a"), (2, "nothing", "a")])
    got = sorted((r["doc_id"] or 0, r["n_access"], r["n_live"], r["max_repos"]) for r in secrets.report(docs).collect())
    assert got == [(0, 1, 1, 1), (1, 1, 1, 1), (1, 1, 1, 1), (2, 0, 0, 0)]


def test_secrets_many_matches(spark):
    rnd = random.Random(1)
    parts = [f"{rnd.getrandbits(80):020x}" for _ in range(30_000)]
    text = " ".join(parts)
    start = time.time()
    got = secrets.report(frame(spark, [(1, text, "a")])).first()
    assert time.time() - start < 60
    want = [(f"hex:{i * 21}:{i * 21 + 20}") for i in range(len(parts))]
    assert got["n_hex"] == len(parts) and got["spans"] == ",".join(want)


def test_pii_long_word_runs():
    start = time.time()
    assert pii.mentions("a@b.cd " + "x" * 1_000_000 + " 1.2") == [(0, 6, "email", "a@b.cd")]
    assert time.time() - start < 10


def test_pii_one_name_is_one_entity():
    text = "Mr Berg met Dr Berg. Berg left with Mrs Ida Lund; Ida Lund spoke. Bergen stayed."
    new = pii.rewrite(text, pii.mentions(text), b"k")
    words = new.replace(".", "").replace(";", "").split()
    assert words[1] == words[4] == words[5] and words[1] != "Berg"
    assert " ".join(words[9:11]) == " ".join(words[11:13]) != "Ida Lund"
    assert new.endswith("Bergen stayed.")


def test_pii_names_are_distinct_over_all_kinds(spark):
    rnd = random.Random(3)
    names = list({"".join(rnd.choice("abdelmnorst") for _ in range(4)).capitalize() for _ in range(900)})
    rows = [(i, f"{('Ms', 'Dr')[i % 2]} {n} came") for i, n in enumerate(names)]
    docs = frame(spark, rows, "doc_id long, text string")
    new = [r["text"].split()[1] for r in pii.replace(docs).collect()]
    assert len(set(new)) == len(names) and not set(new) & set(names)


def test_pii_keeps_the_script():
    for name, low, high in (("李明", 0x4E00, 0x9FA5), ("محمد", 0x600, 0x6FF), ("Иван", 0x400, 0x4FF)):
        new = pii._name(pii.Draw(b"k", name), name, "n")
        assert new != name and all(low <= ord(c) <= high for c in new)
    assert all(0x4E00 <= ord(c) <= 0x9FA5 for c in pii.surrogate("email", "李明@b.cn", 0, b"k").split("@")[0])


def test_quality_predicted_is_read_off_the_score(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = quality.score(docs, quality.fit(docs, labels))
    assert got.filter((F.col("score") >= 0.3) != (F.col("predicted") == 1)).count() == 0


def test_pipeline_rows_of_one_id(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    item = "the quick brown fox jumps over the lazy dog near the river bank at dawn every single day of the week"
    other = "a completely different text about gardens and the making of bread in an old stone oven by the sea"
    docs = spark.createDataFrame([(1, item, "x"), (2, item, "x"), (2, other, "x"), (None, item, "x")],
                                 "doc_id long, text string, extra string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, item), (2, other)]


def test_decontamination_of_repeated_and_null_ids(spark, scratch):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rnd = random.Random(2)
    item = " ".join(f"w{rnd.randrange(500)}" for _ in range(40))
    other = " ".join(f"v{rnd.randrange(500)}" for _ in range(40))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs = spark.createDataFrame([(1, item), (2, item), (2, other), (None, "so " + item), (3, None)], "doc_id long, text string")
    kept = corpus_pipeline.decontaminate(spark, docs, scratch)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == {(2, other): 1, (3, None): 1}


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Workers start in another folder and never see the package: the operators run all the same."""
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        from cardwatch.llm import decontam, phrases, spelling
        item = " ".join(f"w{{i}}" for i in range(30))
        docs = spark.createDataFrame([(1, item, "en"), (2, "other words", "en")], "doc_id long, text string, lang string")
        bench = spark.createDataFrame([(7, item)], "item_id long, text string")
        print("found", decontam.contaminated(docs, bench).count(), phrases.phrase_counts(docs).count(),
              spelling.variants(docs).count())
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found 1 1 0" in out.stdout, out.stderr[-2000:]
