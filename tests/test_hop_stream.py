"""Rule 3 on a stream: three micro-batches with late rows equal the batch plan, and the state is dropped; the feed stream
reads names only."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cardwatch.config import DEFAULT
from cardwatch.operators import rules
from cardwatch.schemas import FACT, FACT_COLS
from cardwatch.streaming.hop_stream import city_hops
from helpers import D, T, digest, fact_rows


@pytest.fixture()
def small_shuffles(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def history(spark, cities):
    rows = [(f"T{k}", "ATM", c, "a", D(2024, 1, 1), T(2999, 12, 31, 23, 59, 59), 0) for k, c in enumerate(cities)]
    return spark.createDataFrame(rows, "terminal_id string, terminal_type string, terminal_city string, "
                                       "terminal_address string, effective_from date, effective_to timestamp_ntz, "
                                       "deleted_flg int")


def test_stream_equals_batch_with_late_rows(spark, scratch, small_shuffles):
    rnd = random.Random(4)
    hist = history(spark, ["A", "B", "A", "C", None])
    rows = []
    for i in range(400):  # three days, five cards, so that many pairs lie within the hour, some over midnight
        s = rnd.randrange(3 * 86400)
        s = s if i % 3 else 86400 * (1 + i % 2) + rnd.randrange(-1800, 1800)
        day, rest = 2 + s // 86400, s % 86400
        rows.append((f"{i:04d}", T(2024, 1, day, rest // 3600, rest % 3600 // 60, rest % 60), f"C{rnd.randrange(5)}",
                     rnd.choice(["WITHDRAW", "WITHDRAW", "PAYMENT"]), 5, "SUCCESS", f"T{rnd.randrange(6)}"))
    rows.sort(key=lambda r: r[1])
    # three batches by time, with rows up to an hour and a half late in the next one
    batches = [[], [], []]
    for k, r in enumerate(rows):
        b = k * 3 // len(rows)
        late = k % 7 == 0 and b < 2 and rows[(b + 1) * len(rows) // 3 - 1][1] - r[1] < T(2024, 1, 1, 1, 30) - T(2024, 1, 1)
        batches[b + 1 if late else b].append(r)
    assert any(r[1] < max(x[1] for x in batches[0]) for r in batches[1])
    end = [("zzzz", T(2024, 1, 9), "none", "WITHDRAW", 5, "SUCCESS", "T0")]   # moves the watermark past all
    inbox, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.mkdir(inbox)
    fact = fact_rows(spark, rows)
    runs = fact.select(F.col("file_date").alias("run_date")).distinct()
    states = []
    for n, b in enumerate([*batches, end]):
        fact_rows(spark, b).select(*FACT_COLS).coalesce(1).write.mode("append").parquet(inbox)
        src = spark.readStream.schema(FACT).parquet(inbox)
        q = (city_hops(src, hist, runs).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination(300)
        states.append([p.numRowsTotal for p in _last(q)])
    got = spark.read.parquet(out)
    want = rules.city_hop_pair(fact, hist, runs, DEFAULT, True, True)
    assert want.count() > 20
    assert digest(got.select(*want.columns)) == digest(want)
    assert max(states[0]) > 5 and all(n <= 2 for n in states[-1])   # only the last marker row is left


def test_stream_does_not_read_contents(spark, tmp_path):
    """Files over binaryFile.maxLength can only pass if their content is not read."""
    from cardwatch.streaming import feed_stream
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "transactions_01012024.txt").write_text("h\n" * 50)
    seen = []

    class Loader:
        def load_files(self, folder, found):
            seen.extend(r["file_name"] for r in found.collect())

    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "10")
    try:
        q = feed_stream.start(spark, Loader(), str(inbox), query_name="t_names", checkpoint=str(tmp_path / "ckpt"))
        q.awaitTermination(60)
        assert q.exception() is None
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert seen == ["transactions_01012024.txt"]


def _last(q):
    class Op:
        def __init__(self, o):
            self.numRowsTotal = o["numRowsTotal"]
    return [Op(o) for o in q.lastProgress["stateOperators"]]
