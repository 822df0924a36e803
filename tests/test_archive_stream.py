"""Stream that sets loaded files aside: the folder drains, a restart neither loses nor repeats a day."""

import datetime as dt
import os
import shutil

from cardwatch.config import DEFAULT, FIXED_REPORT_DT
from cardwatch.plans.context import Inputs
from cardwatch.plans.warehouse import Warehouse
from cardwatch.streaming import feed_stream
from conftest import SF0001
from feedfiles import write_feeds

CFG = DEFAULT.with_(report_dt=FIXED_REPORT_DT)


def _warehouse(spark, root):
    x = Inputs(spark, SF0001)
    wh = Warehouse(spark, root, CFG)
    wh.bootstrap(x.cards, x.accounts, x.clients)
    return wh


def _tables(wh):
    return {n: sorted(map(str, df.collect())) for n, df in {
        "fact": wh.fact(), "blacklist": wh.blacklist(), "history": wh.terminals_history(), "alerts": wh.alerts(),
        "rejects": wh.rejects(), "audit": wh.audit()}.items()}


def _names(folder):
    return sorted(n for _, _, files in os.walk(folder) for n in files if not n.startswith("."))


def test_archived_stream_equals_the_batch_load(spark, scratch):
    every, src, arch = (os.path.join(scratch, n) for n in ("every", "src", "arch"))
    os.makedirs(every), os.makedirs(src)
    write_feeds(spark, SF0001, every, dt.date(2024, 1, 3))
    late = [n for n in _names(every) if "03012024" in n]
    first = [n for n in _names(every) if n not in late]
    assert late and len(first) > 3

    def arrive(names):
        for n in names:
            shutil.copy2(os.path.join(every, n), src)

    wh = _warehouse(spark, os.path.join(scratch, "wh"))

    def run():  # two files a micro-batch: a day's files come in several, the earlier ones are moved by then
        q = feed_stream.start(spark, wh, src, "archived", os.path.join(scratch, "ckpt"), archive=arch, max_files=2)
        q.awaitTermination()
        return [p["batchId"] for p in q.recentProgress if p["numInputRows"]]

    arrive(first)
    assert len(run()) >= 2
    left = _names(src)
    assert len(left) <= 2 and sorted(left + _names(arch)) == first  # only the last micro-batch's files wait
    seen = _tables(wh)
    assert run() == [] and _tables(wh) == seen  # a restart without files changes nothing
    arrive(late)
    run()
    assert set(_names(src)) <= set(late) and set(first) <= set(_names(arch))
    assert sorted(_names(src) + _names(arch)) == _names(every)
    batch = _warehouse(spark, os.path.join(scratch, "wh2"))
    batch.load_folder(every)
    assert _tables(wh) == _tables(batch)


def test_the_session_keeps_its_own_setting(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    was = spark.conf.get(feed_stream.MOVERS)
    wh = _warehouse(spark, os.path.join(scratch, "wh"))
    feed_stream.start(spark, wh, src, "empty", os.path.join(scratch, "ckpt"), archive=os.path.join(scratch, "arch")).awaitTermination()
    assert spark.conf.get(feed_stream.MOVERS) == was
