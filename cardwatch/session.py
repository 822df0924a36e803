"""Session helpers.

On a cluster the session is given; only fill in settings that are unset
(tests and local benches). The checkpoint folder always comes from
``spark.checkpoint.dir`` of the session; a local scratch folder is created
only when the setting is missing, which never happens on a cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "cardwatch") -> SparkSession:
    given = SparkSession.getActiveSession()
    if given is not None:  # a session that is there keeps every setting it has
        for k, v in _LOCAL_DEFAULTS.items():
            if k.startswith("spark.sql.") and given.conf.get(k, None) is None:
                given.conf.set(k, v)
        checkpoint_dir(given)
        return given
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("CARDWATCH_DRIVER_MEM", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster; set one only if unset.

    A machine-local scratch folder is used only for a ``local[...]`` master
    (tests, benches); on a cluster an unset folder is an error, since a
    lineage cut must survive the loss of any machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="cardwatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
