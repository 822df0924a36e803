"""Incremental load of the feed folder with Structured Streaming.

The stream watches the folder's file metadata (names, not contents) for all three feeds. Each micro-batch is the
list of the files that came in; ``foreachBatch`` hands it to the warehouse's day-by-day load, the same one that the
batch path runs. So the order (batch date, then passports, terminals, transactions), the reject store, refused
files and further files of a loaded day are the same in both, and only the new names are listed, never the whole folder.
The stream's checkpoint (its record of processed files) lives under the session's shared ``spark.checkpoint.dir``;
a restarted query resumes from it. A replayed micro-batch skips the files that the manifest has and rewrites the day
partitions of the others, so a lost executor or driver never doubles the facts.

With ``archive`` the source moves the files of a micro-batch there once the next one begins (so those of the last stay
until more files come); a day that is written anew reads its earlier files where they then are. With ``max_files`` a
large folder comes in several micro-batches, also with a day's files in two of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwatch.plans.warehouse import Warehouse
from cardwatch.session import checkpoint_dir
from cardwatch.sources import feeds

FILES = "path string, modificationTime timestamp, length long, content binary"


#: threads that move files beside the stream; none here: a file must not move while a load reads it
MOVERS = "spark.sql.streaming.fileSource.cleaner.numThreads"


def _process(wh: Warehouse, folder: str, archive: str | None):
    def run(batch: DataFrame, epoch_id: int) -> None:
        wh.load_files(folder, feeds.classify(batch), *[archive] * bool(archive))
    return run


def start(spark: SparkSession, wh: Warehouse, folder: str, query_name: str = "cardwatch_tx",
          checkpoint: str | None = None, available_now: bool = True, archive: str | None = None,
          max_files: int | None = None):
    """Start the stream; with ``available_now`` it stops once the folder is drained."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"
    # selected on the stream itself: inside a micro-batch the scan can no longer be pruned
    reader = spark.readStream.format("binaryFile").schema(FILES)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    src = reader.load(folder).select("path", "modificationTime", "length")
    w = (src.writeStream.queryName(query_name).option("checkpointLocation", ckpt)
         .foreachBatch(_process(wh, folder, archive)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    if not archive:
        return w.start()
    movers = spark.conf.get(MOVERS)
    spark.conf.set(MOVERS, "0")
    try:
        return w.start()  # the stream keeps the settings it started with
    finally:
        spark.conf.set(MOVERS, movers)
