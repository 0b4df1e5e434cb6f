"""Incremental ingestion of landed XML files with Structured Streaming.

The file source remembers, in its checkpoint, which files it has processed:
a second run over the same folder adds nothing, a new file adds only its
rows.  ``max_files_per_trigger`` bounds the work of one micro-batch;
``clean_source`` removes (or archives) processed files, best effort and one
batch late, so it is a tidy-up, not a guarantee.

The stream carries the files' listing (path, length, time; no content).  Each
micro-batch is read and committed by the batch loader
(``plans.xml_ingest.load_files``), which sets damaged files aside, so one of
them neither fails the stream nor comes up again until it changes.

No dedupe runs in the stream: the link table has no event time, so a
streaming distinct would keep unbounded state.  Dedupe stays a batch step on
the lake (``plans.linktable``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakesmith.plans.xml_ingest import CHECKPOINT, XML_GLOB, load_files, retry_changed
from lakesmith.sources import _fs

LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# Files per micro-batch unless told otherwise: a failed batch redoes at most
# this many files, and each batch commits its output and checkpoint.
DEFAULT_MAX_FILES_PER_TRIGGER = 1000


def stream_xml_links(spark: SparkSession, landing: str, lake: str, checkpoint: str | None = None,
                     max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                     clean_source: str | None = None, archive_dir: str | None = None, own_only: bool = False) -> int:
    """Process every file under ``landing`` not yet seen by ``checkpoint``
    (default: the lake's own) into the parquet ``lake`` (``availableNow``: all
    pending files, then stop).  Files that failed before and have changed are
    read again first.

    Returns the number of micro-batches run.
    """
    again = retry_changed(spark, landing, lake, own_only, max_files_per_trigger or DEFAULT_MAX_FILES_PER_TRIGGER)
    reader = spark.readStream.format("binaryFile").schema(LISTING_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", XML_GLOB)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    done = []

    def write(batch, epoch):
        load_files(spark, batch.collect(), lake, landing, own_only)   # one small row per file of the micro-batch
        done.append(epoch)

    q = (
        reader.load(landing).select("path", "length", "modificationTime").writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint or _fs.join(lake, CHECKPOINT))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return again + len(done)
