"""Ingestion of archives as they arrive, in place of an upload queue.

A file stream finds new archives; each micro-batch is preprocessed and appended to the store. The
checkpoint remembers files, and a batch that runs twice finds its own folders of the store and writes
them anew or leaves them, so every archive counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans import preprocess
from ..sinks.store import append_outcomes, write_store
from ..sources.archives import ArchiveFiles

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def archive_stream(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    """The stream of new ``.tgz`` files below a folder, by path and content."""
    return (
        spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.tgz").option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch).load(folder)
    )


def start(spark: SparkSession, folder: str, store: str, checkpoint: str, opts: preprocess.Options, once: bool = True) -> StreamingQuery:
    """Runs the ingestion; with ``once`` it ends when everything that is there has been read."""

    def step(batch: DataFrame, batch_id: int) -> None:
        frames, series, outcomes = preprocess.run(ArchiveFiles(batch.select("path")), opts)
        append_outcomes(write_store(frames, series, store), f"{store}/outcomes")
        append_outcomes(outcomes, f"{store}/outcomes")

    writer = archive_stream(spark, folder).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
