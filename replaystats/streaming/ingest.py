"""Continuous folder ingest."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from replaystats.plans.jobs import retry_files, settle_files
from replaystats.session import stage, staging
from replaystats.sources.meta import MIN_AGE_SECONDS, is_settled
from replaystats.sources.tables import Tables


def meta_file_stream(spark: SparkSession, inbox: str, archive: str | None = None, max_files: int = 10_000) -> DataFrame:
    """New ``*.json`` files of a folder as a stream. With ``archive`` handled files are moved there."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", max_files)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = reader.load(inbox)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").alias("raw_json"),
    )


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def land_batch(
    tables: Tables,
    inbox: str,
    quarantine: str,
    processed: str | None = None,
    min_age_s: float = MIN_AGE_SECONDS,
    clock: Callable[[], datetime] = utc_now,
):
    """Batch writer: good documents into the cache, bad ones aside, young ones into the retry ledger.

    A stream offers a file once, as it is then. So files that are still young, and broken ones, are
    noted, and every batch also offers those of them again that have settled or changed since.
    Insert-ignore and the journal make a repeated batch harmless. Each batch adds a folder to the
    cache, which the next move to the archive merges.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        now = clock()
        with staging(tables.spark):
            files = stage(batch, "files")  # read once: the insert uses the rows several times
            done = is_settled(now, min_age_s)
            counts = {"inserted": 0, "skipped": 0, "bad": 0}
            settle_files(tables, files.filter(done), now, counts, quarantine, processed, young=files.filter(~done))
        retry_files(tables, inbox, quarantine, now, processed, min_age_s)

    return write


def ingest_stream(
    spark: SparkSession,
    inbox: str,
    tables: Tables,
    checkpoint: str,
    quarantine: str,
    archive: str | None = None,
    every: str | None = None,
    max_files: int = 10_000,
    processed: str | None = None,
    min_age_s: float = MIN_AGE_SECONDS,
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Ingest new files until they are used up, or continuously when ``every`` gives an interval.

    ``max_files`` bounds a micro-batch; the rest follows in the next. Files that were young or broken
    when the stream saw them are taken up by the next batch, and when the stream starts; where neither
    comes soon, the job ``retry_files`` does it. Landed files are moved to ``processed`` as in the
    batch form, or by the stream itself to ``archive``, where they keep their path.
    """
    if archive and processed:
        raise ValueError("archive and processed both move the files: give one of them")
    retry_files(tables, inbox, quarantine, clock(), processed, min_age_s)
    sink = land_batch(tables, inbox, quarantine, processed, min_age_s, clock)
    writer = meta_file_stream(spark, inbox, archive, max_files).writeStream.foreachBatch(sink)
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
