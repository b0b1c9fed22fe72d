"""Incremental loads: pick up only the export files that arrived since the last run.

A Structured Streaming file source over the provider's inbox (it hands over the new files' names; each batch then reads them
by their own headers, so that one odd file doesn't stop the others), run with ``availableNow`` (process
what is there, then stop), so a daily scheduler call is one bounded job; the stream checkpoint
remembers which files were taken. Each micro-batch (``foreachBatch``) is one load
(``plans.loads.load_exports_into``), the same as a batch load, into the same landed store:

1. files that any load has taken before are left out, by the mart's own record of files: a second inbox with its
   own state folder, a file delivered twice or a lost checkpoint brings no row twice;
2. its canonical rows are landed under the touched months, and one row of counts is written, also for a batch of
   which no row is kept; what it drops or can read only in part goes to the quarantine, and a file without a required column whole;
3. its rows are appended to the fact and the rollup of those months, numbered behind the copies that are there, so a
   late file yields the same ids as a full rebuild and no stored file is written again. A replayed batch takes back what it brought and
   rebuilds its months;
4. the batch's dimension rows are added as a new load.

Run the providers one after the other against one mart: two loads into one mart at the same time would race.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from costmart.plans.loads import load_exports_into, load_files_into, load_paths_into
from costmart.sinks.mart_store import read_landing
from costmart.sources.billing_csv import INPUT_COLUMNS
from costmart.sources.layouts import SourceLayout


#: Columns of the file source; a file's content is not among those that are read.
_LISTING = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Spark gave the stream when its checkpoint was made."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _process_batch(spark: SparkSession, layout: SourceLayout, base: str, load_offset: int, checkpoint: str | None = None):
    """Loads are numbered within a checkpoint, so its identity is part of their source."""
    def run(batch: DataFrame, batch_id: int) -> None:
        source, load = f"stream-{layout.provider}", load_offset + batch_id + 1
        if checkpoint:
            source += f"-{_stream_id(spark, checkpoint)}"
        if "path" in batch.columns:
            # a set, since a file may be listed twice (seen where a name in the inbox has wildcards)
            files = {tuple(f) for f in batch.select("path", "length", "modificationTime").collect()}
            load_paths_into(spark, layout, sorted(files), base, source, load)
        elif set(INPUT_COLUMNS) <= set(batch.columns):
            load_files_into(spark, layout, batch, base, source, load)
        else:
            load_exports_into(spark, [(layout, batch)], base, source, load)
    return run


def ingest_new_files(spark: SparkSession, layout: SourceLayout, inbox: str, base: str,
                     state_dir: str, load_offset: int = 0, max_files_per_trigger: int | None = None) -> None:
    """Process every not-yet-seen export file under ``inbox`` (glob allowed) into the mart at
    ``base``; ``state_dir`` holds the stream checkpoint. Blocks until done."""
    reader = spark.readStream.format("binaryFile").schema(_LISTING)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(inbox).select("path", "length", "modificationTime")
    checkpoint = f"{state_dir.rstrip('/')}/checkpoint-{layout.provider}"
    query = (stream.writeStream
             .foreachBatch(_process_batch(spark, layout, base, load_offset, checkpoint))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"ingest of {layout.provider} failed: {err}")


def landed_rows(spark: SparkSession, base: str) -> DataFrame:
    """All canonical rows landed so far (for audits)."""
    return read_landing(spark, base)


def ingest_all(spark: SparkSession, inboxes: list, base: str, state_dir: str, **options) -> None:
    """Run ``ingest_new_files`` for several providers one after the other (``[(layout, inbox)]``),
    the safe order for one mart: two providers' batches never rewrite a month at the same time."""
    for layout, inbox in inboxes:
        ingest_new_files(spark, layout, inbox, base, state_dir, **options)
