"""Real-time deck ingest with Structured Streaming.

The real-time deck folder receives whole deck files; each micro-batch parses the
new files and appends their records to a Parquet store partitioned by
``advisory`` (so later advisory filters prune directories).  Records keep
``path`` and ``line_no``, and the micro-batch that stored them: a batch that is tried again replaces
its own records, so nothing is stored twice.  Ordering, repair and motion run as batch jobs on the
store.  Progress is tracked in a checkpoint under the session's shared
``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.session import ensure_checkpoint_dir
from cyclonespark.sources.decks import parse_deck_lines, with_storm_code


def deck_file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (path, line_no, line) rows of new deck files in ``folder``."""
    reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = raw.select("path", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    return lines.filter(F.length(F.trim("line")) > 0).withColumn("line_no", F.col("line_no").cast("long"))


def _append_batch(store: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        records = with_storm_code(parse_deck_lines(batch))
        writer = records.withColumn("ingest_batch", F.lit(epoch_id)).write.option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite").partitionBy("advisory", "ingest_batch").parquet(store)

    return write


def start_deck_ingest(spark: SparkSession, folder: str, store: str, checkpoint: str | None = None,
                      available_now: bool = False, processing_time: str = "1 minute"):
    """Start the ingest query; returns the StreamingQuery."""
    if checkpoint is None:
        checkpoint = os.path.join(ensure_checkpoint_dir(spark), "deck-ingest")
    writer = deck_file_stream(spark, folder).writeStream.foreachBatch(_append_batch(store)).option(
        "checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
