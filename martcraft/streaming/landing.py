"""Incremental load as a file stream: new CSV files in a landing folder -> cleaned Parquet.

The stream only tracks file names; each micro-batch reads its files by their
own headers, under the same contract as the batch reader, so a file with other
column order lands right and one without a required column fails the batch.
The stream's checkpoint remembers which files were read, so unlike a
``MAX(date)`` mark it also loads late rows dated before the mark.
``foreachBatch`` is at-least-once; each micro-batch overwrites only its own
``batch_id`` partition, so a replayed batch replaces its earlier output.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martcraft.operators.cleaning import clean_transactions
from martcraft.session import checkpoint_dir
from martcraft.sources.raw import read_raw_csv


def stream_landing(spark: SparkSession, landing_dir: str, target_dir: str, name: str = "landing",
                   on_reject: str = "null", checkpoint: str | None = None, available_now: bool = True,
                   every: str = "1 minute", files_per_batch: int = 1000) -> StreamingQuery:
    """Start the stream. A micro-batch has at most ``files_per_batch`` files; without
    ``available_now`` a batch starts ``every`` so often."""
    listing = "path string, modificationTime timestamp, length long, content binary"
    names = (spark.readStream.format("binaryFile").schema(listing).option("maxFilesPerTrigger", files_per_batch)
             .option("pathGlobFilter", "*.csv").load(landing_dir).select("path"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        files = [r.path for r in batch.select("path").distinct().collect()]  # bounded by files_per_batch
        if not files:
            return
        cleaned = clean_transactions(read_raw_csv(batch.sparkSession, files), on_reject=on_reject)
        (cleaned.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target_dir))

    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "streams", name)
    w = names.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()
