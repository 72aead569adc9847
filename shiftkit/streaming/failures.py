"""Failure analysis as a file stream: new failure files, counted once.

Failure files are ``<stem>_FAILURE.csv`` files or part files inside a folder
of that name (as Spark writes them).

The reference analyses a whole folder each time it is asked.  A landing
folder that keeps receiving outcome files is a file stream: the file source
tracks which files were seen (in the checkpoint), each micro-batch counts the
error types of its new files (A2 per stem) and writes them under its
``batch_id``.  The write overwrites only that batch's partition, so a batch
that is replayed after a failure replaces its own output: exactly-once
results with an at-least-once sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiftkit.functions.params import failure_stem
from shiftkit.plans.failures import error_type_counts
from shiftkit.session import shared_dir
from shiftkit.sources.files import read_failure_files
from shiftkit.sources.listing import literal

# The binary-file source's fixed schema (file streams need it declared).
BINARY_FILE_SCHEMA = ("path string, modificationTime timestamp, length bigint, content binary")


def _process(out_path: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # New failure-file names of this micro-batch: at most max_files_per_trigger.
        paths = [r["path"] for r in batch.where(failure_stem("path").isNotNull()).select("path").collect()]
        if not paths:
            return
        listing = spark.createDataFrame([(p,) for p in paths], "path string")
        counts = (error_type_counts(read_failure_files(spark, listing, [literal(p) for p in paths], glob=None), by=["stem"])
                  .withColumn("batch_id", F.lit(batch_id)))
        (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))
    return run


def start_failure_stream(spark: SparkSession, landing: str, out_path: str,
                         checkpoint: str | None = None, available_now: bool = True,
                         max_files_per_trigger: int = 1_000) -> StreamingQuery:
    """Start the incremental analysis of ``landing``; results go to ``out_path``.

    ``available_now`` processes what has landed and stops (scheduled runs);
    otherwise the query keeps polling.  A micro-batch holds at most
    ``max_files_per_trigger`` files.  The checkpoint defaults to a new
    folder under ``spark.checkpoint.dir``.
    """
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true"))
    reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(landing).select("path")
    writer = (files.writeStream.foreachBatch(_process(out_path))
              .option("checkpointLocation", checkpoint or shared_dir(spark, "failure-stream")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
