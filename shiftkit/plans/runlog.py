"""The run log with a commit protocol (K4).

Each run has an id.  Its rows are staged in a folder of the attempt that wrote
them, and one marker file publishes them by naming that attempt:

    <path>/data/run=<id>/attempt=<attempt>/...      staged rows
    <path>/published/<id>                           marker: the attempt

The marker is created in one step that fails if it is there.  So an attempt
that dies leaves nothing that is read, a run that is tried again is
published once, by whoever comes first, and two runs of one moment both stay.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftkit.plans.runs import RUN_LOG_SCHEMA
from shiftkit.sources.listing import decoded


def new_run_id() -> str:
    return uuid.uuid4().hex


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def published_attempt(spark: SparkSession, path: str, run_id: str) -> str | None:
    """The attempt that published a run, or None."""
    fs, p = _fs(spark, f"{path}/published/{quote(run_id, safe='')}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode() or None          # an empty marker: its writer died, nothing is published
    finally:
        stream.close()


def stage_run(log: DataFrame, path: str, run_id: str) -> str:
    """Write the rows of a run where nobody reads them yet; returns the attempt."""
    attempt = uuid.uuid4().hex
    log.write.parquet(f"{path}/data/run={quote(run_id, safe='')}/attempt={attempt}")
    return attempt


def publish_run(spark: SparkSession, path: str, run_id: str, attempt: str) -> bool:
    """Create the run's marker; False if another attempt has published it."""
    fs, p = _fs(spark, f"{path}/published/{quote(run_id, safe='')}")
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)
    except Exception:                                                 # there is a marker
        if published_attempt(spark, path, run_id) is not None:
            return False
        out = fs.create(p, True)
    out.write(bytearray(attempt.encode()))
    out.close()
    return True


def log_run(log: DataFrame, path: str, run_id: str) -> bool:
    """K4: stage and publish the rows of a run, unless it is published already."""
    path, spark = path.rstrip("/"), log.sparkSession
    if published_attempt(spark, path, run_id) is not None:
        return False
    return publish_run(spark, path, run_id, stage_run(log, path, run_id))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the published runs, with ``run_id``; staged rows of other attempts are left out."""
    path = path.rstrip("/")
    fs, p = _fs(spark, f"{path}/published")
    empty = spark.createDataFrame([], f"run_id string, {RUN_LOG_SCHEMA}")
    if not fs.exists(p):
        return empty
    markers = spark.read.text(f"{path}/published", wholetext=True).select(
        F.url_decode(decoded("_metadata.file_name")).alias("run_id"), F.col("value").alias("attempt"))
    schema = f"{RUN_LOG_SCHEMA}, run string, attempt string"
    rows = spark.read.option("basePath", f"{path}/data").schema(schema).parquet(f"{path}/data")
    rows = rows.withColumnRenamed("run", "run_id")
    return rows.join(markers, ["run_id", "attempt"], "left_semi").select(*empty.columns)


