"""Sinks (survey 2.8): K1 header CSV, K3 per-source folders.

K2 (apply a change set) is in :mod:`shiftkit.plans.changes`, K4 (run log) in
:mod:`shiftkit.plans.runs`, K5 (wide header columns) in
:mod:`shiftkit.operators.aggregate`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.functions.names import col
from shiftkit.functions.params import source_key


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite",
              partition_by: list[str] | None = None, compression: str | None = None) -> None:
    """K1: header CSV, UTF-8, quotes doubled, whitespace kept as is.

    Spark writes a folder of part files.  ``single_file`` coalesces to one
    part and is meant for small outputs (reports), never for tables.
    """
    out = df.coalesce(1) if single_file else df
    w = (out.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
         .option("encoding", "UTF-8")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path, compression=compression)


def write_by_source(df: DataFrame, path: str, source_url: str, fmt: str = "csv",
                    mode: str = "overwrite") -> None:
    """K3: one folder per source instance, ``source_key=<host_path>``.

    ``source_url`` names a column holding the instance URL; rows are spread
    over the folders by the partitioned writer (no shuffle).
    """
    keyed = df.withColumn("source_key", source_key(col(source_url))).drop(source_url)
    if fmt == "csv":
        write_csv(keyed, path, mode=mode, partition_by=["source_key"])
    else:
        keyed.write.mode(mode).partitionBy("source_key").format(fmt).save(path)


def with_source_key(df: DataFrame, url_col: str) -> DataFrame:
    """F12 as a column next to the URL."""
    return df.withColumn("source_key", source_key(F.col(url_col)))
