"""Job ``failure_analysis``: why did a load fail, per outcome-file pair.

Failure rows (the loader's ``*_FAILURE.csv``: the input columns plus
``errors``) are masked and whitespace-normalised into error types (F8, F9) and
counted (A2), with partial aggregation before the shuffle, so a dominant
error type costs one partial count per task.  Failure files are paired with
their import file by stem (J10) and row totals are compared (A3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.functions.names import col
from shiftkit.functions.text import normalize_error, trim_ws


def error_types(failures: DataFrame, errors_col: str = "errors") -> DataFrame:
    """F8 + F9 per failure row: column ``error``; blank errors dropped."""
    if errors_col not in failures.columns:
        return failures.select("*", F.lit(None).cast("string").alias("error")).where(F.lit(False))
    # Masking keeps every non-blank character, so a text is blank after
    # normalising exactly when it is blank before: filter on the cheap test
    # (a filter on the masked column would be pushed below the projection
    # and evaluate the masking twice).
    kept = failures.where(F.coalesce(trim_ws(col(errors_col)), F.lit("")) != "")
    return kept.select("*", normalize_error(col(errors_col)).alias("error"))


def error_type_counts(failures: DataFrame, errors_col: str = "errors",
                      by: Sequence[str] = ()) -> DataFrame:
    """A2: rows per normalised error type (and per ``by`` columns)."""
    t = error_types(failures.select(*[col(b) for b in by], col(errors_col))
                    if errors_col in failures.columns else failures, errors_col)
    return t.groupBy(*[col(b) for b in by], "error").agg(F.count(F.lit(1)).alias("n"))


def most_common(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Errors by count, descending; ties by text so the order is stable."""
    return counts.orderBy(*[col(b) for b in by], F.desc("n"), F.asc("error"))


def failure_totals(failures: DataFrame, imports: DataFrame, stem: str = "stem") -> DataFrame:
    """A3 + J10: per failure stem, rows in the import file and rows failed.

    A failure file without an import partner is reported (``missing_import``,
    ``rows_to_import`` null), not analysed against anything.  Both sides are
    counted before the join, so the join sees one row per stem.
    """
    f = failures.groupBy(col(stem).alias("stem")).agg(F.count(F.lit(1)).alias("rows_failed"))
    i = imports.groupBy(col(stem).alias("__istem")).agg(F.count(F.lit(1)).alias("rows_to_import"))
    j = f.join(i, f["stem"] == i["__istem"], "left")
    return j.select(
        "stem", "rows_to_import", "rows_failed",
        F.when(F.col("__istem").isNull(), F.lit("missing_import")).otherwise(F.lit("paired"))
        .alias("partner"))


def folder_totals(files: DataFrame, row_counts: DataFrame) -> DataFrame:
    """A3 + J10 from a listing: every failure file with its rows and those of its import file.

    ``files``: path, folder, stem, kind; ``row_counts``: path, n, of files that
    have rows.  A file without rows counts zero; a failure file whose import
    file is not listed beside it is ``missing_import``.  Part files of one
    folder are one file.
    """
    bare = F.regexp_replace("path", "^file:/*", "/")
    counted = (files.withColumn("__key", bare).join(row_counts.select(bare.alias("__key"), "n"), "__key", "left")
               .where(F.col("kind") != "success").groupBy("folder", "stem")
               .agg(F.sum(F.when(F.col("kind") == "failure", F.coalesce("n", F.lit(0)))).alias("rows_failed"),
                    F.sum(F.when(F.col("kind") == "import", F.coalesce("n", F.lit(0)))).alias("rows_to_import")))
    return counted.where(F.col("rows_failed").isNotNull()).select(
        "folder", "stem", "rows_to_import", "rows_failed",
        F.when(F.col("rows_to_import").isNull(), F.lit("missing_import")).otherwise(F.lit("paired")).alias("partner"))


def analyse_folder(spark, folder: str, by_folder: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The reference's folder mode on landed outcome files.

    Returns ``(totals, error_counts, missing)``: A3 per failure file, A2 per
    stem, and failure files whose import file is absent.  Folders below
    ``folder`` (one an import, say) are analysed each by itself;
    ``by_folder`` names them in the results.
    """
    from shiftkit.sources.files import read_outcome_folder
    files, failures, row_counts = read_outcome_folder(spark, folder)
    totals = folder_totals(files, row_counts)
    keys = ["folder", "stem"] if by_folder else ["stem"]
    paired = failures.join(totals.where(F.col("partner") == "paired").select("folder", "stem"), ["folder", "stem"], "left_semi")
    counts = error_type_counts(paired, by=keys)
    missing = totals.where(F.col("partner") == "missing_import").select(*keys)
    return totals if by_folder else totals.drop("folder"), counts, missing


def analyse_pair(spark, import_file: str, failure_file: str) -> tuple[DataFrame, DataFrame]:
    """The single-pair mode: totals of one import and one failure file, and the failure file's error types.

    The two need not be named alike; a file that cannot be read has no total.
    """
    from shiftkit.sources.files import read_by_layout, scan_headers_of
    from shiftkit.sources.listing import literal
    from shiftkit.sources.records import read_records
    both = spark.createDataFrame([("import", import_file), ("failure", failure_file)], "kind string, path string")
    heads = scan_headers_of(spark, both)
    readable = {r["path"] for r in heads.where(F.col("headers").isNotNull()).select("path").collect()}      # at most the two
    n = [read_records(spark, literal(p)).where("not first").count() if p in readable else None for p in (import_file, failure_file)]
    totals = spark.createDataFrame([tuple(n)], "rows_to_import long, rows_failed long")
    if failure_file not in readable:
        return totals, spark.createDataFrame([], "error string, n long")
    found = read_by_layout(spark, heads.where(F.col("path") == failure_file), literal(failure_file))
    return totals, error_type_counts(found.select(F.try_element_at("values", F.lit("errors")).alias("errors")))
