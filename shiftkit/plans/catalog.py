"""Catalogue jobs (survey 2.10): C1 export catalogue, C2 import catalogue, C3 load order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.functions.params import (
    columns_display, file_from_params, first_non_blank, object_from_params, second_token,
)


def export_catalog(exports: DataFrame) -> DataFrame:
    """``active, name, status, object, columns`` per configured export."""
    return exports.select(
        "loader_config", "export_pos",
        F.coalesce(F.col("active"), F.lit(1)).alias("active"),
        "name", "status",
        object_from_params("params", ("export",)).alias("object"),
        columns_display("columns").alias("columns"))


def import_catalog(imports: DataFrame) -> DataFrame:
    """``active, name, status, file_path`` per configured import."""
    return imports.select(
        "loader_config", "import_pos",
        F.coalesce(F.col("active"), F.lit(1)).alias("active"),
        "name", "status",
        first_non_blank("file_path", "import_path", file_from_params("params")).alias("file_path"))


def load_order_sheet(imports: DataFrame) -> DataFrame:
    """C3 + T5: one row per import, numbered from 1 in its configuration."""
    return imports.select(
        (F.col("import_pos") + 1).alias("LoadOrderNr"),
        file_from_params("params").alias("LoaderFileName"),
        second_token("params").alias("ObjectType"),
        F.col("business_object_type").alias("Business ObjectType"),
        F.col("referenced_objects").alias("ReferencedObject(s)"),
        F.coalesce(F.col("active"), F.lit(1)).alias("Load is Active"),
        F.col("status").alias("FunctionStatus"),
        F.col("loader_config").alias("LoaderConfig"),
        F.col("base_import_path").alias("BaseImportPath"))


def import_report(imports: DataFrame) -> DataFrame:
    """C2 as the report writes it: members as they stand in the configuration, blank where it has none."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return imports.select("loader_config", "import_pos", *[written(c) for c in ("active", "name", "status", "file_path")])


def load_order_report(imports: DataFrame) -> DataFrame:
    """C3 as the workbook has it: referenced objects are left blank for the user, the active flag is as written."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return imports.select(
        (F.col("import_pos") + 1).alias("LoadOrderNr"), file_from_params("params").alias("LoaderFileName"),
        blank(second_token("params")).alias("ObjectType"), blank(F.col("business_object_type")).alias("Business ObjectType"),
        F.lit("").alias("ReferencedObject(s)"), blank(F.col("active")).alias("Load is Active"),
        blank(F.col("status")).alias("FunctionStatus"), F.col("loader_config").alias("LoaderConfig"),
        F.col("base_import_path").alias("BaseImportPath"))
