"""File sources: object CSVs (S1), CSV header scans (S2), listings.

Object tables are header-bearing CSV files whose every column is text: keys
such as ``007`` must not become numbers, so nothing is inferred.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftkit.functions.names import col
from shiftkit.functions.text import trim_ws
from shiftkit.functions.params import FAILURE_SUFFIX, SUCCESS_SUFFIX, file_intent, file_name_of, outcome_stem, relative_dir
from shiftkit.sources.listing import decoded, file_system, list_tree, literal
from shiftkit.sources.records import csv_fields, read_records

# The text tokens pandas reads as missing by default (used with
# ``na="pandas"``; Spark's CSV reader alone only treats the empty field so).
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Encodings tried in order when a header is not valid UTF-8.
HEADER_ENCODINGS = ("utf-8", "utf-8-sig", "latin-1")


def read_object_csv(spark: SparkSession, path: str | list[str], na: str = "empty",
                    with_file: bool = False, multiline: bool = True) -> DataFrame:
    """Header-bearing CSV(s) as an all-string table.

    Quoted fields may hold commas, quotes (``""``) and newlines.  ``na``:
    ``"empty"`` makes only empty fields null, ``"pandas"`` also the pandas
    missing-value tokens.  ``with_file`` adds ``_file`` (the file name).

    ``multiline=True`` is needed for newlines inside quotes, but then a file
    cannot be split and is read by one task: parallelism comes from the
    number of files (exports are one file per object and instance).  A single
    very large export is read by many tasks with ``records.read_split_csv``,
    or, without embedded newlines, with ``multiline=False``.
    """
    df = (spark.read.option("header", True).option("multiLine", multiline)
          .option("quote", '"').option("escape", '"').option("inferSchema", False)
          .option("encoding", "UTF-8").option("mode", "PERMISSIVE")
          .csv(path))
    if with_file:
        df = df.select("*", decoded("_metadata.file_name").alias("_file"))
    if na == "pandas":
        df = df.select(*[F.when(~col(c).isin(list(PANDAS_NA_TOKENS)), col(c)).alias(c)
                         if c != "_file" else col(c) for c in df.columns])
    return df


def list_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """``(path, modificationTime, length)`` of the files under ``root``.

    The binary-file source is used for its listing only; selecting no
    ``content`` means no file is opened.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower())
            .load(root).select("path", "modificationTime", "length"))


def latest_file(listing: DataFrame, name_like: str | None = None) -> DataFrame:
    """The newest file (by modification time), optionally of a name pattern."""
    x = listing
    if name_like:
        x = x.where(file_name_of("path").like(name_like))
    newest = F.max(F.struct("modificationTime", "path"))          # files of one time: the last path
    return x.agg(newest.alias("f")).select("f.path", "f.modificationTime")


# --- S2: header scan -----------------------------------------------------------

HEADER_SCAN_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("headers", T.ArrayType(T.StringType())),
    T.StructField("encoding", T.StringType()),
    T.StructField("error", T.StringType()),
])

_HEAD_BYTES = 1 << 16
_BLANK = re.compile(rb"[ \t]*(?:\r\n|\n|\r(?!$))")
_IN_FIELD = re.compile(rb"[\r\n]|(?<=,)\"")


class HeaderFinder:
    """Finds the end of a CSV file's first record in bytes that come piece by piece.

    Records end with LF, CR or both; lines of blanks before the first record
    are skipped.  A quote opens a quoted field only at a field's start, there
    line ends are text and a doubled quote is one.  Every byte is looked at
    once, by searches for the next byte that matters.
    """

    def __init__(self):
        self.data, self.at, self.start, self.quoted = bytearray(), 0, None, False

    def feed(self, piece: bytes, last: bool = False) -> bytes | None:
        """The first record with its line end, once it is whole (or at the end of the file); '' if there is none."""
        self.data += piece
        data = self.data
        if self.start is None:
            skip = 3 if data.startswith(b"\xef\xbb\xbf") else 0
            at = max(self.at, skip)
            while m := _BLANK.match(data, at):
                at = m.end()
            self.at = at
            rest = data[at:].lstrip(b" \t\r\n") if len(data) - at < 1 << 20 else b"x"
            if not rest:
                return b"" if last else None
            if not last and len(data) - at < 2:
                return None
            self.start = at
            self.quoted = data[at:at + 1] == b'"'
            self.at = at + self.quoted
        while True:
            if self.quoted:
                at = data.find(b'"', self.at)
                if at < 0:
                    self.at = len(data)
                    break
                if at + 1 == len(data) and not last:
                    self.at = at                              # the next byte says whether it is doubled
                    break
                self.quoted = False
                self.at = at + 1
                if data[at + 1:at + 2] == b'"':
                    self.quoted, self.at = True, at + 2
                continue
            m = _IN_FIELD.search(data, self.at)
            if m is None:
                self.at = len(data)
                break
            if m[0] == b'"':
                self.quoted, self.at = True, m.end()
                continue
            end = m.end()
            if m[0] == b"\r":
                if end == len(data) and not last:
                    self.at = m.start()
                    break
                end += data[end:end + 1] == b"\n"
            return bytes(data[self.start:end])
        return bytes(data[self.start:]) if last else None


def read_header(path: str) -> tuple[list[str] | None, str | None, str | None]:
    """Header of one CSV file, decoded like the reference: UTF-8 first, then fallbacks.

    Reads the file only up to the end of its first record (which may span
    lines inside quotes), in pieces that grow with what was read, so a record
    of many MB is read and searched once.  Returns ``(headers, encoding, error)``.
    Empty header cells are named ``Unnamed: i`` and repeats ``name.1``, ``name.2``
    (pandas conventions, which the inventory reproduces).
    """
    finder, size = HeaderFinder(), _HEAD_BYTES
    try:
        filesystem, inner, _ = file_system(path)
        with filesystem.open_input_stream(inner) as stream:
            while True:
                piece = stream.read(size)
                head = finder.feed(piece, last=not piece)
                if head is not None:
                    break
                size = min(2 * size, 1 << 24)
    except Exception as exc:  # unreadable file
        return None, None, str(exc)
    rec = enc = None
    for candidate in HEADER_ENCODINGS:
        try:
            text = head.decode(candidate)
        except UnicodeDecodeError:
            continue
        if candidate == "utf-8" and text.startswith("\ufeff"):
            text = text[1:]
        limit = csv.field_size_limit(sys.maxsize)
        try:
            rec, enc = next(csv.reader(io.StringIO(text, newline="")), None), candidate
        finally:
            csv.field_size_limit(limit)
        break
    if not rec or all(not c.strip() for c in rec) and len(rec) <= 1:
        return None, None, "No columns to parse from file"
    names: list[str] = []
    seen: dict[str, int] = {}
    for i, h in enumerate(rec):
        name = h if h != "" else f"Unnamed: {i}"
        if name in seen:
            seen[name] += 1
            name = f"{name}.{seen[name]}"
        else:
            seen[name] = 0
        names.append(name)
    return names, enc, None


def _scan_heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = [read_header(p) for p in pdf["path"]]
        yield pd.DataFrame({
            "path": pdf["path"].values,
            "headers": [h for h, _, _ in out],
            "encoding": [e for _, e, _ in out],
            "error": [x for _, _, x in out],
        })


def scan_headers_of(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """S2 on a listing (column ``path``): header reads spread over tasks, each of its files' first record only."""
    from shiftkit.session import ship_package
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return listing.select("path").repartition(n, "path").mapInPandas(_scan_heads, HEADER_SCAN_SCHEMA)


def scan_csv_headers(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """One row per CSV file under ``root`` with its raw header list.

    The listing is a frame (:func:`shiftkit.sources.listing.list_tree`), empty
    files included.  Files that cannot be read (e.g. empty) carry ``error``
    and no headers.
    """
    return scan_headers_of(spark, list_tree(spark, root, glob))


def header_long_form(scan: DataFrame, root: str) -> DataFrame:
    """S2 -> long form ``(relative_path, filename, file_intent, header)``.

    Headers are stripped, blanks dropped, repeats removed.  A file whose
    header is all blank has no rows here.
    """
    base = scan.where(F.col("error").isNull()).select(
        relative_dir("path", root).alias("relative_path"),
        file_name_of("path").alias("filename"),
        file_intent(file_name_of("path")).alias("file_intent"),
        F.explode(F.array_distinct(F.filter(F.transform("headers", trim_ws),
                                            lambda h: h != ""))).alias("header"))
    return base


def failed_files(scan: DataFrame) -> DataFrame:
    """S2 side output: files whose header could not be read, with the reason."""
    return scan.where(F.col("error").isNotNull()).select("path", "error")


# --- outcome folders -----------------------------------------------------------

def outcome_name(path: str) -> Column:
    """The loader-level file name of a path: the file itself, or the folder that
    holds Spark's part files (``x_FAILURE.csv/part-0.csv``, also as a
    ``key=x_FAILURE.csv`` partition folder)."""
    name = file_name_of(path)
    folder = F.substring_index(F.substring_index(F.substring_index(path, "/", -2), "/", 1), "=", -1)
    return F.when(name.startswith("part-"), folder).otherwise(name)


def _outcome_folder(path: str) -> Column:
    """The folder that an outcome file stands in."""
    up = F.when(file_name_of(path).startswith("part-"), 2).otherwise(1)
    return F.array_join(F.slice(F.split(path, "/"), F.lit(1), F.size(F.split(path, "/")) - up), "/")


def outcome_files(listing: DataFrame) -> DataFrame:
    """``path, folder, file, stem, kind`` (import, failure, success) of a listing of CSV files."""
    name = outcome_name("path")
    return listing.select(
        "path", _outcome_folder("path").alias("folder"), name.alias("file"),
        F.regexp_replace(outcome_stem(name), r"\.csv$", "").alias("stem"),
        F.when(name.endswith(FAILURE_SUFFIX), "failure").when(name.endswith(SUCCESS_SUFFIX), "success").otherwise("import").alias("kind"))


def read_by_layout(spark: SparkSession, heads: DataFrame, path: str | list[str], glob: str | None = None) -> DataFrame:
    """All rows of CSV files of any layouts in one scan: ``path`` and ``values``, a map by header name.

    ``heads`` (S2: path, headers) is the dictionary of layouts, joined to the
    rows by file; rows of files that it does not hold are left out.  Of equal
    header names in a file the numbered ones (``a.1``) are names of their own.
    """
    from shiftkit.session import shared_dir
    at = shared_dir(spark, "layouts")
    heads.where(F.col("headers").isNotNull()).select("path", "headers").write.parquet(at)
    heads = spark.read.schema("path string, headers array<string>").parquet(at)
    width = heads.agg(F.max(F.size("headers"))).first()[0]             # one number
    if not width:
        return spark.createDataFrame([], "path string, values map<string, string>")
    rows = read_records(spark, path, glob).where("not first").select(decoded("file").alias("__file"), "record")
    bare = lambda c: F.regexp_replace(c, "^file:/*", "/")
    rows = rows.withColumn("__key", bare("__file")).join(heads.withColumn("__key", bare("path")), "__key")
    return rows.select("path", F.map_from_arrays("headers", F.slice(csv_fields(F.col("record"), width), F.lit(1), F.size("headers"))).alias("values"))


def read_failure_files(spark: SparkSession, listing: DataFrame, path: str | list[str], glob: str | None = "*.csv") -> DataFrame:
    """Rows ``(path, folder, stem, file, errors)`` of the listed ``*_FAILURE.csv`` files, below ``path``.

    Failure files of different loads have different columns; all are read in
    one scan, whatever the number of layouts.
    """
    files = outcome_files(listing).where("kind = 'failure'")
    rows = read_by_layout(spark, scan_headers_of(spark, files), path, glob)
    return rows.join(files, "path").select("path", "folder", "stem", "file", F.try_element_at("values", F.lit("errors")).alias("errors"))


def read_outcome_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of an outcome folder: its files (:func:`outcome_files`), the rows of its
    failure files, and rows per import file (``path, n``).

    Import files are only counted.  Files and Spark-written folders of the
    same name are both understood.
    """
    listing = list_tree(spark, folder, "*.csv")
    files = outcome_files(listing)
    failures = read_failure_files(spark, listing, literal(folder))
    counts = (read_records(spark, literal(folder), "*.csv").where("not first").groupBy(decoded("file").alias("path"))
              .agg(F.count(F.lit(1)).alias("n")))
    return files, failures, counts


def missing_inputs(expected: DataFrame, listing: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Required file names absent from a listing (``left_anti`` on the name)."""
    have = listing.select(file_name_of("path").alias("__have"))
    return expected.join(have, col(name_col) == F.col("__have"), "left_anti")
