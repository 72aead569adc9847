"""Quoted CSV read by many tasks: record boundaries by quote parity.

Spark's CSV source reads a file with line breaks inside quotes as one piece.
Here the text source cuts files into byte ranges and gives each range the
lines that start in it.  A line break ends a record if an even number of
quotes stands before it in its file, so

1. one pass counts the quotes of each range;
2. a prefix XOR over the ranges of a file says which of them start inside a
   quoted field, a table of one row for each such range;
3. a second pass joins the lines of each range to records, in tasks, from its
   known start.  What is left at the two ends of a range, at most two
   fragments, is landed and joined to that of its neighbours;
4. the whole records are read, and Spark's ``from_csv`` parses the records.

Quotes are taken to be written as CSV writers do: around a whole field, and
doubled within.  Records end with LF or CRLF.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftkit.session import shared_dir, ship_package

#: Ranges that start inside quotes, up to which their table is broadcast (some 100 bytes each).
BROADCAST_RANGES = 50_000
_FRAGMENTS = "file string, block long, at int, record string, whole boolean, first boolean"


def _lines(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def inside_quotes(lines: DataFrame) -> DataFrame:
    """``file``, ``block`` of the ranges that start inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    parity = lines.groupBy("file", "block").agg(F.bit_xor(quotes % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return parity.withColumn("inside", F.sum("odd").over(before) % 2).where("inside = 1").select("file", "block")


def _joined(texts: pa.Array, ends: np.ndarray) -> tuple[pa.Array, int]:
    """Lines up to each end (inclusive) joined by line breaks; lines left over."""
    cuts = np.concatenate([[0], np.flatnonzero(ends) + 1])
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), texts.slice(0, int(cuts[-1])))
    return pc.binary_join(lists, "\n"), len(texts) - int(cuts[-1])


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each range, and its open ends: at 0 what belongs to the record before, at 1 the start of a last one."""
    def out(key, at, records, whole):
        nonlocal begun
        n = len(records)
        begins = np.zeros(n, bool)
        if whole and not begun and key[1] == 0:              # a file's first record that is not blank
            filled = np.array(pc.not_equal(pc.utf8_trim(records, " \r"), ""))
            if filled.any():
                begins[filled.argmax()] = begun = True
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n, pa.string()), pa.array(np.full(n, key[1])), pa.array(np.full(n, at, np.int32)),
             records.cast(pa.string()), pa.array(np.full(n, whole)), pa.array(begins)],
            names=["file", "block", "at", "record", "whole", "first"])

    key, held, odd, opening, begun = None, [], False, False, False

    def close():
        if begun and key[1] == 0:                            # the file's first record is among the whole ones
            yield out(key, -1, pa.array([""]), False)
        # A range that starts and ends inside one record is only a head.
        if held:
            yield out(key, 0 if opening else 1, pa.array(["\n".join(held)]), False)

    for b in batches:
        if not b.num_rows:
            continue
        files, blocks = b.column("file"), np.array(b.column("block"))
        names = np.array(files.dictionary_encode().indices)
        edges = np.concatenate([[0], np.flatnonzero((names[1:] != names[:-1]) | (blocks[1:] != blocks[:-1])) + 1, [b.num_rows]])
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            this = (files[lo].as_py(), int(blocks[lo]))
            if this != key:
                yield from close()
                key, held = this, []
                odd = opening = b.column("inside")[lo].as_py()
                begun = False
            texts = b.column("value").slice(lo, hi - lo)
            state = (np.cumsum(np.array(pc.count_substring(texts, '"'))) + odd) % 2
            ends = state == 0
            odd = bool(state[-1])
            if not ends.any():
                held.extend(texts.to_pylist())
                continue
            if held or opening:
                first = int(np.argmax(ends))
                text = pa.array(["\n".join([*held, *texts.slice(0, first + 1).to_pylist()])])
                yield out(key, 0, text, not opening)
                held, opening = [], False
                texts, ends = texts.slice(first + 1), ends[first + 1:]
            records, left = _joined(texts, ends)
            if len(records):
                yield out(key, 0, records, True)
            held = texts.slice(len(texts) - left).to_pylist()
    yield from close()


def read_records(spark: SparkSession, path: str | list[str], glob: str | None = None,
                 broadcast_ranges: int = BROADCAST_RANGES) -> DataFrame:
    """(file, record, first) of all CSV records below ``path``; ``first`` marks each file's first record.

    ``file`` is the path as Spark encodes it.  Blank lines between records
    are left out, as CSV readers do, also before the first.
    """
    ship_package(spark)
    lines = _lines(spark, path, glob)
    starts = shared_dir(spark, "csv-ranges")
    inside_quotes(lines).write.parquet(starts)
    starts = spark.read.schema("file string, block long").parquet(starts).withColumn("inside", F.lit(True))
    if starts.limit(broadcast_ranges + 1).count() <= broadcast_ranges:
        marked = lines.join(F.broadcast(starts), ["file", "block"], "left")
    else:
        # Beyond that, ranges meet their start in a shuffle and lines are put back in order.
        marked = (lines.withColumn("line", F.monotonically_increasing_id()).join(starts.hint("merge"), ["file", "block"], "left")
                  .sortWithinPartitions("file", "block", "line"))
    marked = marked.select("file", "block", F.coalesce("inside", F.lit(False)).alias("inside"), "value")
    parts = marked.mapInArrow(_assemble, _FRAGMENTS)
    whole = parts.where("whole").select("file", "record", "first")
    # Open ends, a few rows a range, are landed: a tail begins a record, heads up to the next tail go on with it.
    at = shared_dir(spark, "csv-ends")
    parts.where("not whole").write.parquet(at)
    ends = spark.read.schema(_FRAGMENTS).parquet(at)
    order = Window.partitionBy("file").orderBy("block", "at")
    chained = ends.where("at >= 0").withColumn("chain", F.sum("at").over(order))
    stitched = chained.groupBy("file", "chain").agg(
        F.min("block").alias("block"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "record"))),
                                                                lambda x: x["record"]), "\n").alias("record"))
    # The first record of a file crosses a range only if its first range holds nothing else.
    begun = ends.where("at < 0").select("file", F.lit(True).alias("begun"))
    opening = stitched.withColumn("n", F.row_number().over(Window.partitionBy("file").orderBy("block")))
    opening = opening.join(begun, "file", "left").select(
        "file", "record", (F.col("begun").isNull() & (F.col("n") == 1) & (F.col("block") == 0)).alias("first"))
    both = whole.unionByName(opening)
    return both.where(F.trim(F.replace("record", F.lit("\r"), F.lit(""))) != "").withColumn(
        "record", F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record")))


def csv_fields(record: Column, width: int) -> Column:
    """The first ``width`` fields of a record as an array of strings; empty fields are null."""
    schema = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(width)])
    row = F.from_csv(record, schema.simpleString()[len("struct<"):-1].replace(":", " "), _OPTIONS)
    return F.array(*[row[f"f{i}"] for i in range(width)])


_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "maxCharsPerColumn": "-1", "emptyValue": "", "nullValue": ""}


def read_split_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None, glob: str | None = None) -> DataFrame:
    """S1 for large files: header-bearing CSVs of one layout as an all-string table, each file read by many tasks.

    Equal to ``read_object_csv`` with its ``multiline``, whose header also gives
    the column names unless ``columns`` does.
    """
    if columns is None:
        from shiftkit.sources.files import read_object_csv
        columns = read_object_csv(spark, path).columns
    records = read_records(spark, path, glob).where("not first")
    fields = records.select(csv_fields(F.col("record"), len(columns)).alias("f"))
    return fields.select(*[F.col("f")[i].alias(c) for i, c in enumerate(columns)])
