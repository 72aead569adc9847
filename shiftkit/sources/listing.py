"""Listings as frames (S5): a folder tree listed by tasks, level by level.

No list of paths passes the driver: the folders of a level are a frame, tasks
list them, what they find is landed, and its folders are the next level.
Paths are as the file system names them, blanks and brackets included (Spark's
``_metadata.file_path`` and ``inputFiles`` are percent-encoded), and files
without bytes are listed like all others.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftkit.session import shared_dir, ship_package

_ENTRY = "path string, modificationTime timestamp, length long, folder boolean"


def decoded(path: Column | str) -> Column:
    """A percent-encoded path (``_metadata.file_path``, ``file_name``) as the file system names it."""
    c = F.col(path) if isinstance(path, str) else path
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def literal(path: str) -> str:
    """A path for Spark's readers, which would take brackets, braces and stars in it for patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_system(path: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, path in it, what to put before its paths) of a path or URI; nothing in it is decoded."""
    if "://" in path and not path.startswith("file:"):
        scheme, rest = path.split("://", 1)
        host = rest.split("/", 1)[0]
        filesystem, _ = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
        # Object stores take the bucket as part of the path, others only what follows the host.
        inner = rest if scheme in ("s3", "s3a", "gs", "gcs", "abfs", "abfss") else rest[len(host):]
        return filesystem, inner, path[:len(path) - len(inner)]
    bare = path[len("file:"):] if path.startswith("file:") else path
    return pafs.LocalFileSystem(), "/" + bare.lstrip("/"), "file:"


def _listed(glob: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for folder in pdf["path"]:
                filesystem, inner, before = file_system(folder)
                rows = []
                for info in filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True)):
                    name = info.base_name
                    if name.startswith((".", "_")):          # as Spark's own listings leave out
                        continue
                    is_folder = info.type == pafs.FileType.Directory
                    if is_folder or fnmatch.fnmatchcase(name, glob):
                        at = info.mtime if info.mtime is not None else datetime.fromtimestamp(0, timezone.utc)
                        rows.append((before + info.path, at, -1 if is_folder else info.size, is_folder))
                if rows:
                    yield pd.DataFrame(rows, columns=["path", "modificationTime", "length", "folder"])
    return run


def list_tree(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``(path, modificationTime, length)`` of all files below ``root`` whose name fits ``glob``.

    One job a level of the tree; names that start with ``_`` or ``.`` are left
    out.  A root that is not there has no files.
    """
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string")
    found = None
    while True:
        at = shared_dir(spark, "listing")
        folders.mapInPandas(_listed(glob), _ENTRY).write.parquet(at)
        level = spark.read.schema(_ENTRY).parquet(at)
        files = level.where("not folder").drop("folder")
        found = files if found is None else found.unionByName(files)
        folders = level.where("folder").select("path")
        if folders.isEmpty():
            return found
        folders = folders.repartition(n, "path")
