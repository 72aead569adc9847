"""Versions of an object table in hash buckets (K2, copy on write).

A version is a manifest: for each bucket of the id's hash, the folder that
holds its rows.  Applying a change set reads and rewrites only the buckets
that the set's ids fall into; the new manifest names the new folders for
these and the old ones for all others.  So a set of 24 rows on a table of
any size rewrites at most 24 buckets.  Manifests are only added: a version
that was read stays as it was, and a version exists once its manifest is
there, written in one step after its data.

    <root>/data/<write>/bucket=<n>/...      rows, written once, never changed
    <root>/versions/<number>/...            manifest: bucket, folder
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftkit.functions.names import col
from shiftkit.plans.changes import apply_change_set, change_results

_MANIFEST = "bucket int, folder string, id_col string, buckets int, schema string"


class VersionStore:
    """The versions of one object table below ``root``.

    ``buckets`` and ``id_col`` are fixed by the first version.  Ids are
    bucketed by their text, so a change set may hold them as text.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- manifests --------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        """Numbers of the versions that exist, ascending (one for each change set applied)."""
        fs, p = self._fs(f"{self.root}/versions")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit())

    def _manifest(self, version: int | None) -> tuple[int, dict[int, str], str, int, T.StructType]:
        number = version if version is not None else max(self.versions(), default=None)
        if number is None:
            raise ValueError(f"no version in {self.root}")
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/versions/{number}").collect()     # one a bucket
        head = rows[0]
        folders = {r["bucket"]: r["folder"] for r in rows if r["bucket"] >= 0}
        return number, folders, head["id_col"], head["buckets"], T.StructType.fromJson(json.loads(head["schema"]))

    def _publish(self, number: int, folders: dict[int, str], id_col: str, buckets: int, schema: T.StructType) -> int:
        """The manifest is written aside and renamed, so it is there whole or not at all."""
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        text = schema.json()
        rows = [(b, f, id_col, buckets, text) for b, f in sorted(folders.items())] + [(-1, "", id_col, buckets, text)]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(staged)
        fs, target = self._fs(f"{self.root}/versions/{number}")
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(self._fs(staged)[1], target):
            raise RuntimeError(f"version {number} of {self.root} was written by another run")
        return number

    # --- data -------------------------------------------------------------------------

    @staticmethod
    def _bucket(id_col: str, buckets: int):
        return F.pmod(F.xxhash64(col(id_col).cast("string")), F.lit(buckets)).cast("int")

    def _write(self, df: DataFrame, id_col: str, buckets: int, spread: int) -> dict[int, str]:
        """Rows into new bucket folders; returns the folder of each bucket that has rows."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        keyed = df.withColumn("bucket", self._bucket(id_col, buckets))
        keyed.repartition(spread, "bucket").write.partitionBy("bucket").parquet(folder)
        fs, p = self._fs(folder)
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return {int(n.split("=", 1)[1]): f"{folder}/{n}" for n in names if n.startswith("bucket=")}

    def create(self, df: DataFrame, id_col: str = "id", buckets: int = 1_024) -> int:
        """The first version.  Choose ``buckets`` so that one is some 100 MB; at most that many folders are listed."""
        if self.versions():
            raise ValueError(f"{self.root} has versions already")
        spread = min(buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return self._publish(0, self._write(df, id_col, buckets, spread), id_col, buckets, df.schema)

    def _rows(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default."""
        _, folders, _, _, schema = self._manifest(version)
        return self._rows(list(folders.values()), schema)

    def folders(self, version: int | None = None) -> dict[int, str]:
        """The folder of each bucket of a version."""
        return self._manifest(version)[1]

    def hit(self, changes: DataFrame, version: int | None = None) -> tuple[list[int], DataFrame]:
        """Buckets that a change set falls into, and the rows of a version in them."""
        _, folders, id_col, buckets, schema = self._manifest(version)
        hit = sorted(r[0] for r in changes.select(self._bucket(id_col, buckets)).distinct().collect())      # at most ``buckets``
        return hit, self._rows([folders[b] for b in hit if b in folders], schema)

    def results(self, changes: DataFrame, operation: str, version: int | None = None) -> DataFrame:
        """``change_results`` of a change set, reading its buckets only."""
        return change_results(self.hit(changes, version)[1], changes, operation, self._manifest(version)[2])

    def apply(self, changes: DataFrame, operation: str, version: int | None = None) -> int:
        """Apply a change set to a version (the newest by default) as :func:`apply_change_set` does; the new version's number."""
        number, folders, id_col, buckets, schema = self._manifest(version)
        hit, rows = self.hit(changes, number)
        after = apply_change_set(rows, changes, operation, id_col)
        spread = max(1, min(len(hit), int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        new = self._write(after, id_col, buckets, spread) if hit else {}
        kept = {b: f for b, f in folders.items() if b not in hit}
        return self._publish(max(self.versions()) + 1, kept | new, id_col, buckets, after.schema)
