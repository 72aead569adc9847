"""Embedding near-duplicates by randomised-rotation binary codes.

A vector is rotated by a fixed random rotation and kept as the signs of its
coordinates with the correction factor c = <code, vector>, the cosine between
the vector and its code.  <code, other> / c estimates the inner product with
another vector without bias; the residual gives a bound that only chance of
about 1e-10 exceeds, and the angle between code and vector a bound that
nothing exceeds.  Pairs whose lower upper bound reaches the threshold are
recomputed in double precision; all others are done.

Which pairs are looked at: each label is cut into cells by fixed random
directions.  A vector is at home in the cell of the direction nearest to it
and a guest in those almost as near, with a margin that follows from the
threshold, so that a pair at the threshold meets in one of the two homes (measured: 99.9 %
at cosine 0.93, all from 0.95 on).  Large cells are cut into blocks, so no
task holds more than a block pair, and only links are counted, never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.llm.common import components, landed, table
from shiftkit.session import ship_package

THRESHOLD = 0.93
DIRECTIONS = 256
#: Margin in standard deviations of the difference of two directions' products within a linked pair.
MARGIN = 1.8
#: Standard deviations of the estimate's error that its upper bound allows for.
CONFIDENCE = 6.5
#: Vectors at home, and vectors they are held against, in one unit of work.
HOMES, MEMBERS = 512, 1_024
SEED = 20_240_601
_NO_ID = 1 << 62


class Codes:
    """Rotation and directions for one dimension; a function of the dimension and SEED alone."""

    def __init__(self, dim: int):
        rng = np.random.default_rng([SEED, dim])
        q, r = np.linalg.qr(rng.normal(size=(dim, dim)))
        self.dim, self.rotation = dim, q * np.sign(np.diag(r))
        g = rng.normal(size=(DIRECTIONS, dim))
        self.directions = g / np.linalg.norm(g, axis=1, keepdims=True)

    def rotated(self, x: np.ndarray) -> np.ndarray:
        return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ self.rotation

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sign bits, correction factors) of vectors."""
        y = self.rotated(x)
        return np.packbits(y >= 0, axis=1), np.abs(y).sum(1) / np.sqrt(self.dim)

    def cells(self, x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(home, mask of the cells visited) of vectors."""
        p = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ self.directions.T
        margin = MARGIN * np.sqrt(2 * (2 - 2 * threshold) / self.dim)
        return p.argmax(1), p >= p.max(1, keepdims=True) - margin

    def upper(self, bits: np.ndarray, c: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products of coded vectors with rotated unit vectors ``y``."""
        sign = np.unpackbits(bits, axis=1, count=self.dim).astype(np.float32) * 2 - 1
        dot = np.clip(sign @ y.T.astype(np.float32) / np.sqrt(self.dim), -1, 1)
        c = np.clip(c, 1e-6, 1)[:, None]
        estimate = dot / c
        chance = estimate + CONFIDENCE * np.sqrt((1 - c * c) / (c * c) / max(1, self.dim - 1))
        sure = np.cos(np.maximum(0, np.arccos(dot) - np.arccos(c)))
        return np.minimum(chance, sure) + 1e-4       # for single precision


_CODES: dict[int, Codes] = {}


def codes(dim: int) -> Codes:
    if dim not in _CODES:
        _CODES[dim] = Codes(dim)
    return _CODES[dim]


def encoded(classes: DataFrame, threshold: float) -> DataFrame:
    """(id, label, dim, m, vec, bits, c, home, cells) of (id, label, dim, m, embedding) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.array(b.column("dim"))
            emb = b.column("embedding")
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = b.take(pa.array(at))
                x = part.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)
                raw = x.astype(np.float32) if pa.types.is_float32(emb.type.value_type) else x
                bits, c = codes(int(dim)).encode(x)
                home, mask = codes(int(dim)).cells(x, threshold)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in ("id", "label", "dim", "m")], pa.array([v.tobytes() for v in raw], pa.binary()),
                     pa.array([v.tobytes() for v in bits], pa.binary()), pa.array(c), pa.array(home.astype(np.int32)),
                     pa.array([np.flatnonzero(r).astype(np.int32) for r in mask], pa.list_(pa.int32()))],
                    names=["id", "label", "dim", "m", "vec", "bits", "c", "home", "cells"])

    label = classes.schema["label"].dataType.simpleString()
    return classes.mapInArrow(run, f"id long, label {label}, dim int, m long, vec binary, bits binary, c double, home int, cells array<int>")


def _units(vectors: DataFrame) -> DataFrame:
    """Vectors dealt to units of work: a block of a cell's homes and a block of its members."""
    key = ["label", "dim", "cell"]
    members = vectors.withColumn("cell", F.explode("cells"))
    sizes = landed(members.groupBy(*key).agg(
        F.ceil(F.count(F.lit(1)) / MEMBERS).alias("nb"),
        F.greatest(F.lit(1), F.ceil(F.sum((F.col("home") == F.col("cell")).cast("int")) / HOMES)).alias("na")), "dup-cells")
    rows = members.join(sizes, key)
    mine_a, mine_b = F.pmod(F.xxhash64("id"), F.col("na")), F.pmod(F.xxhash64("id", F.lit(5)), F.col("nb"))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    spots = F.transform(every("na"), lambda a: F.struct(a.alias("a"), mine_b.alias("b"), F.lit(False).alias("at_home")))
    homes = F.transform(every("nb"), lambda b: F.struct(mine_a.alias("a"), b.alias("b"), F.lit(True).alias("at_home")))
    both = F.when(F.col("home") == F.col("cell"), F.concat(spots, homes)).otherwise(spots)
    return rows.withColumn("spot", F.explode(both)).select(*key, "spot.a", "spot.b", "spot.at_home", "id", "m", "vec", "bits", "c", "home", "cells")


def _partial_links(units: DataFrame, threshold: float, wide: bool) -> DataFrame:
    """(id, n, root): links found in a unit, and the smallest id it reaches there."""
    kind = np.float64 if wide else np.float32
    cols = ["at_home", "id", "m", "vec", "bits", "c", "home", "cells"]

    def solve(dim: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(parts).combine_chunks()
        at_home = np.array(t["at_home"])
        h, o = np.flatnonzero(at_home), np.flatnonzero(~at_home)
        if not len(h) or not len(o):
            return None
        ids, m, home = np.array(t["id"]), np.array(t["m"]), np.array(t["home"])
        x = np.frombuffer(b"".join(t["vec"].to_pylist()), kind).reshape(-1, dim).astype(np.float64)
        bits = np.frombuffer(b"".join(t["bits"].to_pylist()), np.uint8).reshape(len(ids), -1)
        up = codes(dim).upper(bits[h], np.array(t["c"])[h], codes(dim).rotated(x[o]))
        visits = np.zeros((len(h), DIRECTIONS), bool)
        for i, c in enumerate(t["cells"].take(pa.array(h)).to_pylist()):
            visits[i, c] = True
        # A pair that also meets in the other's home is counted where the smaller id is at home.
        mine = (ids[h][:, None] < ids[o][None, :]) | ((ids[h][:, None] != ids[o][None, :]) & ~visits[:, home[o]])
        i, j = np.nonzero((up >= threshold) & mine)
        i, j = h[i], o[j]
        norm = np.linalg.norm(x, axis=1)
        cos = np.concatenate([np.einsum("ij,ij->i", x[i[k:k + 65536]], x[j[k:k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0)])
        ok = cos / (norm[i] * norm[j]) >= threshold if len(i) else np.zeros(0, bool)
        i, j = i[ok], j[ok]
        if not len(i):
            return None
        known, at = np.unique(np.concatenate([ids[i], ids[j]]), return_inverse=True)
        a, b = at[:len(i)], at[len(i):]
        n = np.bincount(a, m[j], len(known)) + np.bincount(b, m[i], len(known))
        root = np.arange(len(known))
        while True:
            old = root.copy()
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
            if (root == old).all():
                break
        return pa.RecordBatch.from_arrays([pa.array(known), pa.array(n.astype(np.int64)), pa.array(known[root])], names=["id", "n", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts = None, []
        for b in batches:
            if not b.num_rows:
                continue
            unit = np.array([b.column(c).to_numpy(zero_copy_only=False) for c in ("group", "dim", "cell", "a", "b")])
            edge = np.concatenate([[0], np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(0)) + 1, [b.num_rows]])
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                u = tuple(unit[:, lo])
                if last is not None and u != last:
                    if (r := solve(int(last[1]), parts)) is not None:
                        yield r
                    parts = []
                last = u
                parts.append(b.slice(lo, hi - lo).select(cols))
        if parts and (r := solve(int(last[1]), parts)) is not None:
            yield r

    n = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["group", "dim", "cell", "a", "b"]
    keyed = units.withColumn("group", F.xxhash64("label")).drop("label")
    return keyed.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(run, "id long, n long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label; others are ignored).

    Rows link when their labels are equal and not null, their embeddings have
    the same length and their cosine is at least ``threshold``.  A vector
    that is null, empty, zero or holds null or non-finite components links
    with nothing.  Equal vectors are one class, whose copies link with
    each other; repeated rows are copies too.  A null vec_id takes part under a stand-in
    id and gets a component only if it has a known vec_id in it.
    """
    ship_package(vectors.sparkSession)
    wide = vectors.schema["embedding"].dataType.elementType.simpleString() != "float"
    fine = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select("vec_id", "label", "embedding", F.coalesce(fine, F.lit(False)).alias("fine"),
                          F.xxhash64("label", "embedding").alias("k1"), F.xxhash64("embedding", F.lit(11), "label").alias("k2"))
    rows = rows.withColumn("id", F.coalesce("vec_id", F.lit(_NO_ID) + F.pmod("k1", F.lit(1 << 61))))
    classes = (rows.where("fine").groupBy("k1", "k2").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("m"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
        .select("k1", "k2", "id", "label", F.size("embedding").alias("dim"), "m", "embedding"))
    classes = landed(classes, "dup-classes")
    coded = landed(encoded(classes.select("id", "label", "dim", "m", "embedding"), threshold), "dup-codes")
    found = landed(_partial_links(_units(coded), threshold, wide), "dup-links")
    comp = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    per_class = (classes.select("k1", "k2", "id", "m").join(links, "id", "left").join(comp, "id", "left")
                 .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("component_id", "id").alias("c")))
    out = rows.select("vec_id", "id", "k1", "k2", "fine").join(per_class, ["k1", "k2"], "left")
    comp_id = F.when(F.col("fine"), F.col("c")).otherwise(F.col("id"))
    comp_id = F.when(comp_id < _NO_ID, comp_id)
    return out.select("vec_id", F.when(F.col("fine"), F.col("n")).otherwise(0).cast("long").alias("n_links"),
                      comp_id.alias("component_id"), F.coalesce(F.col("vec_id") == comp_id, F.lit(False)).alias("kept"))


def op1_embedding_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
