"""Vector code compression: product codes learned and assigned in exact integers by limb-split GEMM.

Components become integers floor(256 * x).  Squared distances need only dot
products of parts with codebook entries.  These go through float64 matrix
products, which are exact as long as every sum stays below 2**53: integers
are broken into limbs small enough for that, limbs are multiplied pairwise,
and the products are put together in int64 (in Python's integers where 64
bits would not do).  The nearest entry is then the first smallest, exactly,
whatever order BLAS adds in.

A round is one pass over the vectors: tasks assign, and add up entries by
counts and limb sums, which Spark adds over tasks.  Only codebooks and their
sums, whose size is 64 times the dimension, pass the driver.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftkit.llm.common import landed, table
from shiftkit.session import ship_package

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors multiplied at once.
ROWS = 1_024
_INT64 = 1 << 63


def limb_bits(width: int) -> int:
    """Bits of a limb: ``width`` products of two limbs stay below 2**53."""
    return (52 - max(1, width).bit_length()) // 2


def magnitude(a: np.ndarray) -> int:
    return max(int(a.max()), -int(a.min())) if a.size else 0


def limbs(a: np.ndarray, bits: int, count: int) -> list[np.ndarray]:
    """``count`` limbs, lowest first, as float64; the last carries the sign."""
    low = [((a >> (bits * i)) & ((1 << bits) - 1)).astype(np.float64) for i in range(count - 1)]
    return [*low, (a >> (bits * (count - 1))).astype(np.float64)]


def limb_count(a: np.ndarray, bits: int) -> int:
    return max(1, -(-magnitude(a).bit_length() // bits))


def exact_products(x: np.ndarray, e: np.ndarray, wide: bool) -> np.ndarray:
    """Exact x @ e.T over stacked matrices of integers, in int64, or in Python's integers if ``wide``."""
    bits = limb_bits(x.shape[-1])
    xs, es = (limbs(a, bits, limb_count(a, bits)) for a in (x, e))
    total = np.zeros((*x.shape[:-1], e.shape[-2]), object if wide else np.int64)
    for i, a in enumerate(xs):
        for j, b in enumerate(es):
            p = np.matmul(a, np.swapaxes(b, -1, -2)).astype(np.int64)
            total += (p.astype(object) if wide else p) << (bits * (i + j))
    return total


def integers(raw: np.ndarray) -> np.ndarray:
    """floor(256 * x), exact; Python's integers where 64 bits would not do."""
    scaled = np.floor(raw.astype(np.float64) * SCALE)
    if np.isfinite(scaled).all() and (not scaled.size or np.abs(scaled).max() < 1 << 62):
        return scaled.astype(np.int64)
    return np.array([int(v) * SCALE if v == np.floor(v) else int(np.floor(v * SCALE)) for v in raw.astype(np.float64).ravel().tolist()],
                    object).reshape(raw.shape)


def parted(ints: np.ndarray) -> np.ndarray:
    """(part, row, width) of (row, dimension); a dimension that 16 doesn't divide is filled up with zeros."""
    n, dim = ints.shape
    width = -(-dim // PARTS)
    if width * PARTS != dim:
        ints = np.concatenate([ints, np.zeros((n, width * PARTS - dim), ints.dtype)], axis=1)
    return ints.reshape(n, PARTS, width).transpose(1, 0, 2)


def assign(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, squared distance) of parts (part, row, width) by a codebook (part, entry, width); ties go to the lower index."""
    most = max(magnitude(x), magnitude(book))
    wide = x.dtype == object or book.dtype == object or 4 * max(1, x.shape[-1]) * most * most >= _INT64
    if wide:
        x, book = x.astype(object), book.astype(object)
    d = (book * book).sum(-1)[:, None, :] - 2 * exact_products(x, book, wide)
    code = d.argmin(-1)
    return code, np.take_along_axis(d, code[..., None], -1)[..., 0] + (x * x).sum(-1)


def packed(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, vec) of the rows whose vector is neither null nor holds null or non-finite components."""
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    name = "float" if kind == "float" else "double"
    label = vectors.schema["label"].dataType.simpleString()
    ids = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            emb = b.column("embedding")
            off = np.array(emb.offsets) - emb.offsets[0].as_py()
            flat = emb.flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(np.float32 if name == "float" else np.float64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x) | np.array(flat.is_null()))])
            valid = np.array(emb.is_valid())
            fine = valid & (bad[off[1:]] == bad[off[:-1]])
            keep = np.flatnonzero(fine)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(keep)), b.column("label").take(pa.array(keep)),
                 pa.array((off[1:] - off[:-1])[keep].astype(np.int32)),
                 pa.array([x[off[i]:off[i + 1]].tobytes() for i in keep], pa.binary())], names=["vec_id", "label", "dim", "vec"])

    rows = vectors.select("vec_id", "label", F.col("embedding").cast(f"array<{name}>").alias("embedding"))
    return rows.mapInArrow(run, f"vec_id {ids}, label {label}, dim int, vec binary")


def _kind(vectors: DataFrame):
    return np.float32 if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64


def _chunks(batches: Iterator[pa.RecordBatch], kind) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(dimension, rows, parts) of at most ROWS vectors of one dimension."""
    for b in batches:
        dims = np.array(b.column("dim"))
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            for lo in range(0, len(at), ROWS):
                part = b.take(pa.array(at[lo:lo + ROWS]))
                x = np.frombuffer(b"".join(part.column("vec").to_pylist()), kind).reshape(part.num_rows, int(dim))
                yield int(dim), part, parted(integers(x))


def first_entries(rows: DataFrame, kind) -> dict[int, np.ndarray]:
    """The codebook of each dimension (part, entry, width): the vectors of the 64 smallest ids; null ids last, equal ids by content."""
    w = Window.partitionBy("dim").orderBy(F.col("vec_id").asc_nulls_last(), "vec")
    top = rows.select("dim", "vec_id", "vec").withColumn("r", F.row_number().over(w)).where(F.col("r") <= ENTRIES)
    found = defaultdict(list)
    for r in top.orderBy("dim", "r").collect():              # 64 vectors a dimension
        found[r.dim].append(np.frombuffer(bytes(r.vec), kind))
    return {dim: parted(integers(np.stack(v).reshape(len(v), dim))) for dim, v in found.items()}


def _sums(rows: DataFrame, books: dict[int, np.ndarray], kind) -> DataFrame:
    """(dim, slot, pos, limb, value): counts (pos -1) and limb sums of the parts assigned to each entry, one row a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], np.ndarray] = {}
        for dim, _, x in _chunks(batches, kind):
            book = books[dim]
            slots = PARTS * book.shape[1]
            code, _ = assign(x, book)
            key = (code + np.arange(PARTS)[:, None] * book.shape[1]).ravel()

            def add(pos: int, limb: int, weights: np.ndarray | None) -> None:
                got = np.bincount(key, weights, slots).astype(np.int64)                 # noqa: B023
                old = total.get((dim, pos, limb))                                       # noqa: B023
                total[dim, pos, limb] = got if old is None else old + got               # noqa: B023

            add(-1, 0, None)
            bits = limb_bits(ROWS)
            for pos in range(x.shape[2]):
                column = x[:, :, pos]
                for limb, v in enumerate(signed_limbs(column, bits)):
                    add(pos, limb, v.ravel())
        for (dim, pos, limb), v in total.items():
            at = np.flatnonzero(v)
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, dim, np.int32)), pa.array(at.astype(np.int32)), pa.array(np.full(n, pos, np.int32)),
                 pa.array(np.full(n, limb, np.int32)), pa.array(v[at])], names=["dim", "slot", "pos", "limb", "value"])

    return (rows.mapInArrow(run, "dim int, slot int, pos int, limb int, value long")
            .groupBy("dim", "slot", "pos", "limb").agg(F.sum("value").alias("value")))


def signed_limbs(a: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs of the magnitudes with each number's sign, so that sums over any chunks agree however many limbs each has."""
    sign, left, out = np.where(a < 0, -1, 1), np.abs(a), []
    while True:
        out.append(((left & ((1 << bits) - 1)) * sign).astype(np.float64))
        left = left >> bits
        if not left.any():
            return out


def moved(books: dict[int, np.ndarray], sums: DataFrame) -> dict[int, np.ndarray]:
    """Codebooks after a round: floor of the mean of the parts of each entry; entries without parts stay."""
    bits = limb_bits(ROWS)
    count: dict[tuple[int, int], int] = {}
    value: dict[tuple[int, int, int], int] = defaultdict(int)
    for r in sums.collect():                                 # at most 64 x dimension x limbs
        if r.pos < 0:
            count[r.dim, r.slot] = r.value
        else:
            value[r.dim, r.slot, r.pos] += r.value << (bits * r.limb)
    out = {}
    for dim, book in books.items():
        new = book.astype(object)
        for (d, slot), n in count.items():
            if d == dim:
                part, entry = divmod(slot, book.shape[1])
                for pos in range(book.shape[2]):
                    new[part, entry, pos] = value[d, slot, pos] // n
        out[dim] = new.astype(np.int64) if magnitude(new) < 1 << 62 else new
    return out


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in book.ravel()).encode()).hexdigest()


def fit(rows: DataFrame, kind, rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    books = first_entries(rows, kind)
    for _ in range(rounds):
        books = moved(books, _sums(rows, books, kind))
    return books


def encode(rows: DataFrame, books: dict[int, np.ndarray], kind) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of packed rows; an error beyond 64 bits is null."""
    digests = {dim: digest(b) for dim, b in books.items()}
    ids, label = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, x in _chunks(batches, kind):
            code, dist = assign(x, books[dim])
            error = dist.astype(object).sum(0)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), part.column("label"),
                 pa.array([r.tobytes().hex() for r in code.T.astype(np.uint8)], pa.string()),
                 pa.array([int(v) if v < _INT64 else None for v in error], pa.int64()),
                 pa.array([digests[dim]] * part.num_rows, pa.string())],
                names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    return rows.mapInArrow(run, f"vec_id {ids}, label {label}, code string, error long, codebooks_sha256 string")


def compressed(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, codebooks_sha256 of every vector kept of ``vectors`` (vec_id, embedding, label; others are ignored).

    Rows whose vector is null or holds null or non-finite components are
    dropped.  Each dimension has codebooks of its own, from its own 64
    smallest ids (null ids last, equal ids by content), fewer if there are
    fewer vectors; a dimension that 16 doesn't divide is filled up with
    zeros, an empty vector has code zero and no error.  Repeated rows count
    each.  An empty table gives no rows.
    """
    ship_package(vectors.sparkSession)
    rows = landed(packed(vectors), "codes-vectors")
    return encode(rows, fit(rows, _kind(vectors), rounds), _kind(vectors))


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over equal labels, nulls together; null beyond 64 bits."""
    coded = landed(coded, "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    whole = F.count(F.lit(1)) == F.count("error")
    sums = landed(coded.groupBy("label").agg(F.when(whole, total.try_cast("long")).alias("label_error")), "codes-labels")
    return (coded.join(sums.withColumnRenamed("label", "__label"), F.col("label").eqNullSafe(F.col("__label")))
            .drop("__label"))


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    out = with_label_error(compressed(table(spark, sf_dir, "embeddings")))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _oracle() -> str:
    """DuckDB SQL: integers by part, then assign and move twice, then assign."""
    steps = [f"""
e0 AS (SELECT part, pos, r - 1 AS entry, v FROM x JOIN (
         SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r FROM k) USING (vec_id) WHERE r <= {ENTRIES})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
d{i} AS (SELECT vec_id, x.part, entry, sum((x.v - e.v) * (x.v - e.v)) AS dist
       FROM x JOIN e{i} e ON x.part = e.part AND x.pos = e.pos GROUP BY 1, 2, 3),
a{i} AS (SELECT vec_id, part, entry, dist FROM (
         SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY dist, entry) AS r FROM d{i}) WHERE r = 1)""")
        if i < ROUNDS:
            steps.append(f"""
m{i} AS (SELECT x.part, entry, pos, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{i} USING (vec_id, part) GROUP BY 1, 2, 3),
e{i + 1} AS (SELECT e.part, e.pos, e.entry,
                  CASE WHEN n IS NULL THEN e.v ELSE (s - ((s % n) + n) % n) // n END AS v
           FROM e{i} e LEFT JOIN m{i} m ON e.part = m.part AND e.pos = m.pos AND e.entry = m.entry)""")
    last = ROUNDS
    return f"""
WITH k AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c)))),
x AS (
  SELECT vec_id, (i - 1) // (n // {PARTS}) AS part, (i - 1) % (n // {PARTS}) AS pos, CAST(floor({SCALE} * c) AS BIGINT) AS v FROM (
    SELECT vec_id, len(embedding) AS n, unnest(embedding) AS c, unnest(range(1, len(embedding) + 1)) AS i FROM k)),{",".join(steps)},
c AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{last} GROUP BY 1),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM k JOIN c USING (vec_id) GROUP BY 1),
h AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM e{last})
SELECT c.vec_id, code, error, label_error, codebooks_sha256
FROM c JOIN k USING (vec_id) JOIN l ON k.label IS NOT DISTINCT FROM l.label CROSS JOIN h
"""


ORACLE = _oracle()
