"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftkit.session import shared_dir

#: A word: a run of anything but blank, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared work folder and read back: lineage ends here."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """More tasks for CPU-heavy Python work when a small table has few splits.

    Large tables are split by the scan; a fixed partition count would bind
    them, so only the session's own shuffle partition count is used and only
    the columns given are moved.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def crc_mod(c: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))


# --- words of UTF-8 text as 64-bit hashes, vectorised -----------------------

_R = 0xD1342543DE82EF95                    # odd, so it has an inverse modulo 2**64
_RINV = pow(_R, -1, 1 << 64)
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of words in the narrow sense: A-Z, a-z and everything beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(1, 257, dtype=np.uint64)          # byte + 1, A-Z folded
_LOWER[65:91] = np.arange(98, 124)
_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _POW[base] = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def utf8_chunks(texts: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of runs of about ``limit`` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    arr = texts.cast(pa.large_string()).fill_null("")
    if not len(arr):
        return
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(arr):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, len(arr))
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] the unshifted hash of the bytes s..e, A-Z folded."""
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * _powers(_R, max(1, len(data)))[:len(data)], out=p[1:])
    return p


def span_hashes(p: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hash of each byte span; equal folded bytes have equal hashes wherever they stand."""
    return mix((p[e] - p[s]) * _powers(_RINV, max(1, len(p)))[s] ^ ((e - s).astype(np.uint64) << _U(48)))


def runs(data: np.ndarray, offsets: np.ndarray, out: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal byte runs whose bytes are not in ``out``."""
    inside = ~out[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:][(offsets[1:] > 0)] - 1
    last[edges] = inside[edges]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word, in order."""
    s, e, row = runs(data, offsets)
    return span_hashes(prefix_sums(data), s, e), row


def text_hash(text: str) -> int:
    """The span hash of one text, for looking a single word up."""
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return int(span_hashes(prefix_sums(b), np.zeros(1, np.int64), np.full(1, len(b), np.int64))[0])


def distinct_per_row(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, sorted by (row, hash)."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def shingles(h: np.ndarray, row: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingle hashes per row; fewer words count as one shingle."""
    def join(parts: list[np.ndarray]) -> np.ndarray:
        g = np.full(len(parts[0]), len(parts), np.uint64)
        for x in parts:
            g = mix(g * _U(_R) + x)
        return g
    n = len(h)
    found, at = [], []
    if n >= k:
        ok = np.flatnonzero(row[k - 1:] == row[:n - k + 1])
        found.append(join([h[ok + j] for j in range(k)]))
        at.append(row[ok])
    if n:
        ids, first, count = np.unique(row, return_index=True, return_counts=True)
        for m in range(1, k):
            ok = first[count == m]
            if len(ok):
                found.append(join([h[ok + j] for j in range(m)]))
                at.append(row[ok])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return distinct_per_row(np.concatenate(found), np.concatenate(at))


# --- blocks of numbers in binary columns ------------------------------------

def planes(a: np.ndarray) -> bytes:
    """The bytes of a number array by significance: sorted numbers then compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unplanes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


# --- connected components ----------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(id, component_id): the smallest id reachable over ``edges`` (columns a, b).

    Each round takes the smallest label among the neighbours and then the
    label of that label, so a path shrinks by a constant factor a round.  Only
    joins and map-side combined minima are used; every round is landed in the
    shared work folder.  Nodes without edges are not in the result.
    """
    both = landed(edges.select("a", "b").where("a <> b")
                  .union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct(), "cc-edges")
    labels = landed(both.groupBy(F.col("a").alias("id"))
                    .agg(F.least(F.col("a"), F.min("b")).alias("component_id")), "cc-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component_id").alias("near")))
        step = labels.join(near, "id", "left").select(
            "id", F.col("component_id").alias("old"), F.least("component_id", "near").alias("mid"))
        up = labels.select(F.col("id").alias("mid"), F.col("component_id").alias("top"))
        nxt = landed(step.join(up, "mid", "left").select(
            "id", "old", F.least("mid", "top").alias("component_id")), "cc-labels")
        if not nxt.where("old <> component_id").limit(1).count():
            return nxt.select("id", "component_id")
        labels = nxt.select("id", "component_id")
