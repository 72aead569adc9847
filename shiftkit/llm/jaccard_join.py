"""Exact Jaccard join of documents over five-word shingles, by universe partition.

Shingles are hashed into segments; the number of segments belongs to a size
band.  Two sets that link differ in at most H = (s1 + s2) * (1 - t) / (1 + t)
shingles, so of any H + 1 segments one holds the same shingles in both
(pigeonhole), and of segments worth H + 1 errors, two each where a segment may
miss one shingle, one is equal up to a deletion.  Each set therefore emits the
hashes of its first H + 1 usable segments (or of fewer segments with their
one-deletion neighbourhoods), sets that share a hash are candidates, and
candidates are verified on the whole sets.

A segment is usable if it holds a shingle that is not frequent in the corpus.
Equal segments are equally usable, so a set with enough usable segments loses
no partner by skipping others.  The few sets that have not enough emit all
they have, and their rarest H + 1 single shingles besides, which finds the
pairs among themselves.  Which of the two kinds of segments a band uses is
allocated by cost, counted over all documents.

Sets are identified by 64-bit shingle hashes.  Equal sets are one class
throughout; copies are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.llm.common import WORD, components, landed, mix, planes, shingles, table, unplanes, utf8_chunks, words
from shiftkit.session import ship_package

PERCENT = 75
#: A shingle is frequent when more than this share of all documents (and 64 at least) have it.
FREQUENT = 0.001
#: So many of the most frequent shingles are known to the tasks.  Results do not depend on it:
#: any set of shingles may be called frequent.
FREQUENT_KEPT = 200_000
#: Hashes in one bucket of the candidate search, about.
BUCKET = 2_000_000
#: What a set without enough usable segments costs, in hashes.
POOR_COST = 4_000
#: Rounds of holding classes against one class of a group, before all remaining pairs are verified.
ROUNDS = 4
_FLUSH = 3_000_000
_FILTER_BITS = 1 << 20
_PLACES = 1_024
#: Stand-in ids of documents without id start here.
_NO_ID = 1 << 62
_U = np.uint64


class Scheme:
    """Segments, budgets and hashes for a similarity of ``percent``."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent

    def errors(self, total: int) -> int:
        """The most shingles by which two linked sets of ``total`` shingles together differ."""
        return total * (100 - self.percent) // (100 + self.percent)

    def roles(self, s: int) -> list[tuple[int, int]]:
        """(band, errors to cover) of a set of ``s`` shingles: its own band, and the next if a partner may be there."""
        band, largest = s.bit_length() - 1, s * 100 // self.percent
        out = [(band, self.errors(s + min(largest, (2 << band) - 1)))]
        b = band + 1
        while (1 << b) <= largest:
            out.append((b, self.errors(s + min(largest, (2 << b) - 1))))
            b += 1
        return out

    def segments(self, band: int, deletions: bool) -> int:
        """Segments of a band: enough for the largest set's errors with some empty ones."""
        h = self.errors(2 * ((2 << band) - 1))
        return int(1.15 * (h / 2 if deletions else h)) + 4

    def emit(self, g: np.ndarray, rare: np.ndarray, band: int, h: int, deletions: bool) -> tuple[np.ndarray, bool]:
        """(hashes, poor) of the set ``g``; poor if its usable segments are not worth h + 1 errors."""
        m = self.segments(band, deletions)
        salt = _U(band * 2 + deletions + 1)
        at = (mix(g + salt) % _U(m)).astype(np.uint16 if m < 1 << 16 else np.uint64)    # small numbers sort faster
        order = np.argsort(at, kind="stable")
        at, x, r = at[order], mix(g[order] ^ (salt << _U(40))), rare[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        size = np.diff(np.append(first, len(at)))
        usable = np.logical_or.reduceat(r, first)
        worth = np.where(size >= 2, 2, 1) if deletions else np.ones(len(size), np.int64)
        if deletions:                # a deletion must leave a usable segment as well
            n_rare = np.add.reduceat(r.astype(np.int64), first)
            worth = np.where((size >= 2) & (n_rare < 2), 1, worth)
        reach = np.cumsum(np.where(usable, worth, 0))
        end = int(np.searchsorted(reach, h + 1)) + 1
        poor = end > len(size)
        end = min(end, len(size))
        total = np.add.reduceat(x, first)
        tag = mix(at[first].astype(np.uint64) + (salt << _U(48)))
        keys = [mix(total[:end][usable[:end]] ^ tag[:end][usable[:end]])]
        if deletions:
            stop = len(x) if end == len(size) else first[end]
            seg = np.repeat(np.arange(len(size)), size)[:stop]
            left = n_rare[seg] - r[:stop]                  # rare shingles left without this one
            ok = (size[seg] >= 2) & (left > 0)
            keys.append(mix((total[seg[ok]] - x[:stop][ok]) ^ tag[seg[ok]]))
        return np.unique(np.concatenate(keys)), poor

    def price(self, g: np.ndarray, rare: np.ndarray, band: int, h: int, deletions: bool) -> tuple[int, bool]:
        """(hashes, poor) as ``emit`` would give, without making them."""
        m = self.segments(band, deletions)
        at = (mix(g + _U(band * 2 + deletions + 1)) % _U(m)).astype(np.int64)
        size, n_rare = np.bincount(at, minlength=m), np.bincount(at[rare], minlength=m)
        usable = n_rare > 0
        worth = (usable & (size >= 2) & (n_rare >= 2)) + usable.astype(np.int64) if deletions else usable
        reach = np.cumsum(worth)
        end = int(np.searchsorted(reach, h + 1)) + 1
        keys = int(usable[:end].sum())
        if deletions:
            size, n_rare = size[:end], n_rare[:end]
            keys += int(np.where(n_rare >= 2, size, np.where((n_rare == 1) & (size >= 2), size - 1, 0)).sum())
        return keys, end > m

    def rarest(self, g: np.ndarray, rare: np.ndarray, h: int) -> np.ndarray:
        """Hashes of the first h + 1 single shingles, rare ones first; any two linked sets share one."""
        order = np.lexsort((g, ~rare))[:h + 1]
        return mix(g[order] ^ _U(0x5BD1E995))


# --- reading documents as sets ------------------------------------------------

def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, set of each row as one array, bounds) for runs of rows."""
    for lo, hi, data, off in utf8_chunks(batch.column("text")):
        g, row = shingles(*words(data, off))
        yield lo, g, np.searchsorted(row, np.arange(hi - lo + 1))


def _key(g: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit digests of a set."""
    a = mix(np.array([np.add.reduce(mix(g ^ _U(0x9E37))) + _U(len(g))]) if len(g) else np.zeros(1, np.uint64))
    b = np.bitwise_xor.reduce(mix(g + _U(0x51ED))) if len(g) else _U(0)
    return int(a.view(np.int64)[0]), int(np.array([b]).view(np.int64)[0])


def _parity(g: np.ndarray) -> bytes:
    """Which hash places hold an odd number of shingles; a power of two of places, at least two a shingle."""
    places = max(_PLACES, 1 << (2 * len(g)).bit_length())
    return np.packbits(np.bincount((g & _U(places - 1)).astype(np.int64), minlength=places).astype(np.uint8) & 1,
                       bitorder="little").tobytes()


def _places_apart(x: bytes, y: bytes) -> int:
    """Places of different parity; the longer of two parities is folded to the length of the other."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, n), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _scan(docs: DataFrame) -> DataFrame:
    """Rows (kind 0) of each document: id, rid, n, k1, k2, parity; rows (kind 1) of shingles often met in a task: k1, n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "doc_id", "rid", "n", "k1", "k2", "parity"]
        held, size = [], 0
        often_h, often_n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def fold():
            nonlocal held, size, often_h, often_n
            h, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            h, n = np.concatenate([often_h, h[n >= 3]]), np.concatenate([often_n, n[n >= 3]])
            often_h, at = np.unique(h, return_inverse=True)
            often_n = np.bincount(at, n, len(often_h)).astype(np.int64)
            held, size = [], 0

        for b in batches:
            n, k1, k2, parity = [], [], [], []
            for _, g, bound in _sets(b):
                held.append(g)
                size += len(g)
                for i in range(len(bound) - 1):
                    a, z = _key(g[bound[i]:bound[i + 1]])
                    n.append(int(bound[i + 1] - bound[i]))
                    k1.append(a)
                    k2.append(z)
                    parity.append(_parity(g[bound[i]:bound[i + 1]]))
                if size > _FLUSH:
                    fold()
            yield pa.RecordBatch.from_arrays([pa.array([0] * len(n), pa.int32()), b.column("doc_id"), b.column("rid"),
                                              pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                                              pa.array(parity, pa.binary())], names=names)
        fold()
        z = pa.nulls(len(often_h), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([1] * len(often_h), pa.int32()), z, z, pa.array(often_n),
                                          pa.array(often_h.view(np.int64)), z, pa.nulls(len(often_h), pa.binary())], names=names)

    return landed(docs.mapInArrow(run, "kind int, doc_id long, rid long, n long, k1 long, k2 long, parity binary"), "join-scan")


def _rare(g: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.ones(len(g), bool)
    at = np.minimum(np.searchsorted(frequent, g), len(frequent) - 1)
    return frequent[at] != g


def _costs(docs: DataFrame, scheme: Scheme, frequent) -> dict[int, bool]:
    """band -> whether it uses one-deletion neighbourhoods: the cheaper way, counted over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost: dict[tuple[int, bool], list[int]] = {}
        for b in batches:
            for _, g, bound in _sets(b):
                rare = _rare(g, frequent.value)
                for i in range(len(bound) - 1):
                    lo, hi = bound[i], bound[i + 1]
                    for band, h in scheme.roles(int(hi - lo)) if hi > lo else ():
                        for d in (False, True):
                            keys, poor = scheme.price(g[lo:hi], rare[lo:hi], band, h, d)
                            c = cost.setdefault((band, d), [0, 0])
                            c[0] += keys
                            c[1] += int(poor)
        k = list(cost)
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in k], pa.int32()), pa.array([x[1] for x in k], pa.bool_()),
                                          *[pa.array([cost[x][j] for x in k], pa.int64()) for j in (0, 1)]],
                                         names=["band", "deletions", "keys", "poor"])

    rows = (docs.mapInArrow(run, "band int, deletions boolean, keys long, poor long").groupBy("band", "deletions")
            .agg(F.sum("keys").alias("keys"), F.sum("poor").alias("poor")).collect())      # two rows a band
    total = {(r.band, r.deletions): (r["keys"] + POOR_COST * r.poor, r["keys"]) for r in rows}
    plan = {b: total[b, True][0] < total[b, False][0] for b, _ in total}
    return plan, sum(total[b, d][1] for b, d in plan.items())


def _postings(docs: DataFrame, scheme: Scheme, plan: dict[int, bool], frequent, buckets: int) -> DataFrame:
    """(key, k1): the groups of at least two classes that share an emitted hash, each group once.

    Hashes travel as blocks: one row for each task and bucket with sorted
    numbers in it, equal ones of a task once.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, size = [], [], 0

        def flush():
            nonlocal keys, ids, size
            k = np.concatenate(keys)
            c = np.repeat(np.array([i for i, _ in ids], np.int64), [n for _, n in ids])
            keys, ids, size = [], [], 0
            bucket = (k >> _U(32)) % _U(buckets)
            order = np.lexsort((c, k, bucket))
            k, c, bucket = k[order], c[order], bucket[order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
            k, c, bucket = k[new], c[new], bucket[new]
            edge = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            for a in range(buckets):
                lo, hi = edge[a], edge[a + 1]
                if hi > lo:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([a], pa.int32()), pa.array([planes(k[lo:hi])], pa.binary()),
                         pa.array([c[lo:hi].tobytes()], pa.binary())], names=["bucket", "keys", "ids"])

        for b in batches:
            for _, g, bound in _sets(b):
                rare = _rare(g, frequent.value)
                for i in range(len(bound) - 1):
                    s, r = g[bound[i]:bound[i + 1]], rare[bound[i]:bound[i + 1]]
                    if not len(s):
                        continue
                    k1, worst = _key(s)[0], -1
                    for band, h in scheme.roles(len(s)):
                        out, poor = scheme.emit(s, r, band, h, plan.get(band, False))
                        worst = max(worst, h) if poor else worst
                        keys.append(out)
                        ids.append((k1, len(out)))
                        size += len(out)
                    if worst >= 0:
                        out = scheme.rarest(s, r, worst)
                        keys.append(out)
                        ids.append((k1, len(out)))
                        size += len(out)
                if size > _FLUSH:
                    yield from flush()
        if size:
            yield from flush()

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def group(parts):
            k = np.concatenate([p[0] for p in parts])
            c = np.concatenate([p[1] for p in parts])
            order = np.lexsort((c, k))
            k, c = k[order], c[order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
            k, c = k[new], c[new]
            same = np.zeros(len(k) + 1, bool)
            same[1:-1] = k[1:] == k[:-1]
            many = same[1:] | same[:-1]
            k, c = k[many], c[many]
            if len(k):
                # Near copies share many hashes; one group of the same classes is enough, under a key of its own.
                first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
                size = np.diff(np.append(first, len(k)))
                group_key = mix(np.add.reduceat(mix(c.view(np.uint64)), first) + size.astype(np.uint64))
                _, once = np.unique(group_key, return_index=True)
                kept = np.zeros(len(first), bool)
                kept[once] = True
                kept = np.repeat(kept, size)
                k, c = np.repeat(group_key, size)[kept], c[kept]
            for i in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(k[i:i + 100_000].view(np.int64)), pa.array(c[i:i + 100_000])],
                                                 names=["key", "k1"])

        last = None
        for b in batches:                # sorted by bucket: one bucket is in memory at a time
            for a, k, c in zip(b.column("bucket").to_pylist(), b.column("keys"), b.column("ids"), strict=True):
                if last is not None and a != last:
                    yield from group(held.pop(last))
                last = a
                held.setdefault(a, []).append((unplanes(k.as_py(), np.uint64), np.frombuffer(c.as_py(), np.int64)))
        if last is not None:
            yield from group(held.pop(last))

    blocks = docs.mapInArrow(emit, "bucket int, keys binary, ids binary")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = blocks.repartition(max(n, buckets), "bucket").sortWithinPartitions("bucket").mapInArrow(shared, "key long, k1 long")
    return landed(found.distinct(), "join-postings")


def _candidate_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, set) of the classes that are candidates.

    A filter of fixed size lets the scan drop almost all other documents;
    the join behind it is exact.
    """
    bits = np.zeros(_FILTER_BITS, bool)
    wanted = classes.join(ids, "id").select("id", "n", "k1", "k2")
    bits[[r.b for r in wanted.select(F.pmod("k1", F.lit(_FILTER_BITS)).cast("int").alias("b")).distinct().collect()]] = True
    packed = np.packbits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = np.unpackbits(packed).astype(bool), set()
        for b in batches:
            out = []
            for _, g, bound in _sets(b):
                for i in range(len(bound) - 1):
                    s = g[bound[i]:bound[i + 1]]
                    k = _key(s)
                    if len(s) and known[k[0] % _FILTER_BITS] and k not in seen:
                        if len(seen) < 100_000:           # only saves repeats; the join drops them anyway
                            seen.add(k)
                        out.append((*k, len(s), s.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["k1", "k2", "n", "set"])

    found = docs.mapInArrow(run, "k1 long, k2 long, n long, set binary").join(wanted, ["k1", "k2", "n"])
    return landed(found.dropDuplicates(["id"]).select("id", "set"), "join-sets")


def _possible(pairs: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) that may link by their sizes and parities.

    Places of different parity are at most as many as shingles of the
    symmetric difference, so no linked pair is dropped.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            apart = np.array([_places_apart(x, y) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)])
            na, nb = np.array(b.column("na")), np.array(b.column("nb"))
            ok = (apart <= scheme.errors(na + nb)) & (100 * np.minimum(na, nb) >= scheme.percent * np.maximum(na, nb))
            yield b.select(["a", "b"]).filter(pa.array(ok))

    side = classes.select("id", "n", "parity")
    joined = (pairs.join(side.withColumnsRenamed({"id": "a", "n": "na", "parity": "x"}), "a")
              .join(side.withColumnsRenamed({"id": "b", "n": "nb", "parity": "y"}), "b").select("a", "b", "na", "nb", "x", "y"))
    return joined.mapInArrow(run, "a long, b long")


_SHORT = [f"p{i}" for i in range(_PLACES // 64)]


def _short_parities(classes: DataFrame) -> DataFrame:
    """(id, n, p0, p1, ..): each class's parity folded to _PLACES places, 64 in a number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            folded = np.array([np.bitwise_xor.reduce(np.frombuffer(x, np.int64).reshape(-1, len(_SHORT)), axis=0)
                               for x in b.column("parity").to_pylist()], np.int64).reshape(-1, len(_SHORT))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n"), *[pa.array(c) for c in folded.T]],
                                             names=["id", "n", *_SHORT])

    return classes.select("id", "n", "parity").mapInArrow(run, "id long, n long, " + ", ".join(f"{c} long" for c in _SHORT))


def _open_pairs(members: DataFrame, scheme: Scheme) -> DataFrame:
    """Distinct pairs (a, b) of one key of ``members`` (key, id, c, n, p0, ..) in different components that may link.

    Sizes and short parities are part of the join condition, so a group of
    many classes unlike each other is compared but not written out as pairs.
    """
    cols = ["id", "c", "n", *_SHORT]
    x, y = (members.select("key", *[F.col(c).alias(f"{side}_{c}") for c in cols]) for side in "xy")
    total = F.col("x_n") + F.col("y_n")
    apart = sum((F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in _SHORT), F.lit(0))
    similar = 100 * F.least("x_n", "y_n") >= scheme.percent * F.greatest("x_n", "y_n")
    may = similar & (apart * (100 + scheme.percent) <= total * (100 - scheme.percent))
    return (x.join(y, "key").where((F.col("x_id") < F.col("y_id")) & (F.col("x_c") != F.col("y_c")) & may)
            .select(F.col("x_id").alias("a"), F.col("y_id").alias("b")).distinct())


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = (pairs.join(sets.withColumnsRenamed({"id": "a", "set": "x"}), "a")
              .join(sets.withColumnsRenamed({"id": "b", "set": "y"}), "b").select("a", "b", "x", "y"))
    return joined.mapInArrow(run, "a long, b long")


def _best(candidates: DataFrame) -> DataFrame:
    """(a, b): for each class ``id`` the ``a`` it meets in most groups."""
    return (candidates.groupBy("id", "a").agg(F.count(F.lit(1)).alias("c")).groupBy(F.col("id").alias("b"))
            .agg(F.max(F.struct("c", (-F.col("a")).alias("m"))).alias("best")).select((-F.col("best.m")).alias("a"), "b"))


def join_classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, rid, n_shingles, id (stands for a null doc_id), component_id.

    ``docs`` has doc_id and text; rid is the hash of both.  A null text or one
    without words has no shingles and links with nothing.  A row without
    doc_id links like others and has the smallest known doc_id of its
    component, or its stand-in id if there is none.  Repeated rows are one class.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rid"))
    scheme = Scheme(percent)
    scan = _scan(docs)
    rows = scan.where("kind = 0").select("doc_id", "rid", "n", "k1", "k2", "parity", F.coalesce(
        "doc_id", F.lit(_NO_ID) + F.pmod("rid", F.lit(1 << 61))).alias("id"))
    texts = docs.select("doc_id", "text", "rid")
    least = max(64, int(FREQUENT * rows.count()))
    often = (scan.where("kind = 1").groupBy("k1").agg(F.sum("n").alias("n")).where(F.col("n") > least)
             .orderBy(F.desc("n"), "k1").limit(FREQUENT_KEPT).select("k1").collect())
    frequent = spark.sparkContext.broadcast(np.sort(np.array([r.k1 for r in often], np.int64).view(np.uint64)))
    plan, total = _costs(texts, scheme, frequent)
    postings = _postings(texts, scheme, plan, frequent, max(1, ceil(total / BUCKET)))

    classes = landed(rows.where("n > 0").groupBy("k1", "k2", "n").agg(
        F.min("id").alias("id"), F.max("parity").alias("parity")), "join-classes")
    post = landed(postings.join(classes.select("k1", "id"), "k1").select("key", "id"), "join-post")

    def possible(pairs: DataFrame) -> DataFrame:
        return landed(_possible(pairs, classes, scheme), "join-possible")

    def ids_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()

    def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        return landed(_linked(pairs, sets, percent), "join-links")

    # First each class is held against the first class of its groups that it meets most often.
    first = post.groupBy("key").agg(F.min("id").alias("a"))
    pairs = possible(_best(post.join(first, "key").where("a < id")))
    sets = _candidate_sets(texts, classes, ids_of(pairs))
    tried, edges = pairs, linked(pairs, sets)
    comp = components(edges)
    # Then, while that joins anything, against a class of the lowest other component of a group.
    for _ in range(ROUNDS):
        near = landed(post.join(comp, "id", "left").select("key", "id", F.coalesce("component_id", "id").alias("c"))
                      .join(sets.select("id"), "id", "left_semi"), "join-known")
        hub = near.groupBy("key").agg(F.min(F.struct("c", "id")).alias("h")).select("key", F.col("h.c").alias("hc"), F.col("h.id").alias("a"))
        pairs = possible(_best(near.join(hub, "key").where("c <> hc")).join(tried, ["a", "b"], "left_anti"))
        found = linked(pairs, sets)
        if not found.limit(1).count():
            break
        tried, edges = landed(tried.union(pairs), "join-tried"), landed(edges.union(found), "join-links")
        comp = components(edges)
    # What is left are pairs of one group that are not yet in one component; every one is verified.
    known = landed(post.join(comp, "id", "left").select("key", "id", F.coalesce("component_id", "id").alias("c")), "join-known")
    open_keys = known.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    open_post = landed(known.join(open_keys, "key"), "join-open")
    short = _short_parities(classes.join(open_post.select("id").distinct(), "id", "left_semi"))
    rest = _open_pairs(open_post.join(short, "id"), scheme).join(
        tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    rest = possible(rest)
    more = ids_of(rest).join(sets, "id", "left_anti")
    if more.limit(1).count():
        sets = sets.union(_candidate_sets(texts, classes, more))
    last = linked(rest, sets)
    final = components(edges.union(last)) if last.limit(1).count() else comp
    member = classes.join(final, "id", "left").select("k1", "k2", "n", F.coalesce("component_id", "id").alias("c"))
    return rows.join(member, ["k1", "k2", "n"], "left").select(
        "doc_id", "rid", F.col("n").alias("n_shingles"), "id", F.coalesce("c", "id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of every component: that with the smallest doc_id.

    Documents without words all stay, each of their rows.  Rows of equal
    doc_id and text with words are one document.
    """
    found = join_classes(docs, percent)
    best = found.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct("id", "rid")).alias("b")).select(F.col("b.rid").alias("__rid"))
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    one = (docs.where(has_words).withColumn("__rid", F.xxhash64("doc_id", "text")).join(landed(best.distinct(), "join-keep"), "__rid")
           .dropDuplicates(["__rid"]).drop("__rid"))
    return one.unionByName(docs.where(~has_words))


def op9_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return join_classes(docs).select("doc_id", "n_shingles", F.when(F.col("component_id") < _NO_ID, F.col("component_id")).alias("component_id"))
