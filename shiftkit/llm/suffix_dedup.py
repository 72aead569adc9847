"""Removal of repeated passages by suffix arrays of shards.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id.  Whether a string does is settled in the suffix
array of the shard that holds all its occurrences: suffixes are sorted by
induction (:mod:`shiftkit.llm.suffix_array`), and where the permuted common
prefixes are ``length`` or more the suffixes of a group start with the same
string, whose smallest document id is the group's.

How strings come to shards: every string has an anchor, the smallest hash of
its 24-byte grams, a function of its content.  Successive strings with one
anchor make a piece of a document, and pieces go to the shard of their anchor,
so equal strings always meet.  To send little,

* texts are landed once as compressed blocks;
* a first pass sends only the anchors of each block, to learn which occur in
  more than one document; pieces of other anchors go nowhere;
* equal pieces of a block are sent once, with their smallest id, and those of
  a shard are sorted once.  Only anchors with unequal pieces need an array.

A passage that a third of all documents share is so one entry a block,
not one a document.  An anchor met more often than ``hot`` times (the edges of such a
passage have as many unequal pieces) is dealt anew, string by string, by the
strings' own hashes.  Verdicts go back to blocks, which apply them to all
their documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.llm.common import landed, mix, planes, table, unplanes, utf8_chunks
from shiftkit.llm.suffix_array import permuted_lcp, ragged, suffix_array
from shiftkit.session import ship_package

LENGTH = 50
GRAM = 24
#: Bytes of text in a block, texts' bytes for each shard, and bytes sorted in one array (more only for a single anchor).
BLOCK, SHARD, ARRAY = 4 << 20, 16 << 20, 1 << 19
#: Occurrences above which an anchor's strings are dealt one by one.
HOT = 20_000
_U = np.uint64
_NO_ID = (1 << 63) - 1
_STEP = 1 << 17


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes(a) if a.itemsize > 1 else a.tobytes() for a in arrays))


def _open(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


# --- anchors and pieces ------------------------------------------------------

def _gram_hashes(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Hashes of 24-byte grams from their three words."""
    return mix(first * _U(0xD1342543DE82EF95) + (second ^ (second >> _U(29))) * _U(0x9E3779B97F4A7C15)
               + (third ^ (third >> _U(31))) * _U(0xC2B2AE3D27D4EB4F))


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position as one number, a view."""
    return np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` neighbours, by doubling."""
    k = 1
    while 2 * k <= width:
        h = np.minimum(h[:-k], h[k:])
        k *= 2
    return np.minimum(h[:len(h) - (width - k)], h[width - k:]) if k < width else h


def anchors(data: np.ndarray, length: int) -> np.ndarray:
    """The anchor of the string of ``length`` bytes at each position."""
    out = np.empty(max(0, len(data) - length + 1), np.uint64)
    for lo in range(0, len(out), _STEP):
        hi = min(lo + _STEP, len(out))
        word = _words(data[lo:hi + length - 1]).copy()
        out[lo:hi] = _smallest(_gram_hashes(word[:-16], word[8:-8], word[16:]), length - GRAM + 1)
    return out


def string_hashes(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A hash of each string of ``length`` bytes: of its first and its last gram."""
    word = _words(data)

    def gram(p: np.ndarray) -> np.ndarray:
        return _gram_hashes(word[p], word[p + 8], word[p + 16])
    return mix(gram(at) * _U(3) + gram(at + length - GRAM))


def pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, strings, anchor, row) of the maximal runs of strings with one anchor; no string crosses a row."""
    m = anchors(data, length)
    inside = np.zeros(len(m) + 1, np.int8)
    fits = np.diff(offsets) >= length
    inside[offsets[:-1][fits]] = 1
    inside[offsets[1:][fits] - length + 1] = -1
    inside = np.cumsum(inside[:len(m)], dtype=np.int8).astype(bool)
    same = np.zeros(len(m) + 1, bool)                        # same anchor as the string before
    same[1:len(m)] = (m[1:] == m[:-1]) & inside[1:] & inside[:-1]
    start = np.flatnonzero(inside & ~same[:-1])
    end = np.flatnonzero(inside & ~same[1:]) + 1
    return start, end - start, m[start], np.searchsorted(offsets, start, side="right") - 1


class Block:
    """A landed block of documents, its pieces, and its distinct anchors in the order in which shards answer."""

    def __init__(self, row: dict, length: int, shards: int):
        self.ids, self.length, self.shards = row["ids"], length, shards
        self.id = np.array([_NO_ID if i is None else i for i in row["ids"]], np.int64)
        self.raw = _open(row["data"])
        self.data = np.frombuffer(self.raw, np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(np.array(row["lens"], np.int64))])
        self.start, self.strings, self.anchor, self.row = pieces(self.data, self.offsets, length)
        order = np.argsort(self.anchor, kind="stable")
        a, r = self.anchor[order], self.row[order]
        new = np.concatenate([[True], a[1:] != a[:-1]]) if len(a) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(a)))
        several = r[first] != r[first + count - 1] if len(first) else np.zeros(0, bool)
        shard = (a[first] % _U(shards)).astype(np.int64)
        by_shard = np.argsort(shard, kind="stable")
        self.known, self.shard = a[first][by_shard], shard[by_shard]
        self.count, self.several = count[by_shard], several[by_shard]
        place = np.empty(len(first), np.int64)
        place[by_shard] = np.arange(len(first))
        self.entry = np.empty(len(a), np.int64)             # of each piece, its anchor's place
        self.entry[order] = place[np.cumsum(new) - 1]

    @staticmethod
    def slices(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
        edge = np.flatnonzero(np.diff(shard)) + 1
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(shard)], strict=True):
            if hi > lo:
                yield int(shard[lo]), slice(lo, hi)

    def candidates(self, answers: list[dict]) -> None:
        """Distinct pieces of the anchors that shards found in more than one document, in the order of their verdicts."""
        code = np.zeros(len(self.known), np.uint8)
        where = dict(self.slices(self.shard))
        for x in answers:
            code[where[x["shard"]]] = np.frombuffer(_open(x["data"]), np.uint8)
        code = code[self.entry]
        whole, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        at = ragged(self.start[hot], self.strings[hot])
        self.p_start = np.concatenate([self.start[whole], at])
        self.p_size = np.concatenate([self.strings[whole] + self.length - 1, np.full(len(at), self.length)])
        self.p_row = np.concatenate([self.row[whole], np.repeat(self.row[hot], self.strings[hot])])
        p_anchor = np.concatenate([self.anchor[whole], string_hashes(self.data, at, self.length) if len(at) else np.zeros(0, np.uint64)])
        found: dict[bytes, int] = {}
        raw = self.raw
        first, index = [], np.empty(len(self.p_start), np.int64)
        for i, (s, n) in enumerate(zip(self.p_start.tolist(), self.p_size.tolist(), strict=True)):
            piece = raw[s:s + n]
            j = found.setdefault(piece, len(found))
            if j == len(first):
                first.append(i)
            index[i] = j
        least = np.full(len(first), _NO_ID, np.int64)
        np.minimum.at(least, index, self.id[self.p_row])
        first = np.array(first, np.int64)
        shard = (p_anchor[first] % _U(self.shards)).astype(np.int64)
        order = np.lexsort((p_anchor[first], shard))
        place = np.empty(len(first), np.int64)
        place[order] = np.arange(len(first))
        self.piece, self.d_shard, self.d_first, self.d_least = place[index], shard[order], first[order], least[order]
        self.d_anchor = (p_anchor[first[order]] >> _U(32)).astype(np.uint32)

    def removed(self, verdicts: list[dict]) -> np.ndarray:
        """Mask of the bytes that go."""
        runs = np.zeros(len(self.d_shard), np.int64)
        got = {}
        for shard, at in self.slices(self.d_shard):
            got[shard] = at
        parts = sorted(((got[x["shard"]], _open(x["data"])) for x in verdicts), key=lambda x: x[0].start)
        sizes, least = [], []
        for at, blob in parts:
            n = at.stop - at.start
            runs[at] = unplanes(blob[:4 * n], np.uint32)
            total = int(runs[at].sum())
            sizes.append(unplanes(blob[4 * n:4 * (n + total)], np.uint32))
            least.append(unplanes(blob[4 * (n + total):], np.int64))
        change = np.zeros(len(self.data) + 1, np.int32)
        if sizes:
            sizes, least = np.concatenate(sizes).astype(np.int64), np.concatenate(least)
            first = np.cumsum(runs) - runs
            before = np.cumsum(sizes) - sizes               # strings before each run, over all pieces
            n = runs[self.piece]
            run = ragged(first[self.piece], n)
            of = np.repeat(np.arange(len(self.piece)), n)
            goes = least[run] < self.id[self.p_row[of]]
            run, of = run[goes], of[goes]
            start = self.p_start[of] + before[run] - before[first[self.piece[of]]]
            np.add.at(change, start, 1)
            np.add.at(change, start + sizes[run] + self.length - 1, -1)
        return np.cumsum(change[:-1]) > 0


# --- tasks --------------------------------------------------------------------

_BLOCK = "block long, ids array<long>, lens array<long>, raw long, data binary"
_SENT = "shard long, block long, n long, data binary"


def blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Documents (doc_id, text) in compressed blocks of about ``size`` bytes under random names, to be landed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lens, parts, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            raw = b"".join(parts)
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().int >> 66], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lens], pa.list_(pa.int64())),
                 pa.array([len(raw)], pa.int64()), pa.array([zstandard.ZstdCompressor(level=3).compress(raw)], pa.binary())],
                names=["block", "ids", "lens", "raw", "data"])

        for b in batches:
            doc_ids = b.column("doc_id").to_pylist()
            for lo, hi, data, off in utf8_chunks(b.column("text"), size):
                raw = data.tobytes()
                for i in range(lo, hi):
                    text = raw[off[i - lo]:off[i - lo + 1]]
                    if ids and held + len(text) > size:
                        yield block()
                        ids, lens, parts, held = [], [], [], 0
                    ids.append(doc_ids[i])
                    lens.append(len(text))
                    parts.append(text)
                    held += len(text)
        if ids:
            yield block()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _BLOCK)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _sent(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)), pa.array([r[3] for r in rows], pa.binary())],
        names=["shard", "block", "n", "data"])


def _anchors_sent(held: DataFrame, length: int, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b = Block(row, length, shards)
            flags = (np.minimum(b.count, 32_767) << 1 | b.several).astype(np.uint16)
            out = [(shard, row["block"], at.stop - at.start,
                    _squeeze(np.diff(b.known[at] >> _U(16), prepend=_U(0)), flags[at])) for shard, at in b.slices(b.shard)]
            if out:
                yield _sent(out)

    return held.mapInArrow(run, _SENT)


def _anchors_answered(sent: DataFrame, hot: int) -> DataFrame:
    """Per block and shard a code for each anchor: 0 in one document only, 1 in several, 2 in very many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, value, flags = [], [], []
        for b in batches:
            for shard, block, n, data in zip(*(b.column(c).to_pylist() for c in ("shard", "block", "n", "data")), strict=True):
                raw = _open(data)
                names.append((shard, block, n))
                value.append(np.cumsum(unplanes(raw[:8 * n], np.uint64)))
                flags.append(unplanes(raw[8 * n:], np.uint16))
        if not names:
            return
        v, f = np.concatenate(value), np.concatenate(flags)
        del value, flags
        order = np.argsort(v, kind="stable")
        new = np.concatenate([[True], v[order[1:]] != v[order[:-1]]])
        del v
        first = np.flatnonzero(new)
        f = f[order]
        several = (np.diff(np.append(first, len(f))) > 1) | (np.bitwise_or.reduceat(f, first) & 1).astype(bool)
        many = np.add.reduceat((f >> 1).astype(np.int64), first) > hot
        code = np.empty(len(order), np.uint8)
        code[order] = (several.astype(np.uint8) + (several & many))[np.cumsum(new) - 1]
        out, lo = [], 0
        for shard, block, n in names:
            part = code[lo:lo + n]
            lo += n
            if part.any():
                out.append((shard, block, n, _squeeze(part)))
            if len(out) == 256:
                yield _sent(out)
                out = []
        if out:
            yield _sent(out)

    return sent.mapInArrow(run, _SENT)


def _pieces_sent(held: DataFrame, length: int, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b = Block(row, length, shards)
            b.candidates(row["answers"] or [])
            out = []
            for shard, at in b.slices(b.d_shard):
                first = b.d_first[at]
                text = b.data[ragged(b.p_start[first], b.p_size[first])]
                out.append((shard, row["block"], len(first), _squeeze(b.p_size[first].astype(np.uint32), b.d_anchor[at], b.d_least[at], text)))
            if out:
                yield _sent(out)

    return held.mapInArrow(run, _SENT)


def least_ids(texts: list[bytes], ids: np.ndarray, length: int) -> np.ndarray:
    """For each string of ``length`` bytes of each text, text after text, the smallest id of a text that has it, from one suffix array."""
    end = b"\xff"                                            # no byte of UTF-8
    t = np.frombuffer(end.join(texts) + end, np.uint8)
    size = np.array([len(x) for x in texts], np.int64)
    strings = size - length + 1
    sa = suffix_array(t)
    far = permuted_lcp(t, sa)[sa] >= length
    at = ragged(np.cumsum(size + 1) - size - 1, strings)
    own = np.full(len(t), _NO_ID, np.int64)
    own[at] = np.repeat(ids, strings)
    group = np.flatnonzero(~far)
    least = np.minimum.reduceat(own[sa], group)
    out = np.empty(len(t), np.int64)
    out[sa] = np.repeat(least, np.diff(np.append(group, len(sa))))
    return out[at]


def _verdicts(sent: DataFrame, length: int) -> DataFrame:
    """Per block and shard, for each of its pieces, runs of (strings, smallest id that has them)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        names, entries, owner, group = [], [], [], []
        for b in batches:
            for shard, block, n, data in zip(*(b.column(c).to_pylist() for c in ("shard", "block", "n", "data")), strict=True):
                raw = _open(data)
                size = unplanes(raw[:4 * n], np.uint32)
                anchor = unplanes(raw[4 * n:8 * n], np.uint32)
                owner.append(unplanes(raw[8 * n:16 * n], np.int64))
                at, index = 16 * n, np.empty(n, np.int64)
                for i, m in enumerate(size.tolist()):
                    index[i] = j = known.setdefault(raw[at:at + m], len(known))
                    if j == len(group):
                        group.append(anchor[i])
                    at += m
                names.append((shard, block, n))
                entries.append(index)
        if not names:
            return
        least = np.full(len(known), _NO_ID, np.int64)
        for index, ids in zip(entries, owner, strict=True):
            np.minimum.at(least, index, ids)
        text = list(known)
        strings = np.array([len(x) for x in text], np.int64) - length + 1
        # Runs of each piece: by themselves, one of all its strings.
        count, first = np.ones(len(text), np.int64), np.arange(len(text))
        sizes, smallest, used = [strings], [least], len(text)
        g = np.array(group, np.uint32)
        order = np.argsort(g, kind="stable")
        g = g[order]
        edge = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        members = np.diff(np.append(edge, len(g)))
        todo, held = [], 0

        def settle() -> int:
            at = np.concatenate(todo)
            m = least_ids([text[i] for i in at.tolist()], least[at], length)
            start = np.cumsum(strings[at]) - strings[at]
            new = np.concatenate([[True], m[1:] != m[:-1]])
            new[start] = True
            run_at = np.flatnonzero(new)
            first[at] = used + np.searchsorted(run_at, start)
            count[at] = np.diff(np.append(np.searchsorted(run_at, start), len(run_at)))
            sizes.append(np.diff(np.append(run_at, len(m))))
            smallest.append(m[run_at])
            return used + len(run_at)

        for lo, n in zip(edge[members > 1].tolist(), members[members > 1].tolist(), strict=True):
            mine = order[lo:lo + n]
            size = int(strings[mine].sum()) + n * length
            if todo and held + size > ARRAY:
                used = settle()
                todo, held = [], 0
            todo.append(mine)
            held += size
        if todo:
            used = settle()
        sizes, smallest = np.concatenate(sizes).astype(np.uint32), np.concatenate(smallest)
        out = []
        for (shard, block, n), index in zip(names, entries, strict=True):
            at = ragged(first[index], count[index])
            out.append((shard, block, n, _squeeze(count[index].astype(np.uint32), sizes[at], smallest[at])))
            if len(out) == 64:
                yield _sent(out)
                out = []
        if out:
            yield _sent(out)

    return sent.mapInArrow(run, _SENT)


def _applied(held: DataFrame, length: int, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b = Block(row, length, shards)
            b.candidates(row["answers"] or [])
            gone = b.removed(row["verdicts"] or [])
            first, last = gone.copy(), gone.copy()
            first[1:] &= ~gone[:-1]
            last[:-1] &= ~gone[1:]
            edges = np.unique(b.offsets[1:-1])
            edges = edges[(edges > 0) & (edges < len(gone))]
            first[edges], last[edges - 1] = gone[edges], gone[edges - 1]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            spans = np.searchsorted(s, b.offsets).astype(np.int32)
            base = np.repeat(b.offsets[:-1], np.diff(spans))
            kept = b.data[~gone].tobytes()
            at = b.offsets - np.concatenate([[0], np.cumsum(gone)])[b.offsets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.ids, pa.int64()), pa.array(np.diff(b.offsets)),
                 pa.ListArray.from_arrays(pa.array(spans), pa.StructArray.from_arrays([pa.array(s - base), pa.array(e - base)], names=["start", "end"])),
                 pa.array([kept[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"])

    return held.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def without_repeats(docs: DataFrame, length: int = LENGTH, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (removed bytes, maximal runs) and kept (remaining bytes) of every row of ``docs`` (doc_id, text).

    Other columns are ignored.  Texts are UTF-8 bytes, a null one is empty.
    Strings are judged on the input.  Rows with equal ids leave each
    other alone; a null id counts as larger than all others, and leaves other
    null ids alone.  An empty table gives no rows.  ``length`` is at least 24.
    """
    if length < GRAM:
        raise ValueError(f"length is at least {GRAM}")
    spark = docs.sparkSession
    ship_package(spark)
    held = landed(blocks(docs, block), "repeat-blocks")
    total = held.agg(F.sum("raw")).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD))

    def by_block(sent: DataFrame, name: str) -> DataFrame:
        return sent.groupBy("block").agg(F.collect_list(F.struct("shard", "data")).alias(name)).hint("shuffle_hash")

    answers = landed(_anchors_answered(_anchors_sent(held, length, shards).repartitionById(shards, F.col("shard").cast("int")), hot), "repeat-anchors")
    asked = held.join(by_block(answers, "answers"), "block", "left")
    verdicts = landed(_verdicts(_pieces_sent(asked, length, shards).repartitionById(shards, F.col("shard").cast("int")), length), "repeat-verdicts")
    both = by_block(answers, "answers").join(by_block(verdicts, "verdicts"), "block", "full")
    return _applied(held.join(both.hint("shuffle_hash"), "block", "left"), length, shards)


def op13_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


#: Strings of 50 bytes as 100 hexadecimal digits, cut from pieces of 512 bytes and their next 49.
ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
c AS (SELECT doc_id, n, j, substr(h, CAST(1024 * j + 1 AS BIGINT), 1122) AS hj FROM (SELECT *, unnest(range(0, n // 512 + 1)) AS j FROM d)),
p AS (SELECT doc_id, n, j, hj, unnest(range(0, 512)) AS i FROM c),
w AS (SELECT doc_id, 512 * j + i AS i, substr(hj, CAST(2 * i + 1 AS BIGINT), 100) AS s FROM p WHERE 512 * j + i + 50 <= n),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
g AS (SELECT w.doc_id, w.i FROM w JOIN m USING (s) WHERE m.least < w.doc_id),
b AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM g),
r AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM b),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS z FROM r GROUP BY 1, 2),
kept AS (
  SELECT cut.doc_id, string_agg(substr(h, CAST(2 * z + 1 AS BIGINT), CAST(2 * (coalesce(next_a, n) - z) AS BIGINT)), '' ORDER BY k) AS hx
  FROM (SELECT c.doc_id, c.k, c.z, lead(c.a) OVER (PARTITION BY c.doc_id ORDER BY c.k) AS next_a
        FROM (SELECT doc_id, k, a, z FROM spans UNION ALL SELECT doc_id, 0, 0, 0 FROM d) c) cut JOIN d USING (doc_id) GROUP BY 1),
t AS (SELECT doc_id, sum(z - a) AS gone, count(*) AS n_spans FROM spans GROUP BY 1)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(hx)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN t USING (doc_id)
"""
