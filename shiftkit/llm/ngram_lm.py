"""Interpolated modified Kneser-Ney bigram model, counted in Spark, memory-mapped by workers.

Counting: each task sums words and word pairs and sends sorted number blocks
to shards by hash, so a row of the shuffle stands for thousands of counts and
no word or context is a key of its own.  Pair shards merge their counts and
send what words need (the pairs a context has by count, the contexts a word
has) to word shards.  The number of shards follows the bytes of the texts,
and a partition is one shard, so a task's memory doesn't grow with the corpus.

Store: two Parquet files a shard, of its pairs and of its words, uncompressed and
without dictionaries, with one row whose binary columns are ascending hash
arrays and their values.  Such a value lies in one piece at the end of its
column chunk, so a worker maps the file and searches the arrays in place; no
worker holds the model in memory.  Counts have 64 bits; those of pairs are kept
in one byte each, with a list of the few that are larger.

Scoring: log10 P(w|v) = log10(max(c(vw) - D, 0) / c(v) + g(v) Pc(w)), Pc being
the discounted share of contexts that w follows, interpolated with 1/(V + 1).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftkit.llm.common import crc_mod, mix, planes, table, unplanes, utf8_chunks, words
from shiftkit.session import shared_dir, ship_package

#: Bytes of text for each shard.
SHARD = 16 << 20
_U = np.uint64
#: Hash of the end of a text, and of the place before its first word.
_END = np.uint64(0x3C6EF372FE94F82B)
_START = np.uint64(0xA54FF53A5F1D36F1)
_FLUSH = 3_000_000
_BLOCK = "shard int, kind int, a binary, b binary, c binary, d binary"
_WORD, _PAIR, _CONTEXT, _FOLLOWS = range(4)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, the one before it, row): the words of each row and its end."""
    h, row = words(data, off)
    n = len(off) - 1
    count = np.bincount(row, minlength=n) + 1
    ends = np.cumsum(count) - 1
    tok = np.full(int(count.sum()), _END, np.uint64)
    tok[np.arange(len(h)) + row] = h
    before = np.empty_like(tok)
    before[1:] = tok[:-1]
    before[ends - count + 1] = _START
    return tok, before, np.repeat(np.arange(n), count)


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(v + _U(1)) * _U(3) + w)


def _summed(key: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Ascending distinct keys and the sums of the counts of each."""
    key, at = np.unique(key, return_inverse=True)
    return [key, *[np.bincount(at, c, len(key)).astype(np.int64) for c in counts]]


def _squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(planes(np.ascontiguousarray(a)))


def _numbers(blob: bytes, dtype) -> np.ndarray:
    return unplanes(zstandard.ZstdDecompressor().decompress(blob), dtype)


def _steps(a: np.ndarray) -> np.ndarray:
    """Ascending numbers as differences, which squeeze well."""
    return np.diff(a, prepend=a.dtype.type(0))


def _rows_of_shards(kind: int, shard: np.ndarray, cols: list[np.ndarray], shards: int, pack) -> Iterator[pa.RecordBatch]:
    """One row a shard; ``pack`` makes up to four blobs of its part of the columns, which must be sorted within a shard."""
    order = np.argsort(shard, kind="stable")
    shard, cols = shard[order], [c[order] for c in cols]
    edge = np.searchsorted(shard, np.arange(shards + 1))
    for s in np.flatnonzero(edge[1:] > edge[:-1]).tolist():
        parts = pack([c[edge[s]:edge[s + 1]] for c in cols])
        yield pa.RecordBatch.from_arrays(
            [pa.array([s], pa.int32()), pa.array([kind], pa.int32()), *[pa.array([p], pa.binary()) for p in [*parts, None, None, None][:4]]],
            names=["shard", "kind", "a", "b", "c", "d"])


def _blocks(kind: int, shard: np.ndarray, cols: list[np.ndarray], shards: int) -> Iterator[pa.RecordBatch]:
    """Ascending hashes and their counts, one row a shard."""
    return _rows_of_shards(kind, shard, cols, shards, lambda c: [_squeeze(_steps(c[0])), *map(_squeeze, c[1:])])


def _pair_blocks(shard: np.ndarray, cols: list[np.ndarray], shards: int) -> Iterator[pa.RecordBatch]:
    """Pairs sorted by (before, token) and their counts, one row a shard: its distinct words, and places among them."""
    def pack(c: list[np.ndarray]) -> list[bytes]:
        known, at = np.unique(np.concatenate([c[0], c[1]]), return_inverse=True)
        at = at.astype(np.uint32)
        n = len(c[0])
        return [_squeeze(_steps(known)), _squeeze(_steps(at[:n])), _squeeze(at[n:]), _squeeze(c[2])]

    return _rows_of_shards(_PAIR, shard, cols, shards, pack)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> _U(40)) % _U(shards)).astype(np.int64)


def _count(docs: DataFrame, shards: int) -> DataFrame:
    """Blocks of words (token, count) and pairs (before, token, count) of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = [], 0

        def flush():
            nonlocal seen, size
            tok = np.concatenate([s[0] for s in seen])
            before = np.concatenate([s[1] for s in seen])
            seen, size = [], 0
            w, n = np.unique(tok, return_counts=True)
            yield from _blocks(_WORD, _shard(w, shards), [w, n.astype(np.uint32)], shards)
            order = np.lexsort((tok, before))
            v, w = before[order], tok[order]
            new = np.ones(len(v), bool)
            new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(v)))
            yield from _pair_blocks(_shard(pair_key(v[at], w[at]), shards), [v[at], w[at], n.astype(np.uint32)], shards)

        for b in batches:
            for _, _, data, off in utf8_chunks(b.column("text"), 1 << 20):
                tok, before, _ = tokens(data, off)
                seen.append((tok, before))
                size += len(tok)
                if size > _FLUSH:
                    yield from flush()
        if size:
            yield from flush()

    return docs.select("text").mapInArrow(run, _BLOCK)


def _of_shard(rows: Iterator[pa.RecordBatch]) -> tuple[int | None, dict[int, list]]:
    """(shard, blocks by kind) of a partition, which is one shard."""
    shard, held = None, {}
    for b in rows:
        for s, kind, *cols in zip(*(b.column(n) for n in ("shard", "kind", "a", "b", "c", "d")), strict=True):
            shard = s.as_py()
            held.setdefault(kind.as_py(), []).append([c.as_py() for c in cols])
    return shard, held


def _join(parts: list, i: int) -> np.ndarray:
    """Column ``i`` of blocks; the first one holds hashes."""
    dtype = np.uint32 if i else np.uint64
    if not parts:
        return np.zeros(0, dtype)
    return np.concatenate([np.cumsum(_numbers(p[0], dtype)) if i == 0 else _numbers(p[i], dtype) for p in parts])


def _join_pairs(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, token, count) of blocks of pairs, which are used up."""
    out = []
    while parts:
        known, v, w, n = parts.pop()
        known = np.cumsum(_numbers(known, np.uint64))
        out.append((known[np.cumsum(_numbers(v, np.uint32))], known[_numbers(w, np.uint32)], _numbers(n, np.uint32)))
    return tuple(np.concatenate([x[i] for x in out]) if out else np.zeros(0, t) for i, t in enumerate((np.uint64, np.uint64, np.uint32)))


_MERGED = _BLOCK + ", n long, n_large long, f1 long, f2 long, f3 long, f4 long, stored boolean"
_LARGE = 255


def _merge_pairs(blocks: DataFrame, shards: int, path: str) -> None:
    """Merge pairs: rows for word shards (words, contexts, followers), and the stored pairs of each shard in a file of their own.

    Written below ``path`` as ``stored=false`` and ``stored=true``.
    """
    def rows_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        none = pa.nulls(batch.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays([*batch.columns, *[none] * 6, pa.array([False] * batch.num_rows)],
                                          names=[f.split()[0] for f in _MERGED.split(", ")])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, kinds = _of_shard(rows)
        if s is None:
            return
        for p in kinds.pop(_WORD, []):
            yield rows_of(pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([_WORD], pa.int32()), *[pa.array([x], pa.binary()) for x in p]],
                names=["shard", "kind", "a", "b", "c", "d"]))
        v, w, n = _join_pairs(kinds.pop(_PAIR, []))
        if not len(v):
            return
        order = np.lexsort((w, v))
        v, w, n = v[order], w[order], n[order].astype(np.int64)
        del order
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        at = np.flatnonzero(new)
        v, w, n = v[at], w[at], np.add.reduceat(n, at)
        a, *c = _summed(v, n == 1, n == 2, n >= 3)
        for x in _blocks(_CONTEXT, _shard(a, shards), [a, *[x.astype(np.uint32) for x in c]], shards):
            yield rows_of(x)
        a, c = _summed(w, np.ones(len(w)))
        for x in _blocks(_FOLLOWS, _shard(a, shards), [a, c.astype(np.uint32)], shards):
            yield rows_of(x)
        key = pair_key(v, w)
        del v, w
        order = np.argsort(key)
        key, n = key[order], n[order]
        large = np.flatnonzero(n >= _LARGE)
        arrays = [key.tobytes(), np.minimum(n, _LARGE).astype(np.uint8).tobytes(), key[large].tobytes(), n[large].astype(np.uint64).tobytes()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s], pa.int32()), pa.array([-1], pa.int32()), *[pa.array([x], pa.binary()) for x in arrays],
             *[pa.array([int(x)], pa.int64()) for x in (len(key), len(large), *[(n == i).sum() for i in (1, 2, 3, 4)])], pa.array([True])],
            names=[f.split()[0] for f in _MERGED.split(", ")])

    merged = blocks.repartitionById(shards, F.col("shard")).mapInArrow(run, _MERGED)
    _uncompressed(merged.write.partitionBy("stored")).parquet(path)


def _uncompressed(writer):
    return (writer.option("compression", "uncompressed").option("parquet.enable.dictionary", "false")
            .option("parquet.page.write-checksum.enabled", "false"))


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from how many things have counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0]
    return tuple(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))


_STORE = ("shard int, words binary, counts binary, follows binary, backoff binary, "
          "n_entries long, n_words long, n_tokens long, n_follows long, f1 long, f2 long, f3 long, f4 long")


def _store(merged: DataFrame, shards: int, d: tuple[float, float, float], path: str) -> None:
    """Write one file a shard: words with counts, contexts followed and backoff mass."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, kinds = _of_shard(rows)
        if s is None:
            return
        parts = kinds.get(_WORD, [])
        w, c = _summed(_join(parts, 0), _join(parts, 1))
        start = None
        follows = np.zeros(len(w), np.int64)
        if parts := kinds.get(_FOLLOWS):
            a, n = _summed(_join(parts, 0), _join(parts, 1))
            follows[np.searchsorted(w, a)] = n
        back = np.ones(len(w))
        if parts := kinds.get(_CONTEXT):
            a, n1, n2, n3 = _summed(*[_join(parts, i) for i in range(4)])
            left = n1 * d[0] + n2 * d[1] + n3 * d[2]
            is_start = a == _START
            if is_start.any():
                start = float(left[is_start][0])
            a, left = a[~is_start], left[~is_start]
            at = np.searchsorted(w, a)
            back[at] = left / c[at]
        small = [len(w), int(c.sum()), int(follows.sum()), *[int((follows == i).sum()) for i in (1, 2, 3, 4)]]
        if start is not None:       # the place before the first word is a context, but not a word
            at = int(np.searchsorted(w, _START))
            w, c, follows, back = (np.insert(x, at, y) for x, y in zip((w, c, follows, back), (_START, 0, 0, start), strict=True))
        small = [len(w), *small]
        arrays = [w.tobytes(), c.astype(np.uint64).tobytes(), follows.astype(np.uint64).tobytes(), back.astype(np.float64).tobytes()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s], pa.int32()), *[pa.array([x], pa.binary()) for x in arrays], *[pa.array([x], pa.int64()) for x in small]],
            names=[f.split()[0] for f in _STORE.split(", ")])

    _uncompressed(merged.repartitionById(shards, F.col("shard")).mapInArrow(run, _STORE).write).parquet(path)


# --- the stored model --------------------------------------------------------------

#: Arrays of a file by column: name, kind of number, and the column that tells how many there are.
_WORD_FILE = {"words": ("words", np.uint64, "n_entries"), "counts": ("counts", np.uint64, "n_entries"),
              "follows": ("follows", np.uint64, "n_entries"), "backoff": ("backoff", np.float64, "n_entries")}
_PAIR_FILE = {"a": ("pairs", np.uint64, "n"), "b": ("pair_counts", np.uint8, "n"),
              "c": ("large", np.uint64, "n_large"), "d": ("large_counts", np.uint64, "n_large")}


def map_arrays(path: str) -> tuple[int, dict[str, np.ndarray]]:
    """(shard, arrays) of one file of words or pairs, mapped in place.

    The file has one row, so an array is the last thing in its column's chunk.
    """
    f = pq.ParquetFile(path)
    columns = _PAIR_FILE if "a" in f.schema_arrow.names else _WORD_FILE
    if not f.metadata.num_rows:          # of a task that had no shard
        return -1, {name: np.zeros(0, t) for name, t, _ in columns.values()}
    if f.metadata.num_rows != 1:
        raise ValueError(f"{path} has {f.metadata.num_rows} rows")
    row = f.read(columns=["shard", *{n for _, _, n in columns.values()}]).to_pylist()[0]
    raw, out, group = np.memmap(path, np.uint8, "r"), {}, f.metadata.row_group(0)
    for i in range(group.num_columns):
        col = group.column(i)
        if col.path_in_schema in columns:
            name, kind, count = columns[col.path_in_schema]
            size = row[count] * np.dtype(kind).itemsize
            end = col.data_page_offset + col.total_compressed_size
            if int(raw[end - size - 4:end - size].view("<u4")[0]) != size:
                raise ValueError(f"{path}: {name} does not lie in one piece")
            out[name] = raw[end - size:end].view(kind)
    return row["shard"], out


@dataclass
class NgramModel:
    """Where the shards are, and the few numbers that all of them share."""

    files: list[str]
    in_place: bool
    shards: int
    n_words: int
    n_tokens: int
    n_docs: int
    n_follows: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_left: float

    def __post_init__(self):
        self._maps: dict[int, dict[str, np.ndarray]] | None = None

    def __getstate__(self):
        return {**self.__dict__, "_maps": None}

    def maps(self) -> dict[int, dict[str, np.ndarray]]:
        if self._maps is None:
            paths = self.files if self.in_place else [SparkFiles.get(f.rsplit("/", 1)[1]) for f in self.files]
            self._maps = {}
            for s, arrays in map(map_arrays, paths):
                if s >= 0:
                    self._maps.setdefault(s, {}).update(arrays)
        return self._maps

    def _find(self, key: np.ndarray, keys: str, values: tuple[str, ...]) -> list[np.ndarray]:
        """The values of ascending distinct keys, 0 where a key is not stored."""
        out = [np.zeros(len(key)) for _ in values]
        shard = _shard(key, self.shards)
        order = np.argsort(shard, kind="stable")
        edge = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s, arrays in self.maps().items():
            at = order[edge[s]:edge[s + 1]]
            stored = arrays.get(keys, ())
            if len(at) and len(stored):
                k = np.minimum(np.searchsorted(stored, key[at]), len(stored) - 1)
                hit = stored[k] == key[at]
                for o, v in zip(out, values, strict=True):
                    o[at[hit]] = arrays[v][k[hit]]
        return out

    def score(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Per row: tokens, known tokens, base score, model score."""
        tok, before, row = tokens(data, off)
        n = len(off) - 1
        known, at = np.unique(np.concatenate([tok, before]), return_inverse=True)
        count, follows, back = self._find(known, "words", ("counts", "follows", "backoff"))
        at, at_before = at[:len(tok)], at[len(tok):]
        base = np.log10((count + 0.5) / (self.n_tokens + 0.5 * (self.n_words + 1)))
        d = np.array([0.0, *self.word_discounts])
        if self.n_follows:
            lower = (np.maximum(follows - d[np.minimum(follows, 3).astype(int)], 0) + self.word_left / (self.n_words + 1)) / self.n_follows
        else:
            lower = np.full(len(known), 1 / (self.n_words + 1))
        # The place before the first word was seen once a document.
        seen = np.where(known == _START, float(self.n_docs), count)
        back = np.where(known == _START, back / max(1, self.n_docs), back)
        back = np.where(seen > 0, back, 1.0)
        pairs, pair_at = np.unique(pair_key(before, tok), return_inverse=True)
        c2 = self._find(pairs, "pairs", ("pair_counts",))[0]
        large = np.flatnonzero(c2 == _LARGE)
        c2[large] = self._find(pairs[large], "large", ("large_counts",))[0]
        c2 = c2[pair_at]
        d = np.array([0.0, *self.pair_discounts])
        of = seen[at_before]
        p = np.where(of > 0, np.maximum(c2 - d[np.minimum(c2, 3).astype(int)], 0) / np.maximum(of, 1), 0) + back[at_before] * lower[at]
        return [np.bincount(row, minlength=n), np.bincount(row, count[at] > 0, n).astype(np.int64),
                np.bincount(row, base[at], n), np.bincount(row, np.log10(p), n)]


def train(docs: DataFrame) -> NgramModel:
    """Count and store the model of all given documents (column text); a null text has only its end.

    Repeated rows count each, other columns are ignored; of an empty table
    there is a model that knows no word.  All pairs are stored.  Only sums
    come to the driver, and the names of two files a shard.
    """
    spark = docs.sparkSession
    ship_package(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size.b // SHARD))
    merged = shared_dir(spark, "lm-merged")
    _merge_pairs(_count(docs, shards), shards, merged)
    both = spark.read.schema(_MERGED).parquet(merged)
    of = both.where("stored").agg(*[F.coalesce(F.sum(f"f{i}"), F.lit(0)) for i in (1, 2, 3, 4)]).first()
    d = discounts(np.array(of, np.int64))
    path = shared_dir(spark, "lm-model")
    _store(both.where("not stored"), shards, d, path)
    store = spark.read.schema(_STORE).parquet(path)
    total = store.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in
                        ("n_words", "n_tokens", "n_follows", "f1", "f2", "f3", "f4")]).first()
    wd = discounts(np.array([total.f1, total.f2, total.f3, total.f4]))
    left = total.f1 * wd[0] + total.f2 * wd[1] + max(0, total.n_words - total.f1 - total.f2) * wd[2]
    files = []
    if total.n_words:                   # two a shard
        files = store.inputFiles() + spark.read.parquet(f"{merged}/stored=true").inputFiles()
    in_place = all(f.startswith("file:") for f in files)
    if in_place:                        # the shared folder is mounted everywhere: map the files where they are
        files = ["/" + f.removeprefix("file:").lstrip("/") for f in files]
    else:                               # else Spark hands a copy to each executor
        for f in files:
            spark.sparkContext.addFile(f)
    return NgramModel(files, in_place, shards, total.n_words, total.n_tokens, size.n, total.n_follows, d, wd, left)


def scored(docs: DataFrame, model: NgramModel) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10 probability) of each document's whole text.

    A null text has only its end; null and repeated ids and repeated rows are
    scored each; other columns are ignored, whatever their names.
    """
    ship_package(docs.sparkSession)
    kinds = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in utf8_chunks(b.column("text"), 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), *[pa.array(x) for x in model.score(data, off)]],
                    names=["doc_id", *[k for k, _ in kinds]])

    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(*k) for k in kinds]])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op5_ngram_lm(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.where(crc_mod("doc_id", 5) != 1))
    return scored(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
