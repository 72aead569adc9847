"""Information-theoretic sanitisation of personal data.

E-mail addresses, IP numbers, payment cards and phone numbers are found by
pattern.  They are the protected entities.  A term discloses an entity when
seeing the term tells most of what seeing the entity would: with counts of
documents over the whole corpus, PMI(e; t) = log2(N n(e,t) / (n(e) n(t))) is
compared with the entity's own information log2(N / n(e)), for all terms of
the documents that hold the entity.  Their ratio is 1 if the term never occurs
without the entity.  Terms that meet the entity no more often than chance may
bring about are left alone.  From GENERALISE on the term is replaced by a placeholder,
from REMOVE on it is removed, wherever it occurs in any document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftkit.llm.common import (LETTER, distinct_per_row, landed, prefix_sums, runs, span_hashes, table, text_hash,
                                 utf8_chunks)
from shiftkit.session import ship_package

KINDS = ("email", "ip", "card", "phone")
GENERALISE, REMOVE = 0.7, 0.9
#: Significance: the chance that independent ones share as many documents.  For a term that occurs without the entity
#: too it is multiplied by the number of terms (Bonferroni), for any of them might have met the entity by chance.
#: A term that never does changes no document but the entity's, so its own chance counts.
CHANCE = 0.05
#: Bits of the filter that keeps most other terms out of the join with the disclosing ones; more cost memory only.
FILTER_BITS = 1 << 26

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Tried at the start of a run of digits only: inside a run the outcome is the same.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile("[A-Za-z\x80-\U0010ffff]+")


def emails(t: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain; each sign looks back once, so long runs cost linear time."""
    done, at = 0, t.find("@")
    while at >= 0:
        s = at
        while s > done and t[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(t, at + 1) if s < at else None
        if m:
            yield s, m.end()
            done = m.end()
        at = t.find("@", m.end() if m else at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(t: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind in the order of KINDS."""
    found = []
    if "@" in t:
        found += [(s, 0, e) for s, e in emails(t)]
    if _DIGIT.search(t):
        if "." in t:
            found += [(m.start(), 1, m.end()) for m in _IP.finditer(t)
                      if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 12:
                digits = re.sub(r"[\x20-]", "", m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in t:
            for m in _PHONE.finditer(t):
                if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


def _entity(kind: str, value: str) -> int:
    value = value.lower() if kind == "email" else value if kind == "ip" else re.sub(r"[^0-9]", "", value)
    return int(np.uint64(_hash(f"{kind}:{value}")).view(np.int64))


def _entities(t: str, spans: list[tuple[int, int, str]]) -> list[int]:
    return sorted({_entity(k, t[s:e]) for s, e, k in spans})


@lru_cache(1 << 16)
def _hash(term: str) -> int:
    return text_hash(term)


_SPAN = "struct<start:int,end:int,kind:string>"
_BASE = (f"rid long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         f"base array<{_SPAN}>, entities array<long>")


def _found(rows: DataFrame) -> DataFrame:
    """Base spans and distinct entities of (rid, doc_id, text) rows; no text in the result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("rid", pa.int64()), ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()),
            ("base", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))),
            ("entities", pa.list_(pa.int64()))])
        for b in batches:
            out = []
            for rid, doc_id, text in zip(b.column("rid").to_pylist(), b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                t = text.as_py() or ""
                spans = base_spans(t)
                digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
                counts = [sum(k == x for _, _, x in spans) for k in KINDS]
                out.append((rid, doc_id, *counts, digest, [{"start": s, "end": e, "kind": k} for s, e, k in spans],
                            _entities(t, spans)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return rows.mapInArrow(run, _BASE)


class _Sums:
    """Counts by one or two numbers as key, folded whenever a million came in."""

    def __init__(self, width: int):
        self.kept = [np.zeros(0, np.int64)] * (width + 1)
        self.parts, self.size = [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size > 1_000_000:
            self.fold()

    def fold(self) -> None:
        *keys, n = (np.concatenate(c) for c in zip(self.kept, *self.parts, strict=True))
        self.parts, self.size = [], 0
        if not len(n):
            return
        order = np.lexsort(keys)
        keys, n = [k[order] for k in keys], n[order]
        new = np.ones(len(n), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        at = np.flatnonzero(new)
        self.kept = [*[k[at] for k in keys], np.add.reduceat(n, at)]

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What was counted, as (e, t, n) rows; counting starts anew."""
        self.fold()
        n = len(self.kept[0])
        for i in range(0, n, 200_000):
            cols = [pa.array(c[i:i + 200_000]) for c in self.kept]
            if len(cols) == 2:
                cols.insert(0, pa.nulls(len(cols[0]), pa.int64()))
            yield pa.RecordBatch.from_arrays(cols, names=["e", "t", "n"])
        self.kept = [c[:0] for c in self.kept]


def term_counts(docs: DataFrame) -> DataFrame:
    """(e, t, n): documents with each entity and term, and (null, t, n) with each term, summed in every task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, pair = _Sums(1), _Sums(2)
        for b in batches:
            texts = b.column("text")
            for lo, hi, data, off in utf8_chunks(texts):
                s, e, row = runs(data, off, ~LETTER)
                h, row = distinct_per_row(span_hashes(prefix_sums(data), s, e), row)
                h = h.view(np.int64)
                single.add(*np.unique(h, return_counts=True))
                edge = np.searchsorted(row, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    t = data[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace")
                    mine = h[edge[i]:edge[i + 1]]
                    for ent in _entities(t, base_spans(t)):
                        pair.add(np.full(len(mine), ent, np.int64), mine, np.ones(len(mine), np.int64))
                        if len(pair.kept[0]) > 2_000_000:      # bounded memory: hand over and start anew
                            yield from pair.rows()
                if len(single.kept[0]) > 2_000_000:
                    yield from single.rows()
        yield from single.rows()
        yield from pair.rows()

    return docs.select("text").mapInArrow(run, "e long, t long, n long").groupBy("e", "t").agg(F.sum("n").alias("n"))


def _filter_of(terms: DataFrame) -> np.ndarray:
    """A Bloom filter of the terms ``t`` with two bits each: 32 bits a term, FILTER_BITS at most."""
    bits = min(FILTER_BITS, 1 << max(10, (32 * terms.count()).bit_length()))
    two = terms.select(F.explode(F.array("t", F.shiftrightunsigned("t", 32))).alias("p")).select(
        F.col("p").bitwiseAND(F.lit(bits - 1)).alias("p"))
    words = two.groupBy(F.shiftright("p", 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    out = np.zeros(bits // 64, np.int64)
    for r in words.collect():          # at most FILTER_BITS / 64 rows
        out[r.i] = r.b
    return out.view(np.uint64)


def _in_filter(wanted: np.ndarray, h: np.ndarray) -> np.ndarray:
    six, mask, one = np.uint64(6), np.uint64(64 * len(wanted) - 1), np.uint64(1)
    p, q = h & mask, (h >> np.uint64(32)) & mask
    return (wanted[p >> six] >> (p & np.uint64(63)) & wanted[q >> six] >> (q & np.uint64(63)) & one).astype(bool)


def _occurrences(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(rid, t, start, end) in code points of all terms that the filter lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid = np.asarray(b.column("rid"))
            for lo, _, data, off in utf8_chunks(b.column("text")):
                s, e, row = runs(data, off, ~LETTER)
                h = span_hashes(prefix_sums(data), s, e)
                hit = np.flatnonzero(_in_filter(wanted, h))
                if not len(hit):
                    continue
                signs = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])      # code points before each byte
                s, e, row = s[hit], e[hit], row[hit]
                first = signs[off[row]]
                cols = [rid[lo + row], h[hit].view(np.int64), (signs[s] - first).astype(np.int32), (signs[e] - first).astype(np.int32)]
                for i in range(0, len(hit), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i:i + 200_000]) for c in cols], names=["rid", "t", "start", "end"])

    return docs.select(F.col("__rid").alias("rid"), "text").mapInArrow(run, "rid long, t long, start int, end int")


def _chance(n: float, n_e: Column, n_t: Column, n_et: Column) -> Column:
    """A bound (Chernoff, Hoeffding) of the probability that independent ``e`` and ``t`` share ``n_et`` documents or more.

    Either set of documents may be seen as the one drawn; the lower bound holds.  A single document shared by one
    entity and one term of one document each gives 1 / N, which is exact.
    """
    def bound(drawn: Column, marked: Column) -> Column:
        x, q = n_et / drawn, marked / F.lit(n)
        rest = F.when(x < 1, (1 - x) * F.log((1 - x) / (1 - q))).otherwise(0.0)
        return F.when(x > q, F.exp(-drawn * (x * F.log(x / q) + rest))).otherwise(1.0)
    return F.least(bound(n_e, n_t), bound(n_t, n_e))


def _identified(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__rid", F.xxhash64("doc_id", "text"))


def detect(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """One row per document: base counts, their digest, and all spans with the terms that disclose an entity.

    Columns rid (equal for repeated rows only), doc_id, n_*, base_sha256 and
    all_spans (start, end, kind), kind being a base kind, ``term`` (to be
    generalised) or ``removed``.  A null text is empty; a null doc_id stays null.
    """
    ship_package(docs.sparkSession)
    base = landed(_found(_identified(docs).select(F.col("__rid").alias("rid"), "doc_id", "text")), "pii-base")
    counts = landed(term_counts(docs), "pii-counts")
    entities = base.select(F.explode("entities").alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("n_e"))
    pairs = counts.where("e is not null").withColumnRenamed("n", "n_et").join(entities, "e")
    pairs = pairs.join(counts.where("e is null").select("t", F.col("n").alias("n_t")), "t")
    n = base.count()
    pmi = F.log2(F.lit(float(n)) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    own = F.log2(F.lit(float(n)) / F.col("n_e"))
    strength = F.when(own > 0, pmi / own).otherwise(0.0)
    chance = _chance(float(n), F.col("n_e"), F.col("n_t"), F.col("n_et"))
    tests = F.when(F.col("n_et") == F.col("n_t"), 1.0).otherwise(float(counts.where("e is null").count()))
    disclosing = landed(pairs.withColumn("strength", strength).where((F.col("strength") >= generalise) & (chance * tests <= CHANCE))
                        .groupBy("t").agg(F.max("strength").alias("strength")), "pii-terms")
    spans = (_occurrences(_identified(docs), _filter_of(disclosing)).join(disclosing, "t").groupBy("rid").agg(F.collect_set(F.struct(
        "start", "end", F.when(F.col("strength") >= remove, "removed").otherwise("term").alias("kind"))).alias("terms")))
    # A term inside an entity is part of it.
    terms = F.filter(F.coalesce("terms", F.array().cast(f"array<{_SPAN}>")), lambda x: ~F.exists(
        "base", lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"])))
    rank = {k: i for i, k in enumerate((*KINDS, "term", "removed"))}
    order = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    every = F.array_sort(F.transform(F.concat("base", terms), lambda x: F.struct(
        x["start"].alias("start"), order[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))))
    return base.join(spans, "rid", "left").select(
        "rid", "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
        F.transform(every, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))).alias("all_spans"))


def sanitise_text(t: str, spans: list[tuple[int, int, str]]) -> str:
    """``t`` without its spans: [EMAIL] and the like, [TERM], or nothing for ``removed``; an overlap is cut once."""
    out, at = [], 0
    for s, e, kind in spans:
        if e <= at:
            continue
        if s >= at:
            out += [t[at:s], "" if kind == "removed" else f"[{kind.upper()}]"]
        at = e
    return "".join([*out, t[at:]])


def sanitised(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with sanitised ``text`` (a null text stays null) and, where it has one, the new ``n_chars``; no row is dropped."""
    spans = landed(detect(docs, **options).where(F.size("all_spans") > 0)
                   .select(F.col("rid").alias("__rid"), F.col("all_spans").alias("__spans")).dropDuplicates(["__rid"]), "pii-spans")
    joined = _identified(docs).join(spans, "__rid", "left").drop("__rid")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, s in zip(b.column("text"), b.column("__spans"), strict=True):
                t, s = t.as_py(), s.as_py()
                texts.append(sanitise_text(t, [(x["start"], x["end"], x["kind"]) for x in s]) if t is not None and s else t)
            cols = {c: b.column(c) for c in names} | {"text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)

    out = joined.mapInArrow(run, T.StructType(docs.schema.fields))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op3_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.array_join(F.transform("all_spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return detect(docs).select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", spans.alias("spans"))
