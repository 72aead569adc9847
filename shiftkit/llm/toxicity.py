"""Toxicity with noisy-channel deobfuscation.

Words written with digits and signs for letters, spaced out or with repeated
letters are read as lattices: every sign may stand for some letters or for
nothing, a repeated letter for one or two, a gap between single letters for
nothing or a word end.  An exact Viterbi search under a character trigram
model of the corpus restores the likeliest words, and they are scored
together with the plain ones.  Scores come from word and word-stem
weights learnt from labelled documents and a logistic calibration.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftkit.llm.common import LETTER, crc_mod, distinct_per_row, mix, prefix_sums, runs, span_hashes, table, utf8_chunks
from shiftkit.llm.logistic import Logistic
from shiftkit.llm.samples import labelled_ids
from shiftkit.session import ship_package

#: Bounds: labelled documents of each kind used for fitting, and features kept.
TRAIN_DOCS = 20_000
CANDIDATES = 50_000
STEMS = (4, 5, 6)
#: What a sign may stand for in place of a letter.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
READINGS = 3                                        # kept for each of the 28 * 28 states of the model
LONG = 512                                          # steps from which texts are kept as linked pieces, not copied on
_SUBSTITUTE, _DROP, _REPEAT = -1.0, -2.5, -1.5      # log10 channel costs
_PRIME = (1 << 61) - 1
_BYTES = 28                                          # 0: word end, 1-26: a-z, 27: any other byte

_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in SIGNS]] = True
#: Where a token has more than one reading: repeats, and whatever is not a letter.
_CHOICE = re.compile("(.)\\1+|[^a-z\x80-\U0010ffff]", re.DOTALL)
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = _CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = 27


# --- the character model ------------------------------------------------------

def char_counts(docs: DataFrame) -> np.ndarray:
    """Character trigram counts of the words of all documents; 28**3 numbers from each task meet as rows."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_BYTES ** 3, np.int64)
        for b in batches:
            for _, _, data, off in utf8_chunks(b.column("text")):
                c = np.zeros(len(data) + len(off) + 3, np.int64)
                at = np.arange(len(data)) + np.repeat(np.arange(len(off) - 1), np.diff(off)) + 2
                c[at] = _CLASS[data]                 # a word end stands between documents
                t = (c[:-2] * _BYTES + c[1:-1]) * _BYTES + c[2:]
                inside = (c[2:] > 0) | (c[1:-1] > 0)
                start = (c[1:-1] == 0) & (c[2:] > 0)  # the first letter of a word has no word before it
                t[start] %= _BYTES
                total += np.bincount(t[inside], minlength=len(total))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total[k], pa.int64())], names=["t", "n"])

    out = np.zeros(_BYTES ** 3)
    for r in docs.select("text").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).collect():
        out[r.t] = r.n
    return out


class CharModel:
    """Interpolated trigram log10 probabilities of letters within words."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(_BYTES, _BYTES, _BYTES)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 1) / (c1.sum() + _BYTES)
        p2 = (c2 + 8 * p1) / (c2.sum(1, keepdims=True) + 8)
        p3 = (c3 + 8 * p2) / (c3.sum(2, keepdims=True) + 8)
        self.logp = np.log10(p3).tolist()

    def readings(self, token: str) -> list[str]:
        """The likeliest plain texts that ``token`` may stand for, with a blank where one word ends and the next begins.

        A blank in ``token`` is a gap between spaced letters.  The search is
        exact: every state (the last two letters) keeps its READINGS best texts.
        In long tokens a text is a link to the one that it goes on, told apart
        by a 61-bit hash, so the time is that of the steps alone.
        """
        steps: list[list[tuple[str, float]]] = []
        i, n_texts = 0, 1
        for m in _CHOICE.finditer(token):
            if m.start() > i:
                steps.append([(token[i:m.start()], 0.0)])
            i = m.end()
            ch, n = token[m.start()], i - m.start()
            if ch == " ":
                steps.append([("", 0.0), (" ", 0.0)])
            elif "a" <= ch <= "z" or ord(ch) >= 128:
                steps.append([(ch * 2, 0.0 if n == 2 else _REPEAT), (ch, _REPEAT if n == 2 else 0.0)])
            else:
                one = [(x, _SUBSTITUTE) for x in SIGNS.get(ch, "")]
                two = [(x * 2, 2 * c) for x, c in one] if n > 1 else []
                steps.append([*one, *two, ("", _DROP if one else 0.0)])
            n_texts *= len(steps[-1])
        steps.append([(token[i:], 0.0)])
        if n_texts <= READINGS and " " not in token:         # nothing to choose
            return [t for t in dict.fromkeys("".join(x for x, _ in way) for way in product(*steps)) if t]
        if len(steps) > LONG:
            return self._linked(steps)
        states: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
        for options in steps:
            nxt: dict[tuple[int, int], dict[str, float]] = {}
            for (a, b), texts in states.items():
                for letters, channel in options:
                    x, y, total = a, b, channel
                    for ch in letters:
                        if ch == " ":
                            if y:                        # a word end, and the next word has nothing before it
                                total += self.logp[x][y][0]
                            x, y = 0, 0
                            continue
                        z = ord(ch) - 96 if "a" <= ch <= "z" else 27
                        total += self.logp[x][y][z]
                        x, y = y, z
                    best = nxt.setdefault((x, y), {})
                    for cost, done in texts:
                        text = done if letters == " " and (not done or done[-1] == " ") else done + letters
                        if cost + total > best.get(text, -1e30):
                            best[text] = cost + total
            states = {k: [(c, t) for t, c in sorted(v.items(), key=lambda tc: (-tc[1], tc[0]))[:READINGS]] for k, v in nxt.items()}
        ends: dict[str, float] = {}
        for (a, b), texts in states.items():
            for cost, text in texts:
                text, cost = text.strip(), cost + (self.logp[a][b][0] if b else 0.0)
                ends[text] = max(cost, ends.get(text, -1e30))
        return [t for t, _ in sorted(ends.items(), key=lambda tc: (-tc[1], tc[0]))[:READINGS] if t]

    def _linked(self, steps: list[list[tuple[str, float]]]) -> list[str]:
        """The search of :meth:`readings` over texts as links (text before, letters)."""
        # A text: its cost, hash, whether a blank would add nothing, and its link.
        states = {(0, 0): [(0.0, 0, True, None)]}
        for options in steps:
            nxt: dict[tuple[int, int], dict[int, tuple]] = {}
            for (a, b), texts in states.items():
                for letters, channel in options:
                    x, y, total = a, b, channel
                    for ch in letters:
                        if ch == " ":
                            if y:
                                total += self.logp[x][y][0]
                            x, y = 0, 0
                            continue
                        z = ord(ch) - 96 if "a" <= ch <= "z" else 27
                        total += self.logp[x][y][z]
                        x, y = y, z
                    best = nxt.setdefault((x, y), {})
                    for cost, key, blank, link in texts:
                        if letters and not (letters == " " and blank):
                            for ch in letters:
                                key = (key * 1_000_003 + ord(ch) + 1) % _PRIME
                            blank, link = letters[-1] == " ", (link, letters)
                        if key not in best or cost + total > best[key][0]:
                            best[key] = (cost + total, key, blank, link)
            states = {k: sorted(v.values(), key=lambda t: (-t[0], t[1]))[:READINGS] for k, v in nxt.items()}
        found = sorted(((cost + (self.logp[a][b][0] if b else 0.0), key, link) for (a, b), texts in states.items() for cost, key, _, link in texts),
                       key=lambda t: (-t[0], t[1]))
        out: dict[str, None] = {}
        for _, _, link in found:
            pieces = []
            while link is not None:
                link, letters = link
                pieces.append(letters)
            if text := "".join(reversed(pieces)).strip():
                out[text] = None
            if len(out) == READINGS:
                break
        return list(out)


# --- features -----------------------------------------------------------------

def suspicious(data: np.ndarray, off: np.ndarray) -> list[tuple[int, str]]:
    """(row, token) of the words that may be disguised, lower-cased; spaced letters are one token with blanks.

    These are words with a sign or separator between letters, a repeated
    letter, or a sign at an end.
    """
    s, e, row = runs(data, off)
    if not len(s):
        return []
    letter, sign = LETTER[data], _SIGN[data]

    def has(flags: np.ndarray) -> np.ndarray:
        p = np.concatenate([[0], np.cumsum(flags)])
        return p[e] - p[s]

    folded = np.where((data >= 65) & (data <= 90), data + 32, data)
    letters, length = has(letter), e - s
    ids = np.repeat(np.arange(len(s)), length)
    change = np.bincount(s, minlength=len(data) + 1) - np.bincount(e, minlength=len(data) + 1)
    inside = np.flatnonzero(np.cumsum(change)[:-1])
    # First and last letter of each word: what is not a letter between them may be a letter or a separator.
    at = inside[letter[inside]]
    of = ids[letter[inside]]
    first, last = np.full(len(s), -1), np.full(len(s), -1)
    first[of[::-1]], last[of] = at[::-1], at
    between = (letters > 0) & (last - first + 1 > letters)
    same = np.zeros(len(data), bool)
    same[1:] = letter[1:] & (data[1:] < 128) & (folded[1:] == folded[:-1])
    # A sign before the first letter or after the last may stand for one, whatever follows it: idio7, idio7! and idio7.
    after = np.minimum(last + 1, len(data) - 1)
    edge = (letters > 0) & (sign[s] | sign[e - 1] | ((last + 1 < e) & sign[after]))
    odd = between | edge | (has(same) > 0)
    found = [(int(row[i]), data[s[i]:e[i]].tobytes().decode("utf-8", "replace").lower()) for i in np.flatnonzero(odd)]
    single = (length == 1) & (letter[s] | sign[s])
    if single.any():
        ends = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
        for a, z in zip(ends[::2], ends[1::2], strict=True):
            for r in np.unique(row[a:z]):
                k = np.flatnonzero(row[a:z] == r) + a
                if len(k) >= 3:
                    found.append((int(r), " ".join(data[s[k]].tobytes().decode("latin-1").lower())))
    return found


def _stem(h: np.ndarray, k: int) -> np.ndarray:
    return mix(h + np.uint64(k))


def _words_and_stems(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s, e, row = runs(data, off, ~LETTER)
    p = prefix_sums(data)
    hs, rows = [span_hashes(p, s, e)], [row]
    for k in STEMS:
        ok = (e - s) > k
        hs.append(_stem(span_hashes(p, s[ok], s[ok] + k), k))
        rows.append(row[ok])
    return np.concatenate(hs), np.concatenate(rows)


def features(data: np.ndarray, off: np.ndarray, read) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (feature hash, row): words, their first bytes, and both of restored words."""
    h, row = _words_and_stems(data, off)
    found = suspicious(data, off)
    if found:
        texts = [read(token) for _, token in found]
        h2, of = _words_and_stems(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
        h, row = np.concatenate([h, h2]), np.concatenate([row, np.array([r for r, _ in found], np.int64)[of]])
    return distinct_per_row(h, row)


def reader(chars: CharModel):
    """token -> its readings as one text, remembered for recurring tokens."""
    @lru_cache(1 << 16)
    def read(token: str) -> bytes:
        return " ".join(chars.readings(token)).encode("utf-8", "replace")
    return read


class ToxicityModel:
    """Feature weights (ascending hashes), the character model and the calibration."""

    def __init__(self, chars: CharModel, hashes: np.ndarray, weights: np.ndarray, constant: float | None = None):
        self.chars, self.hashes, self.weights, self.constant = chars, hashes, weights, constant
        self.calibration: Logistic | None = None

    def doc_features(self, data: np.ndarray, off: np.ndarray, read) -> np.ndarray:
        """Per document: largest weight, log of the sum of weights; both 0 without any known feature, however long the text."""
        n = len(off) - 1
        h, row = features(data, off, read)
        w = np.zeros(len(h))
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            w = np.where(self.hashes[at] == h, self.weights[at], 0.0)
        top = np.zeros(n)
        np.maximum.at(top, row, w)
        total = np.bincount(row, w, n) if len(row) else np.zeros(n)
        return np.column_stack([top, np.log1p(total)])

    def score(self, data, off, read) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(off) - 1, self.constant)
        return self.calibration.predict(self.doc_features(data, off, read))


def _feature_counts(rows: DataFrame, chars: CharModel, only: np.ndarray | None) -> DataFrame:
    """(h, n0, n1): labelled documents of each kind with the feature, summed in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, seen = reader(chars), [[], []]

        def summed(y):
            return np.unique(np.concatenate(seen[y]) if seen[y] else np.zeros(0, np.uint64), return_counts=True)

        for b in batches:
            label = np.array(b.column("y"))
            for lo, _, data, off in utf8_chunks(b.column("text")):
                h, row = features(data, off, read)
                if only is not None:
                    at = np.minimum(np.searchsorted(only, h), len(only) - 1)
                    h, row = h[only[at] == h], row[only[at] == h]
                for y in (0, 1):
                    seen[y].append(h[label[row + lo] == y])
        for y in (0, 1):
            h, n = summed(y)
            for i in range(0, len(h), 100_000):
                m = pa.array(n[i:i + 100_000], pa.int64())
                zero = pa.array(np.zeros(len(m), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(h[i:i + 100_000].view(np.int64)),
                                                  zero if y else m, m if y else zero], names=["h", "n0", "n1"])

    return rows.mapInArrow(run, "h long, n0 long, n1 long").groupBy("h").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> ToxicityModel:
    """Character model of all documents; weights from one half of the labelled sample, calibration from the other.

    Labels are learnt only from rows whose crc32 of the id is not 0 modulo 5.
    If one label is missing, every text scores as the other; without labels, 0.5.
    """
    ship_package(docs.sparkSession)
    chars = CharModel(char_counts(docs))
    ids, n = labelled_ids(docs, labels, "toxic", crc_mod("doc_id", 5) != 0, per_class)
    none = np.zeros(0, np.uint64)
    if not (n.get(0) and n.get(1)):
        return ToxicityModel(chars, none, np.zeros(0), 0.5 if not n else float(n.get(1, 0) > 0))
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")      # at most 2 * per_class rows
    train = rows.where("half = 0")
    size = {r.y: r.n for r in ids.where("half = 0").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    a, b = size.get(1, 0), size.get(0, 0)
    least = max(3, a // 200)
    frequent = (_feature_counts(train.where("y = 1"), chars, None).where(F.col("n1") >= least)
                .orderBy(F.desc("n1"), "h").limit(CANDIDATES).collect())
    model = ToxicityModel(chars, none, np.zeros(0))
    if frequent:
        only = np.sort(np.array([r.h for r in frequent], np.int64).view(np.uint64))
        n1 = {r.h: r.n1 for r in frequent}
        n0 = {r.h: r.n0 for r in _feature_counts(train.where("y = 0"), chars, only).collect()}
        h = np.array(sorted(n1), np.int64)
        w = np.array([np.log((n1[k] + 0.5) / (a + 1)) - np.log((n0.get(k, 0) + 0.5) / (b + 1)) for k in sorted(n1)])
        keep = w > 1.5
        order = np.argsort(h[keep].view(np.uint64))
        model = ToxicityModel(chars, h[keep].view(np.uint64)[order], w[keep][order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader(model.chars)
        for batch in batches:
            for lo, hi, data, off in utf8_chunks(batch.column("text")):
                x = model.doc_features(data, off, read)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("y").slice(lo, hi - lo), pa.array(x[:, 0]), pa.array(x[:, 1])], names=["y", "a", "b"])

    cal = rows.where("half = 1").mapInArrow(run, "y int, a double, b double").collect()
    y = np.array([r.y for r in cal])
    if len(set(y.tolist())) < 2:
        model.constant = n[1] / (n[0] + n[1])
        return model
    share = n[1] / (n[0] + n[1])
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    model.calibration = Logistic(np.array([[r.a, r.b] for r in cal]), y, weight, ridge=0.1)
    return model


def scored(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` with the toxicity of its ``text`` (0 to 1); a null text is empty, a column called ``name`` is replaced."""
    ship_package(docs.sparkSession)
    rest = [f for f in docs.schema.fields if f.name != name]
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader(model.chars)
        for b in batches:
            for lo, hi, data, off in utf8_chunks(b.column("text")):
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(model.score(data, off, read))],
                                                 names=[*names, name])

    return docs.mapInArrow(run, T.StructType([*rest, T.StructField(name, T.DoubleType())]))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
