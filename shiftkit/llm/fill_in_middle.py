"""Fill-in-middle transformation with a sparse exception index.

A text is cut twice, into prefix, middle and suffix, and put together again
in another order behind three marks.  Cuts are drawn in tokens (or in code
points), texts are handled as UTF-8 bytes, results are stated in code points.
In ASCII text the three are the same arithmetic, so only what differs is
stored: the positions of multibyte characters and the bytes each has beyond
its first.  One search in that list converts a cut either way; everything
between two exceptions is plain arithmetic, and a batch of documents is
converted by one vectorised search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftkit.llm.common import table, utf8_chunks
from shiftkit.session import ship_package

#: Marks before the parts.  A text that holds one is left plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Per cent of documents that are transformed, and per cent of these with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Bytes that a character has beyond its first, by its first byte.
_EXCESS = np.zeros(256, np.int64)
_EXCESS[0xC0:0xE0], _EXCESS[0xE0:0xF0], _EXCESS[0xF0:0xF8] = 1, 2, 3


class Exceptions:
    """The multibyte characters of a run of UTF-8 bytes: where they start and their excess bytes, summed."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)                                  # byte positions
        self.excess = np.concatenate([[0], np.cumsum(_EXCESS[data[self.at]])])
        self.char_at = self.at - self.excess[:-1]                               # code-point positions

    def to_code_points(self, byte: np.ndarray) -> np.ndarray:
        """Code points before byte positions that start a character (or end the text)."""
        return byte - self.excess[np.searchsorted(self.at, byte, side="left")]

    def to_bytes(self, char: np.ndarray) -> np.ndarray:
        """Byte positions of code-point positions."""
        return char + self.excess[np.searchsorted(self.char_at, char, side="left")]


def token_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where tokens `[A-Za-z]+|[^A-Za-z]` start; no token crosses a row."""
    letter = _ASCII_LETTER[data]
    after_letter = np.zeros(len(data), bool)
    after_letter[1:] = letter[:-1]
    after_letter[offsets[:-1][offsets[:-1] < len(data)]] = False
    return np.flatnonzero(((data & 0xC0) != 0x80) & ~(letter & after_letter))


def _draws(doc_id: Column) -> list[Column]:
    """The first four 8-digit groups of the hex sha256 of `1:` and the decimal id; a null id has no digits."""
    h = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


_SCHEMA = "doc_id {id}, n long, form string, prefix_chars long, middle_chars long, output string"


def transformed(docs: DataFrame, unit: str = "tokens") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row of ``docs`` (doc_id, text; others are ignored).

    ``n`` counts the units of the whole text, ``tokens`` or ``code points``;
    the cuts fall after h1 % (n + 1) and h2 % (n + 1) of them.  A null text is
    empty, a null id draws as one without digits, repeated rows give equal
    rows, an empty table none.  A text that is empty, holds a mark or is not
    drawn stays ``plain``.
    """
    if unit not in ("tokens", "code points"):
        raise ValueError(f"unknown unit {unit!r}")
    ship_package(docs.sparkSession)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    share, spm_share = TRANSFORMED, SUFFIX_FIRST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, s, m = marks
        for batch in batches:
            for lo, hi, data, off in utf8_chunks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                h = [np.array(part.column(f"h{i}")) for i in range(1, 5)]
                index = Exceptions(data)
                row_chars = index.to_code_points(off)
                if unit == "tokens":
                    starts = np.append(token_starts(data, off), len(data))
                    first = np.searchsorted(starts[:-1], off)
                    n = np.diff(first)
                    of_unit = lambda k: np.where(k < n, starts[np.minimum(first[:-1] + k, len(starts) - 1)], off[1:])  # noqa: B023, E731
                else:
                    n = np.diff(row_chars)
                    of_unit = lambda k: index.to_bytes(row_chars[:-1] + k)                                             # noqa: B023, E731
                a, b = h[0] % (n + 1), h[1] % (n + 1)
                c1, c2 = of_unit(np.minimum(a, b)), of_unit(np.maximum(a, b))
                prefix = index.to_code_points(c1) - row_chars[:-1]
                middle = index.to_code_points(c2) - index.to_code_points(c1)
                raw = data.tobytes()
                forms, outputs = [], []
                for i in range(hi - lo):
                    o, e, x, y = off[i], off[i + 1], c1[i], c2[i]
                    text = raw[o:e]
                    if not text or h[2][i] % 100 >= share or p in text or s in text or m in text:
                        forms.append("plain")
                        outputs.append(text)
                    elif h[3][i] % 100 < spm_share:
                        forms.append("spm")
                        outputs.append(b"".join((s, raw[y:e], p, raw[o:x], m, raw[x:y])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((p, raw[o:x], s, raw[y:e], m, raw[x:y])))
                plain = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                     pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain),
                     pa.array(outputs, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select("doc_id", "text", *_draws(F.col("doc_id")))
    return rows.mapInArrow(run, _SCHEMA.format(id=docs.schema["doc_id"].dataType.simpleString()))


def restored(output: Column, form: Column) -> Column:
    """The exact text, rebuilt from an output and its form alone: no part holds a mark, so splitting at marks finds the parts."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, third = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, third, second))
            .when(form == "spm", F.concat(second, third, first)).otherwise(output))


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    out = transformed(table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (
  SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS toks,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, len(toks) AS n, least(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS a, greatest(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, coalesce(array_to_string(list_slice(toks, 1, a), ''), '') AS pre,
         coalesce(array_to_string(list_slice(toks, a + 1, b), ''), '') AS mid,
         coalesce(array_to_string(list_slice(toks, b + 1, n), ''), '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
