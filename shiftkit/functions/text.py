"""Text expressions: Python-style strip, whitespace collapse, error masking.

All of these are built-in Spark expressions (JVM side, whole-stage codegen);
none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() / str.isspace() treat as whitespace that
# Java's \s does not: FS/GS/RS/US, NEL and the Unicode separators.
WS_CLASS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"

# Every character for which Python's str.isspace() is true
# (the set str.strip() removes), in code-point order.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")

# Fixed value: an object id is 15 letters or digits.
OBJECT_ID_PATTERN = r"^[A-Za-z0-9]{15}$"


def _c(c: Column | str) -> Column:
    from shiftkit.functions.names import col
    return col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Python ``str.strip()`` (Spark ``trim`` removes blanks only).

    ``btrim`` with Python's whitespace set: no regular expression.
    """
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def collapse_ws(c: Column | str) -> Column:
    """whitespace runs to one blank, then strip."""
    return trim_ws(F.regexp_replace(_c(c), rf"{WS_CLASS}+", " "))


def blank_to_null(c: Column | str) -> Column:
    """Python-falsy text: '' and whitespace-only become null."""
    t = trim_ws(c)
    return F.when(t != "", _c(c))


def mask_bracketed(c: Column | str) -> Column:
    """F8: mask bracket contents in an error text.

    A bracket unit runs from the first ``[`` after the previous unit to the
    next ``]`` (so ``[a [b]`` is one unit with content ``a [b``).  With an
    ``=`` in the stripped content the unit becomes ``[key=***]`` (key = text
    before the first ``=``); a content that is exactly one 15-character id
    becomes ``[***]``; any other unit is kept.  Splitting on ``]`` gives the
    units directly: in each piece but the last, the text after the first
    ``[`` is a unit's content.  Works on the whole text, no length bound.
    """
    text = _c(c)
    pieces = F.split(text, r"\]", -1)
    n = F.size(pieces)

    def piece(seg: Column, i: Column) -> Column:
        open_at = F.instr(seg, "[")
        before = F.substring_index(seg, "[", 1)
        content = trim_ws(F.substr(seg, open_at + 1))
        masked = (
            F.when(F.instr(content, "=") > 0,
                   F.concat(before, F.lit("["), F.substring_index(content, "=", 1), F.lit("=***]")))
            .when(content.rlike(OBJECT_ID_PATTERN), F.concat(before, F.lit("[***]")))
            .otherwise(F.concat(seg, F.lit("]")))
        )
        return (F.when(i == n - 1, seg)
                .when(open_at == 0, F.concat(seg, F.lit("]")))
                .otherwise(masked))

    return (F.when(text.isNull(), None)
            .when(F.instr(text, "[") == 0, text)          # nothing to mask
            .otherwise(F.array_join(F.transform(pieces, piece), "")))


def normalize_error(c: Column | str) -> Column:
    """F8 then F9: the error type used for counting."""
    return collapse_ws(mask_bracketed(c))


def normalize_object_type(c: Column | str) -> Column:
    """strip, lower-case, collapse runs of ``_``."""
    return F.regexp_replace(F.lower(trim_ws(c)), "_+", "_")


def business_key(name: Column | str, kind: Column | str) -> Column:
    """text key ``strip(name)_strip(type)``; null when a part is null."""
    return F.concat(trim_ws(name), F.lit("_"), trim_ws(kind))
