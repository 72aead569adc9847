"""Column names: quoting, normalisation (F1) and required-column resolution.

Object exports use dotted names (``ignore.id``, ``org__cr.name__v``).  Spark
reads a dot as struct access, so every reference by name goes through
:func:`col`.  Resolution works on ``df.columns`` only (schema metadata), never
on data.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ignore marker put in front of a column name, and the
# characters removed when names are compared loosely.
IGNORE_PREFIX = "ignore."


def quote(name: str) -> str:
    """Backtick-quote a column name so dots are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def normalize_column_name(name: object) -> str:
    """F1 on a name: strip, lower-case, drop ``ignore.``, drop blank . _ -."""
    return re.sub(r"[ ._-]", "", str(name).strip().lower().replace(IGNORE_PREFIX, ""))


def normalize_column_name_expr(c: Column) -> Column:
    """F1 as a column expression (for names held in data, e.g. header scans)."""
    from shiftkit.functions.text import trim_ws
    return F.regexp_replace(F.replace(F.lower(trim_ws(c)), F.lit(IGNORE_PREFIX), F.lit("")),
                            r"[ ._-]", "")


class ColumnResolutionError(ValueError):
    """Raised when a required column has no unique best match."""


def candidate_columns(expected: str, available: Sequence[str],
                      aliases: Iterable[str] = ()) -> list[tuple[int, str]]:
    """Ranked candidates: 0 exact/alias, 1 case-insensitive, 2 normalised."""
    wanted = [expected, *aliases]
    folded = [w.strip().lower() for w in wanted]
    target = normalize_column_name(expected)

    def standing(c: str) -> tuple[int, int] | None:
        if c in wanted:
            return 0, wanted.index(c)
        if c.strip().lower() in folded:
            return 1, folded.index(c.strip().lower())
        return (2, 0) if normalize_column_name(c) == target else None

    found = {c: s for c in available if (s := standing(c)) is not None}
    return [(found[c][0], c) for c in sorted(found, key=found.get)]


def resolve_column(df_columns: Sequence[str], label: str, expected: str,
                   aliases: Iterable[str] = (), mapping: Mapping[str, str] | None = None) -> str:
    """P8 for one name.  Exact name wins; else the unique best-ranked candidate.

    Ties at the best rank, or no candidate at all, raise with the candidates
    listed; an explicit ``mapping`` entry overrides the search.
    """
    if mapping and expected in mapping:
        chosen = mapping[expected]
        if chosen not in df_columns:
            raise ColumnResolutionError(f"{label}: mapped column '{chosen}' does not exist")
        return chosen
    if expected in df_columns:
        return expected
    ranked = candidate_columns(expected, df_columns, aliases)
    if not ranked:
        raise ColumnResolutionError(
            f"{label}: required column '{expected}' not found; available: {list(df_columns)}")
    best = min(r for r, _ in ranked)
    top = [c for r, c in ranked if r == best]
    if len(top) > 1:
        raise ColumnResolutionError(
            f"{label}: column '{expected}' is ambiguous; candidates: {top}")
    return top[0]


def resolve_columns(df: DataFrame, label: str, required: Sequence[str | Mapping],
                    mapping: Mapping[str, str] | None = None) -> DataFrame:
    """P8 + P6: resolve every required name and rename in one projection.

    ``required`` items are names or ``{"expected": name, "aliases": [...]}``.
    A name that already exists is kept; the mapped column is then left alone
    (rename never overwrites an existing target).
    """
    renames: dict[str, str] = {}
    for item in required:
        if isinstance(item, str):
            expected, aliases = item, ()
        else:
            expected, aliases = item["expected"], tuple(item.get("aliases", ()))
        chosen = resolve_column(df.columns, label, expected, aliases, mapping)
        if chosen != expected and expected not in df.columns:
            renames[chosen] = expected
    return rename_keep_existing(df, renames)


def rename_keep_existing(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename by map, skipping entries whose source is absent or whose target exists."""
    present = set(df.columns)
    usable = {src: dst for src, dst in renames.items()
              if src in present and src != dst and dst not in present}
    if not usable:
        return df
    return df.select(*[col(c).alias(usable.get(c, c)) for c in df.columns])


def flat_names(df: DataFrame, sep: str = "__") -> DataFrame:
    """Replace dots in column names, for tools that read a dot as nesting."""
    if not any("." in c for c in df.columns):
        return df
    return df.select(*[col(c).alias(c.replace(".", sep)) for c in df.columns])


_HEAD_RE = re.compile(r"HEAD(\d+)")


def head_columns(columns: Iterable[str]) -> list[str]:
    """``HEAD1..HEADn`` names in numeric order."""
    matches = [_HEAD_RE.fullmatch(str(c)) for c in columns]
    return [m[0] for m in sorted(filter(None, matches), key=lambda m: int(m[1]))]
