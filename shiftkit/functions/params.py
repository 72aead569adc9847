"""Expressions over job parameters, file names and instance URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftkit.functions.text import _c, trim_ws

# The loader flags that name the object a job works on, and the
# flag that names its file.
OBJECT_FLAGS = ("export", "create", "update", "upsert", "import")
FILE_FLAG = "csv"

# File-name markers of the load intent, tested in this order
# (case-insensitive); anything else is an addition.
INTENT_MARKERS = (
    ("_upsert_", "upsert"),
    ("_ups_", "upsert"),
    ("_update_", "updated"),
    ("_upd_", "update"),
    ("_add_", "addition"),
)
DEFAULT_INTENT = "addition"

# Outcome-file suffixes written by the loader.
SUCCESS_SUFFIX = "_SUCCESS.csv"
FAILURE_SUFFIX = "_FAILURE.csv"


def _flag_value(params: Column, flags: tuple[str, ...]) -> Column:
    alt = "|".join(flags)
    token = F.regexp_extract(params, rf"(?:^|\s)-(?:{alt})\s+(\S+)", 1)
    # A following flag (template rows such as "-export  -csv ") is no value.
    return F.when((token != "") & ~token.startswith("-"), token).otherwise(F.lit(""))


def object_from_params(params: Column | str, flags: tuple[str, ...] = OBJECT_FLAGS) -> Column:
    """the object after the first load flag (``-export obj``); '' if none."""
    return _flag_value(F.coalesce(_c(params), F.lit("")), flags)


def export_object_from_params(params: Column | str) -> Column:
    """F3 restricted to ``-export`` (the export index uses only this flag)."""
    return object_from_params(params, ("export",))


def file_from_params(params: Column | str) -> Column:
    """the token after ``-csv``; '' if none."""
    return _flag_value(F.coalesce(_c(params), F.lit("")), (FILE_FLAG,))


def second_token(params: Column | str) -> Column:
    """second blank-separated token of the parameter string, null when short."""
    tokens = F.split(trim_ws(_c(params)), r"\s+")
    return F.try_element_at(tokens, F.lit(2))


def file_intent(file_name: Column | str) -> Column:
    """load intent from markers in the file name."""
    low = F.lower(_c(file_name))
    expr = None
    for marker, intent in INTENT_MARKERS:
        expr = (F.when(low.contains(marker), F.lit(intent)) if expr is None
                else expr.when(low.contains(marker), F.lit(intent)))
    return expr.otherwise(F.lit(DEFAULT_INTENT))


def file_name_of(path: Column | str) -> Column:
    """Last path segment (no regex: ``substring_index``)."""
    return F.substring_index(_c(path), "/", -1)


def relative_dir(path: Column | str, root: str) -> Column:
    """folder of ``path`` relative to ``root``; '.' at the root.

    ``root`` is compared without a scheme, so ``file:/a`` and ``/a`` agree.
    """
    bare_root = root.split(":", 1)[1] if root.startswith("file:") else root
    bare_root = "/" + bare_root.strip("/")
    p = F.regexp_replace(F.regexp_replace(_c(path), r"^[a-zA-Z][a-zA-Z0-9+.-]*:", ""), "^/+", "/")
    folder = F.regexp_replace(p, r"/[^/]*$", "")
    rel = F.when(folder.startswith(bare_root),
                 F.regexp_replace(F.substr(folder, F.lit(len(bare_root) + 1)), "^/", ""))
    return F.coalesce(F.nullif(rel, F.lit("")), F.lit("."))


def source_key(url: Column | str) -> Column:
    """instance URL to a folder key (``https://`` dropped, ``/`` to ``_``)."""
    return F.replace(F.replace(_c(url), F.lit("https://"), F.lit("")), F.lit("/"), F.lit("_"))


def normalize_url(url: Column | str) -> Column:
    """``scheme://host`` with ``https`` by default and no path; blank stays ''.

    A value without a host keeps its text without trailing slashes.
    """
    raw = trim_ws(F.coalesce(_c(url), F.lit("")))
    has_scheme = raw.contains("://")
    scheme = F.when(has_scheme, F.regexp_extract(raw, r"^([^:/?#]*)://", 1))
    after = F.when(has_scheme, F.regexp_extract(raw, r"^[^:/?#]*://(.*)$", 1)).otherwise(raw)
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    scheme = F.coalesce(F.nullif(scheme, F.lit("")), F.lit("https"))
    return (F.when(raw == "", F.lit(""))
            .when(host == "", F.regexp_replace(raw, "/+$", ""))
            .otherwise(F.concat(F.lower(scheme), F.lit("://"), host)))


def first_non_blank(*cols: Column | str) -> Column:
    """first of the given columns that is neither null nor ''."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def outcome_status(file_name: Column | str) -> Column:
    """'failure' / 'success' from the loader's file suffix, else null."""
    f = _c(file_name)
    return (F.when(f.endswith(FAILURE_SUFFIX), F.lit("failure"))
            .when(f.endswith(SUCCESS_SUFFIX), F.lit("success")))


def outcome_stem(file_name: Column | str) -> Column:
    """the loader-file stem of an outcome file (``x_FAILURE.csv`` -> ``x``)."""
    f = _c(file_name)
    cut = F.length(f) - len(FAILURE_SUFFIX)
    assert len(FAILURE_SUFFIX) == len(SUCCESS_SUFFIX)
    return F.when(f.endswith(FAILURE_SUFFIX) | f.endswith(SUCCESS_SUFFIX), f.substr(F.lit(1), cut)) \
        .otherwise(f)


def failure_stem(path: Column | str) -> Column:
    """F18 for a path: the stem of a failure file, or null for other files.

    The loader writes ``<stem>_FAILURE.csv`` files; Spark writes a folder of
    that name holding part files (also as a ``key=<stem>_FAILURE.csv``
    partition folder).  Both give ``<stem>``.
    """
    p = _c(path)
    name = file_name_of(p)
    parent = F.substring_index(F.substring_index(p, "/", -2), "/", 1)
    parent = F.substring_index(parent, "=", -1)
    return (F.when(name.endswith(FAILURE_SUFFIX), outcome_stem(name))
            .when(parent.endswith(FAILURE_SUFFIX), outcome_stem(parent)))


def file_stem(path: Column | str) -> Column:
    """Base name without extension (``a/b/x.csv`` -> ``x``)."""
    name = file_name_of(path)
    ext = F.substring_index(name, ".", -1)
    return F.when(name.contains("."), name.substr(F.lit(1), F.length(name) - F.length(ext) - 1)) \
        .otherwise(name)


def columns_display(columns: Column | str) -> Column:
    """configured column list as one comma-joined text."""
    return F.array_join(F.coalesce(_c(columns), F.array().cast("array<string>")), ",")
