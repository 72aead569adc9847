"""Projections and filters (survey 2.2): P1, P2, P4, P5, P7, P9-P12.

P3 (relation paths) is in :mod:`shiftkit.operators.joins`; P6 and P8 work on
names and live in :mod:`shiftkit.functions.names`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftkit.functions.names import IGNORE_PREFIX, col, rename_keep_existing


def project_columns(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Keep the listed columns in the given order; empty or None keeps all."""
    if not columns:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    return df.select(*[col(c) for c in columns])


def where_filter(df: DataFrame, where: str | Column | None) -> DataFrame:
    """Source-side filter given as a Spark SQL expression (or a Column).

    ``=``, ``>=``, ``AND``, booleans, ``contains(a, b)`` and ``IS NOT NULL``
    are all plain Spark SQL, so no parser is needed; Catalyst pushes what it
    can into the scan.
    """
    if where is None or (isinstance(where, str) and not where.strip()):
        return df
    return df.where(F.expr(where) if isinstance(where, str) else where)


def mark_ignored(df: DataFrame, columns: Sequence[str] | None,
                 prefix: str = IGNORE_PREFIX) -> DataFrame:
    """Rename ``c`` to ``ignore.c`` for listed columns; absent names skipped."""
    return rename_keep_existing(df, {c: prefix + c for c in (columns or ())})


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P5: drop the listed columns that exist (dotted names taken literally).

    Written as a projection of the remaining columns, so a name such as
    ``qms_unit__c.id`` is never read as struct access.
    """
    gone = set(columns)
    if not gone.intersection(df.columns):
        return df
    return df.select(*[col(c) for c in df.columns if c not in gone])


def project_final(df: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Exactly these columns in this order.

    ``strict`` raises on a missing name; otherwise a missing column is null
    (pandas ``reindex``).
    """
    missing = [c for c in columns if c not in df.columns]
    if strict and missing:
        raise ValueError(f"columns not in the table: {missing}")
    return df.select(*[col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in columns])


def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is null."""
    return df.where(col(key).isNotNull())


def is_active(active: Column | str = "active") -> Column:
    """P10 predicate: a definition is active unless ``active`` is 0 (default 1)."""
    a = col(active) if isinstance(active, str) else active
    return F.coalesce(a.cast("int"), F.lit(1)) != 0


def active_filter(defs: DataFrame, active: str = "active") -> DataFrame:
    """P10: keep active definitions."""
    return defs.where(is_active(active))


def derive_change_columns(df: DataFrame, id_col: str, name_col: str, state_col: str,
                          name_prefix: str, new_state: str,
                          current_name: str = "ignore.current_name",
                          current_state: str = "ignore.current_state__v") -> DataFrame:
    """Rename by prefix and set a state; old values ride along as ignore-columns."""
    return df.select(
        col(id_col).alias("id"),
        col(name_col).alias(current_name),
        F.concat(F.lit(name_prefix), col(name_col)).alias(name_col),
        col(state_col).alias(current_state),
        F.lit(new_state).alias(state_col),
    )


def ci_contains(c: Column | str, token: str) -> Column:
    """P12 predicate: case-insensitive ``LIKE '%token%'``."""
    x = col(c) if isinstance(c, str) else c
    return F.lower(x).contains(token.lower())


def ci_like_filter(df: DataFrame, column: str, token: str) -> DataFrame:
    """Keep rows whose column contains ``token`` in any case."""
    return df.where(ci_contains(column, token))
