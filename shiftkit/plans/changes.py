"""Job ``change_set``: derive an update set, then apply create/update/upsert.

The loader that applies change sets in the reference is an external program;
here the row semantics are defined as joins, so the whole application is one
plan over the current table and the change rows:

* a change row whose id occurs more than once in the set fails (``duplicate``),
* update: the id must exist (else ``not found``); non-null values replace
  the old ones, nulls keep them,
* create: the id must not exist (else ``exists``),
* upsert: update where the id exists, create otherwise.

Columns whose name starts with ``ignore.`` travel with the change rows but are
never applied.  Duplicate detection is a ``groupBy(id).count`` joined back,
not a window over ids, so a hot id does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.functions.names import IGNORE_PREFIX, col
from shiftkit.operators.project import ci_contains, derive_change_columns

OPERATIONS = ("create", "update", "upsert")


def derive_archive_set(orgs: DataFrame, types: DataFrame, *, id_col: str = "id",
                       name_col: str = "name__v", state_col: str = "state__v",
                       type_fk: str = "object_type__v", type_id: str = "id",
                       type_name: str = "name__v", name_token: str, type_value: str,
                       name_prefix: str, new_state: str) -> DataFrame:
    """J6 + P11 + P12: the rows to rename and archive.

    ``orgs LEFT JOIN types ... WHERE lower(name) LIKE '%token%' AND
    type.name = value``: the filter on the right side makes the join inner,
    which Catalyst does by itself (EliminateOuterJoin).
    """
    t = types.select(col(type_id).alias("__type_id"), col(type_name).alias("__type_name"))
    joined = orgs.join(t, orgs[f"`{type_fk}`"] == t["__type_id"], "left")
    picked = joined.where(ci_contains(col(name_col), name_token)
                          & (F.col("__type_name") == type_value))
    return derive_change_columns(picked, id_col, name_col, state_col, name_prefix, new_state)


def _applied_columns(changes: DataFrame, id_col: str) -> list[str]:
    return [c for c in changes.columns if c != id_col and not c.startswith(IGNORE_PREFIX)]


def change_results(table: DataFrame, changes: DataFrame, operation: str,
                   id_col: str = "id") -> DataFrame:
    """Per change row: ``status`` (success/failure), ``errors`` and ``action``."""
    if operation not in OPERATIONS:
        raise ValueError(f"operation must be one of {OPERATIONS}")
    counts = changes.groupBy(col(id_col).alias("__cid")).agg(F.count(F.lit(1)).alias("__n"))
    existing = table.select(col(id_col).alias("__tid")).distinct()
    c = (changes.join(counts, changes[f"`{id_col}`"] == counts["__cid"], "left")
                .join(existing, changes[f"`{id_col}`"] == existing["__tid"], "left"))
    exists = F.col("__tid").isNotNull()
    if operation == "update":
        action = F.when(exists, F.lit("update"))
        err = F.when(~exists, F.lit("record not found"))
    elif operation == "create":
        action = F.when(~exists, F.lit("create"))
        err = F.when(exists, F.lit("record already exists"))
    else:
        action = F.when(exists, F.lit("update")).otherwise(F.lit("create"))
        err = F.lit(None).cast("string")
    err = (F.when(col(id_col).isNull() & F.lit(operation != "create"), F.lit("id is missing"))
           .when(F.col("__n") > 1, F.lit("duplicate id in change set"))
           .otherwise(err))
    return c.select(*[col(x) for x in changes.columns],
                    F.when(err.isNull(), action).alias("action"),
                    F.when(err.isNull(), F.lit("success")).otherwise(F.lit("failure")).alias("status"),
                    err.alias("errors"))


def apply_change_set(table: DataFrame, changes: DataFrame, operation: str,
                     id_col: str = "id") -> DataFrame:
    """K2: the new version of ``table`` after the valid change rows.

    One full outer join of the table with the change rows whose id is unique
    in the set: a matched pair is an update (``coalesce(new, old)`` per
    applied column), a change row alone is a create, a table row alone stays.
    Which of these an operation allows decides what survives.  The table is
    read once; the change set twice (rows and the per-id counts).
    """
    if operation not in OPERATIONS:
        raise ValueError(f"operation must be one of {OPERATIONS}")
    cid = changes[f"`{id_col}`"]
    counts = changes.groupBy(cid.alias("__cid")).agg(F.count(F.lit(1)).alias("__n"))
    unique = (changes.join(counts, cid == counts["__cid"], "left")
              .where((F.col("__n") == 1) | cid.isNull() if operation == "create"
                     else F.col("__n") == 1))
    applied = [c for c in _applied_columns(changes, id_col) if c in table.columns]
    new_only = [c for c in _applied_columns(changes, id_col) if c not in table.columns]
    ch = unique.select(cid.alias("__cid"), F.lit(True).alias("__in_changes"),
                       *[col(c).alias(f"__new__{c}") for c in [*applied, *new_only]])
    t = table.withColumn("__in_table", F.lit(True))
    joined = t.join(ch, t[f"`{id_col}`"] == ch["__cid"], "full_outer")
    in_t = F.coalesce(F.col("__in_table"), F.lit(False))
    in_c = F.coalesce(F.col("__in_changes"), F.lit(False))
    do_update = in_t & in_c & F.lit(operation in ("update", "upsert"))
    keep = in_t | (in_c & F.lit(operation in ("create", "upsert")))
    out = []
    for c in table.columns:
        if c == id_col:
            out.append(F.coalesce(col(c), F.col("__cid")).alias(c))
        elif c in applied:
            new_or_old = F.coalesce(F.col(f"`__new__{c}`"), col(c))
            out.append(F.when(do_update, new_or_old).when(in_t, col(c))
                       .otherwise(F.col(f"`__new__{c}`")).alias(c))
        else:
            out.append(col(c))
    for c in new_only:
        out.append(F.when(do_update | ~in_t, F.col(f"`__new__{c}`")).alias(c))
    return joined.where(keep).select(*out)


def change_summary(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of the change results per status and error."""
    return (results.groupBy(*[col(b) for b in by], "status", "errors")
            .agg(F.count(F.lit(1)).alias("n")))
