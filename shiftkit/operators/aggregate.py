"""Aggregations used by several jobs (survey 2.4-2.6): W1, A1, A4, A5, A7, A9, K5.

Every grouping here combines map-side (partial aggregation) before the
shuffle: ``min``/``max`` of structs, counts, ``bool_or`` and ``collect_set``
all do.  No window partitions a whole group into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shiftkit.functions.names import col
from shiftkit.functions.text import trim_ws

# Header markers of the inventory rules.
DROP_GROUP_TOKEN = "verketten"
IGNORE_MARKERS = ("ignore.", "ignore_")
DROP_ROW_TYPE = "DROP_ROW"


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row per key by ``order`` (pandas ``drop_duplicates(keep='first')``).

    ``min(struct(order, row))`` per key: a partial aggregate, so a key that
    holds a large share of the rows is reduced in every task before the
    shuffle.  Ties on ``order`` fall to the smallest row.
    """
    others = [c for c in df.columns if c not in keys and c != order]
    picked = df.groupBy(*[col(k) for k in keys]).agg(
        F.min(F.struct(col(order).alias("o"), *[col(c) for c in others])).alias("__first"))
    return picked.select(*[col(k) for k in keys], F.col("__first.o").alias(order),
                         *[F.col("__first")[c].alias(c) for c in others])


def ci_order(a: Column, b: Column) -> Column:
    """Comparator: case-insensitive, then exact text (deterministic ties)."""
    la, lb = F.lower(a), F.lower(b)
    return (F.when(la < lb, -1).when(la > lb, 1)
            .when(a < b, -1).when(a > b, 1).otherwise(0))


def sort_ci(arr: Column) -> Column:
    """T2 on arrays: sort strings case-insensitively."""
    return F.array_sort(arr, ci_order)


def headers_by_type_intent(long: DataFrame, object_type: str = "object_type",
                           file_intent: str = "file_intent", header: str = "header",
                           drop_token: str = DROP_GROUP_TOKEN,
                           ignore_markers: Sequence[str] = IGNORE_MARKERS) -> DataFrame:
    """A4: distinct headers per (object type, intent), case-insensitively sorted.

    Blank, null and ``DROP_ROW`` types are dropped; a group with any header
    containing ``drop_token`` is dropped; headers containing an ignore marker
    are left out; a group left without headers stays as an empty list.
    """
    ot = trim_ws(F.coalesce(col(object_type), F.lit("")))
    h = trim_ws(col(header))
    low = F.lower(h)
    keep = (h != "")
    for m in ignore_markers:
        keep = keep & ~low.contains(m.lower())
    g = (long.select(ot.alias("object_type"),
                     F.coalesce(col(file_intent), F.lit("")).alias("file_intent"),
                     h.alias("__h"), keep.alias("__keep"),
                     F.coalesce(low.contains(drop_token.lower()), F.lit(False)).alias("__drop"))
         .where((F.col("object_type") != "") & (F.upper("object_type") != DROP_ROW_TYPE.upper())))
    agg = g.groupBy("object_type", "file_intent").agg(
        F.bool_or("__drop").alias("__drop"),
        F.collect_set(F.when(F.col("__keep"), F.col("__h"))).alias("headers"))
    return agg.where(~F.col("__drop")).select("object_type", "file_intent",
                                             sort_ci(F.col("headers")).alias("headers"))


def wide_heads(df: DataFrame, array_col: str = "headers", prefix: str = "HEAD",
               width: int | None = None) -> DataFrame:
    """K5: spread an array column into ``HEAD1..HEADn`` (n = longest array).

    Only the width (one number) is computed on the driver.
    """
    if width is None:
        width = df.agg(F.max(F.size(col(array_col)))).first()[0] or 0
    rest = [col(c) for c in df.columns if c != array_col]
    return df.select(*rest, *[F.try_element_at(col(array_col), F.lit(i + 1)).alias(f"{prefix}{i + 1}")
                              for i in range(width)])


def ordered_union(long: DataFrame, key: str, attr: str, order: Sequence[str]) -> DataFrame:
    """Union of attribute lists per key, first occurrence wins, blanks dropped.

    ``long`` holds one row per (key, list position); ``order`` are the
    columns giving the occurrence order (e.g. export position, column
    position).  Returns ``(key, attr, first)`` with ``first`` the struct of
    the first occurrence; sort by it to get the list.
    """
    a = trim_ws(col(attr))
    return (long.select(col(key).alias(key), a.alias(attr), *[col(o) for o in order])
            .where(F.col(attr) != "")
            .groupBy(key, attr).agg(F.min(F.struct(*[col(o) for o in order])).alias("first")))


def row_count_observed(df: DataFrame, name: str = "row_count") -> tuple[DataFrame, Observation]:
    """A1: count rows in the same pass as the write that consumes ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("row_count")), obs


def outcome_counts(outcomes: DataFrame, by: Sequence[str] = ("run_ts",),
                   status: str = "status", item: str = "file_name",
                   with_items: bool = True, most_items: int | None = None) -> DataFrame:
    """A5: successful / failed / skipped jobs per run, optionally with the item lists.

    The lists hold one entry per job of a run: as many as the run's
    configuration has.  ``most_items`` bounds them to the first so many by
    name, for reports over runs that grow with data; the counts are whole.
    """
    s = col(status)
    aggs = [F.count_if(s == "SUCCESS").alias("successful"),
            F.count_if(s == "FAILED").alias("failed"),
            F.count_if(s == "SKIPPED").alias("skipped")]
    if with_items and most_items is not None:
        return _bounded_lists(outcomes, by, s, item, aggs, most_items)
    if with_items:
        aggs += [F.sort_array(F.collect_list(F.when(s == "SUCCESS", col(item)))).alias("successful_items"),
                 F.sort_array(F.collect_list(F.when(s == "FAILED", col(item)))).alias("failed_items")]
    return outcomes.groupBy(*[col(b) for b in by]).agg(*aggs)


def _bounded_lists(outcomes: DataFrame, by: Sequence[str], s: Column, item: str, aggs: list[Column], most: int) -> DataFrame:
    """Counts, and the first ``most`` items of each list: a window keeps so many per run in every task before the shuffle."""
    from pyspark.sql import Window
    keys = [col(b) for b in by]
    counts = outcomes.groupBy(*keys).agg(*aggs)
    w = Window.partitionBy(*keys, "__s").orderBy("__i")
    top = (outcomes.where(s.isin("SUCCESS", "FAILED") & col(item).isNotNull()).select(*keys, s.alias("__s"), col(item).alias("__i"))
           .withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= most))
    lists = top.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("__s") == "SUCCESS", F.col("__i")))).alias("successful_items"),
        F.sort_array(F.collect_list(F.when(F.col("__s") == "FAILED", F.col("__i")))).alias("failed_items"))
    cond = None
    right = lists.select(*[col(b).alias(f"__{b}") for b in by], "successful_items", "failed_items")
    for b in by:
        c = counts[f"`{b}`"].eqNullSafe(right[f"`__{b}`"])
        cond = c if cond is None else cond & c
    none = F.array().cast("array<string>")
    return counts.join(right, cond, "left").select(*[counts[f"`{b}`"] for b in by], "successful", "failed", "skipped",
                                                   F.coalesce("successful_items", none).alias("successful_items"),
                                                   F.coalesce("failed_items", none).alias("failed_items"))
