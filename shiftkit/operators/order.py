"""Ordering helpers (survey 2.6): T2, T4, T5 and a distributed row number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftkit.functions.names import col


def ci_sort_keys(columns: Sequence[str]) -> list[Column]:
    """Order by lower-cased values, exact text breaking ties."""
    keys: list[Column] = []
    for c in columns:
        keys += [F.lower(F.coalesce(col(c), F.lit(""))), col(c)]
    return keys


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_id",
                      start: int = 1) -> DataFrame:
    """Row numbers in a global order without a single-partition window.

    The frame is range-partitioned and sorted; ``monotonically_increasing_id``
    then encodes (partition, position).  Per-partition counts (one row per
    partition) give each partition its offset, so every row is numbered in
    its own task and only the counts meet in one place.  The ordered rows are
    checkpointed to the shared checkpoint folder with their (partition,
    position) first: range boundaries are sampled anew whenever the frame is
    evaluated, so counts and numbers must both come from the one landed copy.
    """
    from pyspark.sql import Window
    from shiftkit.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    n = max(1, df.sparkSession.sparkContext.defaultParallelism)
    ordered = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
               .withColumn("__mid", F.monotonically_increasing_id())
               .checkpoint(eager=True))
    part, pos = F.shiftright("__mid", 33), F.col("__mid").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: this window is as small as the partition count.
    offsets = counts.select("__part", (F.sum("__n").over(
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"))
    return (ordered.join(F.broadcast(offsets), part == F.col("__part"))
            .withColumn(name, F.coalesce("__off", F.lit(0)) + pos + F.lit(start))
            .drop("__mid", "__part", "__off"))


def preview(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """T4: the first ``n`` rows by an explicit order (a top-n, not a sample)."""
    return df.orderBy(*order).limit(n)


def load_order(defs: DataFrame, array_col: str, name: str = "LoadOrderNr") -> DataFrame:
    """T5: one row per array element with its position from 1."""
    rest = [col(c) for c in defs.columns if c != array_col]
    return defs.select(*rest, F.posexplode(col(array_col)).alias("__pos", "__item")).select(
        *rest, (F.col("__pos") + 1).alias(name), F.col("__item"))
