"""Mixing sources to target weights by nested hash thresholds.

Every document has a fixed 63-bit hash.  Words are summed by source and by
the first 12 hash bits; the running sum over those at most 4,096 buckets of a
source shows in which bucket its budget ends.  Only that bucket is summed
again by its next 12 bits, and only the documents of that one small bucket
are looked at singly.  The result is one hash threshold per source, so the
corpus is filtered by a comparison and never sorted.  A target above the
source's size takes every document once and lets the threshold choose those
that are taken once more, so the thresholds are nested: a larger target keeps
every document of a smaller one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftkit.llm.common import WORD, landed

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
_BITS = 12


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` as (row, source, k, size, u): its columns in a struct, source key, words, hash.

    A null text has size 0; a null source is a source of its own.  Repeated
    rows share a hash and are taken or left together.
    """
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source",
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("k"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1).alias("u"))


def source_targets(sums: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """Targets of (k, source, source_size) rows.

    Sources in code point order, null last, weigh ``weights`` in turn and
    share ``share`` of all words; none goes above ``cap`` times its size, and
    what is over goes to the others by weight.  That settles at one level L
    with target = least(cap * size, L * weight): L is the largest of the levels
    that result from capping the first 0, 1, 2... sources in order of
    cap * size / weight.  One row per source meets in these windows.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    s = sums.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int")))
    s = s.withColumn("top", F.lit(float(cap)) * F.col("source_size"))
    order = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("top").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    s = s.withColumn("level", (total - before) / rest)
    return s.withColumn("target", F.least("top", F.col("weight") * F.max("level").over(everything))).select(
        "k", "source", "source_size", "target")


def _cut(sums: DataFrame, left: DataFrame, key: str) -> DataFrame:
    """(k, key, left): the first bucket of each source that its budget does not cover, and what is left for it."""
    w = Window.partitionBy("k").orderBy(key)
    run = sums.join(left, "k").withColumn("upto", F.sum("words").over(w))
    return (run.where("upto > left").groupBy("k")
            .agg(F.min(F.struct(key, (F.col("left") - F.col("upto") + F.col("words")).alias("left"))).alias("c"))
            .select("k", f"c.{key}", "c.left"))


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(k, source_size, target, full, below): copies of every document, and of those hashed under ``below``.

    ``rows`` has k, size and u; it should be a landed table, as it is read
    four times.
    """
    plan = targets.withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                              .otherwise(0).cast("long"))
    plan = landed(plan.withColumn("left", F.col("target") - F.col("full") * F.col("source_size")), "mix-plan")
    budgets = plan.select("k", "left")
    top = 63 - _BITS
    b1 = F.shiftright("u", top).alias("b1")
    first = landed(_cut(rows.groupBy("k", b1).agg(F.sum("size").alias("words")), budgets, "b1"), "mix-cut1")
    inside = (rows.withColumn("b1", F.shiftright("u", top)).join(first, ["k", "b1"])
              .withColumn("b2", F.shiftright("u", top - _BITS)))
    second = landed(_cut(inside.groupBy("k", "b2").agg(F.sum("size").alias("words")),
                         first.select("k", "left"), "b2"), "mix-cut2")
    last = (rows.withColumn("b2", F.shiftright("u", top - _BITS)).join(second, ["k", "b2"])
            .groupBy("k", "u", "left").agg(F.sum("size").alias("words")))
    w = Window.partitionBy("k").orderBy("u")
    # The document at the edge is taken if that comes nearer to the budget.
    over = (last.withColumn("upto", F.sum("words").over(w))
            .where(F.col("upto") - F.col("words") / 2 > F.col("left"))
            .groupBy("k").agg(F.min("u").alias("stop")))
    edge = second.join(over, "k", "left").select("k", F.coalesce(
        "stop", F.shiftleft(F.col("b2") + 1, top - _BITS)).alias("below"))
    # Without a cut the budget covers the whole source (or there is nothing to take).
    return plan.join(edge, "k", "left").select(
        "k", "source_size", "target", "full",
        F.coalesce("below", F.when(F.col("left") > 0, F.lit((1 << 63) - 1)).otherwise(0)).alias("below"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(row, size, source_size, target, copies): how often the mix takes each document.

    ``docs`` has doc_id, text and source; any other column travels in the
    struct ``row``, whatever its name.  Only ids, sizes and hashes are landed
    for the histograms; texts are read twice and never shuffled but for the
    join with the small table of thresholds.  An empty table gives an empty
    mix, a source without words is not taken at all.
    """
    rows = sized(docs)
    small = landed(rows.select("source", "k", "size", "u"), "mix-sizes")
    return _copies(rows, _plan(small, weights, share, cap))


def _plan(small: DataFrame, weights, share, cap) -> DataFrame:
    sums = small.groupBy("k").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    return landed(thresholds(small, source_targets(sums, weights, share, cap)), "mix-thresholds")


def _copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    return rows.join(plan, "k").withColumn(
        "copies", F.when(F.col("size") > 0, F.col("full") + F.when(F.col("u") < F.col("below"), 1).otherwise(0))
        .otherwise(0).cast("long"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: ``docs`` with a document repeated as often as it is taken."""
    m = mix(docs, **options).where("copies > 0")
    return m.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def op8_mixing_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    small = landed(sized(docs).select(F.col("row.doc_id").alias("doc_id"), "source", "k", "size", "u"), "mix-sizes")
    m = _copies(small, _plan(small, WEIGHTS, SHARE, CAP))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                    "source", "copies")
