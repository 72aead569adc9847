"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct five-word shingle hash below a fraction of the
hash range: the fixed one, 1/SCALE, or for texts of few shingles the first of
1, 1/2, 1/4, ... that leaves at most FEW of them, so short texts are kept
whole.  These thresholds are nested and depend on the set alone.  Two sketches
are compared at the lower of their thresholds, below which both are complete;
the share of one found in the other estimates containment, whatever their
lengths, without bias, and exactly where nothing was left out.  Sketches merge:
that of two texts' shingles together follows from their sketches.  Everything
here is built from SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
#: Hashes have 48 bits; those below 1/SCALE (a power of two) of the range are kept, or up to FEW below a larger part.
SCALE, FEW = 8, 64
_RANGE = 1 << 48
_SPLIT = r"[\x20\x09-\x0D]+"


def text_words(text: Column) -> Column:
    """Lower-cased words; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPLIT), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """Hashes of all five-word shingles of an array of words; fewer words are one shingle."""
    n = F.size(words)

    def shingle(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]).bitwiseAND(F.lit(_RANGE - 1))

    return F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))), shingle)).when(
        n > 0, F.array(F.xxhash64(F.concat_ws(" ", words)).bitwiseAND(F.lit(_RANGE - 1)))).otherwise(
        F.array().cast("array<bigint>"))


def _scales(scale: int) -> list[int]:
    return [1 << i for i in range(scale.bit_length())]


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def below(hashes: Column, scale: Column) -> Column:
    """Those of the hashes that lie below 1/scale of the range."""
    return F.filter(hashes, lambda h: h * scale < _RANGE)


def _at_threshold(hashes: Column, least: Column, scale: int) -> Column:
    """The sketch of distinct hashes that are complete below 1/least."""
    levels = F.array(*[F.struct(F.lit(s).alias("scale"), below(hashes, F.lit(s)).alias("hashes")) for s in _scales(scale)])

    def first(of: Column) -> Column:
        fine = F.filter(of, lambda x: (x["scale"] >= least) & ((F.size(x["hashes"]) <= FEW) | (x["scale"] == scale)))
        return F.get(fine, F.lit(0))

    return _let(levels, first)


def kept(hashes: Column, scale: int = SCALE) -> Column:
    """The sketch of shingle hashes: ``scale`` and the distinct ``hashes`` below 1/scale, ascending."""
    return _let(F.sort_array(F.array_distinct(hashes)), lambda h: _at_threshold(h, F.lit(1), scale))


def with_sketch(df: DataFrame, text: str, name: str, scale: int = SCALE) -> DataFrame:
    """``df`` with the sketch of column ``text`` as ``name``."""
    w, h = f"__{name}_w", f"__{name}_h"
    return (df.withColumn(w, text_words(F.col(text))).withColumn(h, shingle_hashes(F.col(w))).drop(w)
            .withColumn(name, kept(F.col(h), scale)).drop(h))


def as_text(s: Column) -> Column:
    """A sketch as text: the scale, then 12 hexadecimal digits a hash, ascending; nothing if there is no shingle."""
    digits = F.array_join(F.transform(s["hashes"], lambda h: F.lpad(F.hex(h), 12, "0")), "")
    return F.when((F.size(s["hashes"]) == 0) & (s["scale"] == 1), F.lit("")).otherwise(
        F.lower(F.concat(s["scale"].cast("string"), F.lit(":"), digits)))


def _common(a: Column, b: Column, then) -> Column:
    """``then`` of the hashes of both below the lower threshold."""
    scale = F.greatest(a["scale"], b["scale"])
    return _let(F.struct(below(a["hashes"], scale).alias("a"), below(b["hashes"], scale).alias("b")), lambda x: then(x["a"], x["b"]))


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts' shingles together."""
    both = F.sort_array(F.array_union(a["hashes"], b["hashes"]))
    return _let(both, lambda h: _at_threshold(h, F.greatest(a["scale"], b["scale"]), scale))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness; two texts without words are alike (1), one of them is not (0)."""
    def of(x: Column, y: Column) -> Column:
        shared = F.size(F.array_intersect(x, y))
        union = F.size(x) + F.size(y) - shared
        empty = (F.size(a["hashes"]) == 0) & (F.size(b["hashes"]) == 0) & (a["scale"] == b["scale"])
        return F.when(union > 0, shared / union).when(empty, F.lit(1.0)).otherwise(F.lit(0.0)).cast("double")

    return _common(a, b, of)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has.

    Nothing is contained in everything (1); so is a text none of whose hashes
    lie below the common threshold, of which the estimate knows nothing (:func:`containment_error`).
    """
    return _common(a, b, lambda x, y: F.when(F.size(x) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / F.size(x)).cast("double"))


def containment_error(a: Column, b: Column, chance: float = 0.05) -> Column:
    """What the estimate of :func:`containment` is off by at most, but for ``chance`` (Hoeffding's bound).

    0 where all of a's hashes are compared, 1 where none is.
    """
    whole = F.greatest(a["scale"], b["scale"]) == 1
    bound = lambda x, y: F.least(F.lit(1.0), F.sqrt(F.lit(math.log(2 / chance)) / (2 * F.size(x))))
    return F.when(whole, F.lit(0.0)).otherwise(_common(a, b, lambda x, y: F.when(F.size(x) == 0, F.lit(1.0)).otherwise(bound(x, y))))


def _bounds(docs: DataFrame, n: int) -> list[int]:
    """At most ``n`` ids that cut the table into about equal ranges, the largest id last."""
    shares = [i / n for i in range(1, n + 1)]
    r = docs.agg(F.percentile_approx("id", shares, 20 * n).alias("p"), F.max("id").alias("m")).first()
    return sorted({*(r.p or []), r.m}) if r.m is not None else []


def with_next(docs: DataFrame, carried: list[str], bounds: list[int]) -> DataFrame:
    """``docs`` with next_<c> of each carried column from the next row by descending ``id``.

    After the last row comes the first.  Rows are dealt to id ranges; the
    largest id of each range is dealt to the range above as well, where it is
    the row after the smallest one.  So no window holds more than a range, and
    the ranges follow the ids' own quantiles.  Equal ids follow in the order of ``tie``.
    """
    bounds = bounds or [0]
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i:i + step] for i in range(0, len(bounds), step)]

    def under(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < F.col("id")))

    ends = F.array(*[F.lit(p[-1]).cast("long") for p in parts])
    inner = F.array(*[F.array(*[F.lit(b).cast("long") for b in p]) for p in parts])
    placed = docs.withColumn("part", under(ends)).withColumn("in_part", F.get(inner, F.col("part")))
    placed = placed.withColumn("range", F.col("part") * step + under(F.col("in_part")))
    edge = F.get(F.col("in_part"), F.col("range") - F.col("part") * step) == F.col("id")
    last = F.col("range") == len(bounds) - 1

    def spot(r: Column, ghost: int, wrap: Column) -> Column:
        return F.struct(r.cast("int").alias("range"), F.lit(ghost).alias("ghost"), wrap.cast("int").alias("wrap"))

    own = spot(F.col("range"), 0, F.lit(0))
    ghost = spot(F.when(last, 0).otherwise(F.col("range") + 1), 1, F.when(last, 1).otherwise(0))
    dealt = placed.withColumn("spot", F.explode(F.when(edge, F.array(own, ghost)).otherwise(F.array(own))))
    w = Window.partitionBy("spot.range").orderBy("spot.wrap", F.col("id").desc(), "tie")
    return (dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
            .where("spot.ghost = 0").drop("part", "in_part", "range", "spot"))


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """One row per document: its sketch, that of its edited text, and how alike they and the next document's are.

    ``docs`` has doc_id and text; other columns are ignored.  A null text is
    empty; a null doc_id comes after all others; repeated ids follow each
    other in the order of their texts' hashes; a single document is its own
    next; an empty table gives no rows.
    """
    base = docs.select("doc_id", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("long").alias("id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    base = with_sketch(base.withColumn("tie", F.xxhash64("text")), "text", "sketch", scale)
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("long").alias("id"))
    both = with_next(base, ["text", "sketch"], _bounds(ids, ranges))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    both = both.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half),
                                              F.substring("next_text", F.lit(1), half)))
    both = with_sketch(both, "edited", "edited_sketch", scale)
    return both.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_in_edited"),
        containment_error(F.col("sketch"), F.col("edited_sketch")).alias("kept_in_edited_error"))


def op2_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
