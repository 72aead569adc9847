"""Packing by optimal length buckets.

The histogram of document lengths is summed over the whole corpus.  A dynamic
program over it picks the bucket boundaries that leave the fewest padding
tokens when each document is padded to its bucket's boundary.  Inside each
bucket, documents are numbered and cut into batches of at most a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftkit.llm.common import WORD, landed

N_BUCKETS = 16
TOKEN_BUDGET = 16_384
#: Lengths up to this are cells of their own in the histogram; above, a cell is 1/256 of a power of two,
#: so the histogram has a bounded number of rows for lengths of any size.  A cell stands for its longest document.
EXACT_LENGTH = 65_536
SHARD_ROWS = 2_000


def cell(n: Column) -> Column:
    """The histogram's cell of a length: its upper end (1 at least)."""
    n = F.greatest(n, F.lit(1)).cast("long")
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(n.cast("double"))) - 8, F.lit(0))).cast("long")
    return F.when(n <= EXACT_LENGTH, n).otherwise(F.ceil(n / step).cast("long") * step)


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, k: int) -> list[int]:
    """At most ``k`` boundaries of the ascending ``lengths`` with least total padding.

    cost(i, j) pads the documents i..j to lengths[j].  best[b][j] is the least
    cost of the first j lengths in b buckets; the best split point moves
    monotonically with j, so each layer is solved by halving, with
    O(L log L) steps.
    """
    n = len(lengths)
    if n == 0:
        return []
    lengths = np.asarray(lengths, np.float64)
    c = np.concatenate([[0.0], np.cumsum(counts, dtype=np.float64)])
    best = np.concatenate([[0.0], lengths * c[1:]])
    cuts = []
    for _ in range(1, min(k, n)):
        nxt, cut = best.copy(), np.arange(n + 1)
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, a, z = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(z, j - 1) + 1)
            cost = best[i] + lengths[j - 1] * (c[j] - c[i])
            at = int(np.argmin(cost))
            nxt[j], cut[j] = cost[at], i[at]
            todo += [(lo, j - 1, a, int(i[at])), (j + 1, hi, int(i[at]), z)]
        best = nxt
        cuts.append(cut)
    out, j = [], n
    for cut in reversed(cuts):
        out.append(int(lengths[j - 1]))
        j = int(cut[j])
        if j == 0:
            break
    if j:
        out.append(int(lengths[j - 1]))
    return sorted(set(out))


def pack(docs: DataFrame, n_buckets: int = N_BUCKETS, token_budget: int = TOKEN_BUDGET,
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket, padded_length, batch_id, position, padding.

    Tokens are words.  A null or empty text has 0 tokens and goes to the first
    bucket.  A batch holds as many documents as fit the budget when padded,
    one at least: a document longer than the budget is a batch of its own.
    Documents are numbered in shards of a bucket of about ``shard_rows`` rows (as many
    shards as the histogram says, so a bucket with a third of all rows is
    spread like any other); the shards' counts give each its offset.  Repeated rows
    and null ids are packed like any other row.  An empty table gives no rows.
    """
    rows = docs.select(
        "doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        F.xxhash64("doc_id", "text").alias("h"))
    rows = landed(rows, "pack-lengths")
    # Bounded: EXACT_LENGTH rows, and 256 for each doubling above.  No document is padded beyond a real length.
    longest = F.greatest(F.max("n_tokens"), F.lit(1)).alias("longest")
    hist = sorted((r.longest, r.n) for r in rows.groupBy(cell(F.col("n_tokens")).alias("cell")).agg(longest, F.count(F.lit(1)).alias("n")).collect())
    lengths, counts = np.array([g for g, _ in hist], np.int64), np.array([n for _, n in hist], np.int64)
    ends = optimal_boundaries(lengths, counts, n_buckets)
    if not ends:
        ends = [1]
    bucket_of = np.searchsorted(ends, lengths)
    shards = [max(1, -(-int(counts[bucket_of == b].sum()) // shard_rows)) for b in range(len(ends))]
    bounds = F.array(*[F.lit(int(x)).cast("long") for x in ends])
    rows = rows.withColumn("bucket", F.size(F.filter(bounds, lambda e: e < F.col("n_tokens"))))
    rows = rows.withColumn("padded_length", F.element_at(bounds, F.col("bucket") + 1))
    per = F.element_at(F.array(*[F.lit(s).cast("long") for s in shards]), F.col("bucket") + 1)
    # A shard of its own number of rows, ties and repeated rows by the row's hash and a fixed spread of the id.
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("h", F.lit(7)), per))
    sizes = rows.groupBy("bucket", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket", "shard").orderBy("doc_id", "h", "n_tokens")
    numbered = (rows.withColumn("rn", F.row_number().over(inside).cast("long") - 1)
                .join(offsets, ["bucket", "shard"]).withColumn("i", F.col("rn") + F.col("offset")))
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(token_budget) / F.col("padded_length")))
    return numbered.select(
        "doc_id", "n_tokens", F.col("bucket").cast("int").alias("bucket"), "padded_length",
        F.concat_ws("-", F.col("bucket"), F.floor(F.col("i") / room)).alias("batch_id"),
        F.pmod(F.col("i"), room).alias("position"), (F.col("padded_length") - F.col("n_tokens")).alias("padding"))


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
