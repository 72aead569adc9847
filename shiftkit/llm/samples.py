"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_ids(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` training ids of each label (doc_id, y), and how many there are in all.

    Ids are chosen by hash, so the sample does not depend on the order of rows.
    Rows without id or with a label other than 0 and 1 are not used; an
    id labelled twice counts with its largest label.  Only ids are joined here.
    """
    y = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & allowed)
         .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    y = y.join(docs.select("doc_id").distinct(), "doc_id")
    n = {r.y: r.n for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [r for c in (0, 1) for r in
              y.where(F.col("y") == c).orderBy(F.xxhash64("doc_id", F.lit(31)), "doc_id").limit(per_class).collect()]
    schema = "doc_id long, y int, half int"
    spark = docs.sparkSession
    return spark.createDataFrame([(r.doc_id, r.y, i % 2) for i, r in enumerate(chosen)], schema), n
