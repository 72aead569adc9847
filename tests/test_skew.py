"""Hot keys: one owner / one id / one group holds most rows.

The joins are forced to shuffle (no broadcast) and AQE's skew thresholds are
lowered so the skew-split path actually runs; results must not change.
"""

import contextlib

from pyspark.sql import functions as F

from shiftkit.operators.aggregate import keep_first
from shiftkit.plans.bridge import bridge_denormalize, bridge_rekey, rekey_coverage
from shiftkit.plans.changes import apply_change_set, change_results
from tests.conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def fixture(spark, n=3000):
    # 2/3 of the bridge rows belong to owner u0 and tag k0.
    bridge = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.lit("u0")).otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string"))).alias("qms_unit__c"),
        F.when(F.col("id") % 3 != 0, F.lit("k0")).otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("keyword__c"))
    owners = spark.range(50).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("id"),
                                    F.concat(F.lit("Unit "), F.col("id").cast("string")).alias("name__v"))
    tags = spark.range(40).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("id"),
                                  F.concat(F.lit("kw"), F.col("id").cast("string")).alias("name__v"),
                                  F.lit("t").alias("keyword_type__c"))
    t_owners = owners.select(F.concat(F.lit("T"), "id").alias("id"), "name__v")
    t_tags = tags.where("id != 'k7'").select(F.concat(F.lit("K"), "id").alias("id"), "name__v",
                                             "keyword_type__c")
    return bridge, owners, tags, t_owners, t_tags


def test_rekey_under_skew(spark):
    bridge, owners, tags, t_owners, t_tags = fixture(spark)
    bp = bridge_denormalize(bridge, owners, tags)
    plain = rows(bridge_rekey(bp, t_owners, t_tags))
    cov_plain = rekey_coverage(bp, t_owners, t_tags).first()
    with skewed(spark):
        hot = rows(bridge_rekey(bp, t_owners, t_tags))
        cov_hot = rekey_coverage(bp, t_owners, t_tags).first()
    assert hot == plain
    assert tuple(cov_hot) == tuple(cov_plain)
    # 3000 rows, rows of tag k7 (id % 40 == 7 among every third row) are unmatched.
    unmatched = sum(1 for i in range(3000) if i % 3 == 0 and i % 40 == 7)
    assert cov_hot["matched"] == 3000 - unmatched
    assert len(hot) == 3000 - unmatched


def test_changes_and_keep_first_under_skew(spark):
    table = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("name__v"))
    # id "1" repeated 2000 times (fails as duplicate), ids 2..99 once each.
    changes = (spark.range(2000).select(F.lit("1").alias("id"), F.lit("b").alias("name__v"))
               .unionByName(spark.range(2, 100).select(F.col("id").cast("string").alias("id"),
                                                       F.lit("c").alias("name__v"))))
    with skewed(spark):
        res = change_results(table, changes, "update")
        counts = {(r["status"], r["errors"]): r["n"] for r in
                  res.groupBy("status", "errors").agg(F.count(F.lit(1)).alias("n")).collect()}
        new = apply_change_set(table, changes, "update")
        names = {r["id"]: r["name__v"] for r in new.collect()}
        first = keep_first(changes.withColumn("o", F.monotonically_increasing_id()), ["id"], "o")
        n_first = first.count()
    assert counts == {("failure", "duplicate id in change set"): 2000, ("success", None): 98}
    assert names["1"] == "a" and names["0"] == "a" and names["50"] == "c" and len(names) == 100
    assert n_first == 99
