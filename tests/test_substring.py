"""Outcome files by substring: against all pairs, and what goes through the shuffle."""

import pytest
from pyspark.sql import functions as F

from shiftkit.plans.runs import reconcile_imports

FILES = ["load_1_SUCCESS.csv", "load_12_FAILURE.csv", "load_12_SUCCESS.csv", "load_12_SUCCESS.csv", "xload_123_SUCCESS.csv", "aaaa_SUCCESS.csv",
         "ÄÖ é_FAILURE.csv", "a_FAILURE.csv", "load_load_1_SUCCESS.csv", "plain.csv", "_SUCCESS.csv", "", None]
STEMS = ["load_1", "load_12", "load_12", "load_123", "load_1234", "a", "aa", "aaa", "aaaaa", "Ö é", "é", "SUCCESS", "_", "oad", "", None, "load_1_SUCCESS"]


@pytest.fixture
def without_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pairs_are_all_pairs(spark):
    from shiftkit.operators.joins import substring_pairs
    items = spark.createDataFrame([(i, t) for i, t in enumerate(FILES)], "id int, name string")
    patterns = spark.createDataFrame([(s,) for s in STEMS], "p string")
    got = [tuple(r) for r in substring_pairs(items, "name", patterns, "p").collect()]
    assert sorted(got) == sorted((i, t, p) for i, t in enumerate(FILES) for p in {s for s in STEMS if s} if t and p in t)


def test_reconciled_by_substring_as_by_all_pairs(spark, without_broadcasts):
    stems = [s for s in STEMS if s]
    jobs = spark.createDataFrame([(s, i % 5) for i, s in enumerate(stems)], "job string, active int")
    files = spark.createDataFrame([(f and f"/landing/{f}",) for f in FILES], "path string")
    out = reconcile_imports(jobs, files, exact=False)
    want = []
    for i, s in enumerate(stems):
        hits = {o: [f for f in FILES if f and f.endswith(f"_{o}.csv") and s in f] for o in ("FAILURE", "SUCCESS")}
        status = "FAILED" if hits["FAILURE"] or not hits["SUCCESS"] else "SUCCESS"
        want.append((s, s, status, min(hits["FAILURE"] or hits["SUCCESS"], default=None)) if i % 5 else (s, s, "SKIPPED", None))
    assert sorted(map(tuple, out.select("job", "stem", "status", "file_name").collect()), key=repr) == sorted(want, key=repr)


def test_file_names_are_not_shuffled_by_all_their_grams(spark, without_broadcasts):
    jobs = spark.range(2_000).select(F.concat(F.lit("load_"), "id").alias("job"), F.lit(1).alias("active"))
    files = spark.range(2_000).select(F.concat(F.lit("/landing/load_"), "id", F.lit("_SUCCESS.csv")).alias("path"))
    out = reconcile_imports(jobs, files, exact=False)
    assert out.where("status = 'SUCCESS'").count() == 2_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sent and not [line for line in sent if "__gram" in line]
    from shiftkit.operators.joins import possible_patterns
    names = files.select(F.substring_index("path", "/", -1).alias("name"))
    assert possible_patterns(names, "name", jobs, "job").count() <= 4 * 2_000        # at most one for each length of the stems
