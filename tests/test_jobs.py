"""Versions in buckets, the published run log, page gaps, concurrent runs, bounded reports."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from shiftkit.operators.aggregate import outcome_counts
from shiftkit.plans.changes import apply_change_set, change_results
from shiftkit.plans.runlog import log_run, publish_run, read_run_log, stage_run
from shiftkit.plans.runs import run_exports, run_imports, run_log_from_outcomes
from shiftkit.plans.versions import VersionStore
from shiftkit.sources.config import page_gaps, read_job_configs
from tests.conftest import rows

ORG = "id string, name__v string, state__v string"


# --- versions --------------------------------------------------------------------

def test_a_set_of_24_rows_rewrites_at_most_24_buckets(spark, tmp_dir):
    table = spark.range(60_000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("n"), "id").alias("name__v"), F.lit("on").alias("state__v"))
    changes = spark.createDataFrame([(str(i * 2_500 + 7), None, "off") for i in range(24)], ORG)
    store = VersionStore(spark, f"{tmp_dir}/org")
    assert store.create(table, buckets=300) == 0
    assert store.apply(changes, "update") == 1
    old, new = store.folders(0), store.folders(1)
    changed = [b for b in new if new[b] != old[b]]
    assert 0 < len(changed) <= 24 and set(old) == set(new)
    want = apply_change_set(table, changes, "update")
    assert store.read().exceptAll(want).isEmpty() and want.exceptAll(store.read()).isEmpty()
    assert store.read(0).exceptAll(table).isEmpty() and store.read(0).count() == 60_000
    assert store.versions() == [0, 1]


@pytest.mark.parametrize("operation", ["create", "update", "upsert"])
def test_versions_equal_whole_table_changes(spark, tmp_dir, operation):
    rng = random.Random(operation)
    table = spark.createDataFrame([(str(i), f"n{i}", None if i % 4 else "s") for i in range(50)] + [(None, "null", "x")], ORG)
    store = VersionStore(spark, f"{tmp_dir}/{operation}")
    store.create(table, buckets=7)
    want = table
    for k in range(3):
        changes = spark.createDataFrame([(rng.choice([str(rng.randint(40, 60)), None]), rng.choice([None, f"c{k}"]), "new", f"z{k}", "ign")
                                         for _ in range(12)], f"{ORG}, extra__c string, `ignore.old` string")
        assert rows(store.results(changes, operation)) == rows(change_results(store.read(), changes, operation))
        after = apply_change_set(want, changes, operation)
        want = spark.createDataFrame(after.collect(), after.schema)
        store.apply(changes, operation)
        assert rows(store.read(), *want.columns) == rows(want)


def test_empty_sets_and_repeated_creation(spark, tmp_dir):
    store = VersionStore(spark, f"{tmp_dir}/s")
    with pytest.raises(ValueError):
        store.read()
    store.create(spark.createDataFrame([], ORG), buckets=4)
    assert store.read().count() == 0
    store.apply(spark.createDataFrame([], ORG), "upsert")
    store.apply(spark.createDataFrame([("1", "a", None)], ORG), "upsert")
    assert rows(store.read()) == [("1", "a", None)] and store.versions() == [0, 1, 2]
    with pytest.raises(ValueError):
        store.create(spark.createDataFrame([], ORG))


# --- run log --------------------------------------------------------------------------

def log_of(spark, job, ts="2024-01-01 00:00:00"):
    out = spark.createDataFrame([(job, "SUCCESS", "a.csv"), (job, "FAILED", None)], "job string, status string, file_name string")
    return run_log_from_outcomes(out, ts)


def test_two_runs_of_one_time_both_stay_and_a_retry_is_published_once(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    assert read_run_log(spark, path).count() == 0
    dead = stage_run(log_of(spark, "one"), path, "run/1 +%")                # dies before it publishes
    assert read_run_log(spark, path).count() == 0
    assert log_run(log_of(spark, "one"), path, "run/1 +%")
    assert not log_run(log_of(spark, "one"), path, "run/1 +%")              # tried again
    assert not publish_run(spark, path, "run/1 +%", dead)                   # comes too late
    assert log_run(log_of(spark, "two"), path, "run 2")                     # same time and operation
    got = read_run_log(spark, path)
    assert rows(got.groupBy("run_id", "job").count()) == [("run 2", "two", 2), ("run/1 +%", "one", 2)]


def test_an_empty_marker_is_no_publication(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    os.makedirs(f"{path}/published")
    open(f"{path}/published/r", "w").close()
    assert log_run(log_of(spark, "x"), path, "r")
    assert read_run_log(spark, path).count() == 2


# --- pages --------------------------------------------------------------------------------

@pytest.mark.parametrize("span", [7, 10_000])
def test_page_gaps_against_a_model(spark, span):
    rng = random.Random(span)
    pages, want = [], []
    for q in ("a", "b", None):
        total = rng.randint(150, 250)
        mine = [(rng.choice([o, o, o, o + 3, max(0, o - 4)]), rng.choice([10, 10, 10, 0, 17])) for o in range(0, total, 10) if rng.random() < 0.8]
        mine += rng.sample(mine, 4)
        pages += [(q, o, n, total) for o, n in mine]
        seen, counts = 0, {}
        for o, n in mine:
            counts[o, o + n] = counts.get((o, o + n), 0) + (n > 0)
        for (a, b), n in sorted(counts.items()):
            if a == b:
                continue
            if n > 1:
                want.append((q, "repeated", a, b))
            if a > seen:
                want.append((q, "missing", seen, a))
            if a < seen:
                want.append((q, "overlapping", a, min(b, seen)))
            seen = max(seen, b)
        if total > seen:
            want.append((q, "missing", seen, total))
    df = spark.createDataFrame(pages, "query string, offset long, size long, total long").where("query is not null")
    assert rows(page_gaps(df, ["query"], span=span)) == sorted((w for w in want if w[0]), key=repr)


def test_page_gaps_of_one_query_and_of_none(spark):
    schema = "offset long, size long, total long"
    df = spark.createDataFrame([(0, 10, 40), (10, 10, 40), (30, 10, 40)], schema)
    assert rows(page_gaps(df)) == [("missing", 20, 30)]
    assert page_gaps(spark.createDataFrame([], schema)).count() == 0
    assert rows(page_gaps(spark.createDataFrame([(0, 0, 5)], schema))) == [("missing", 0, 5)]


# --- runs ------------------------------------------------------------------------------------

def write_config(tmp_dir, config):
    os.makedirs(f"{tmp_dir}/cfg", exist_ok=True)
    with open(f"{tmp_dir}/cfg/job.json", "w") as fh:
        json.dump(config, fh)


def test_twenty_exports_side_by_side_log_as_one_after_the_other(spark, tmp_dir):
    units = spark.range(200).select(F.col("id"), (F.col("id") % 7).alias("kind"))
    write_config(tmp_dir, {"export_settings": [{"dns": "https://a"}, {"dns": "https://b"}], "exports": [
        {"name": f"e{k}", "params": f"-export unit__c -csv e{k}.csv", "where": f"kind = {k}" if k % 5 else "nothing = 1", "columns": ["id"],
         "active": k % 6 and 1} for k in range(20)]})
    configs = read_job_configs(spark, f"{tmp_dir}/cfg")
    logs = [run_exports(spark, configs, lambda o: units, f"{tmp_dir}/out{p}", "2024-01-01 00:00:00", parallel=p, log_path=f"{tmp_dir}/log{p}", run_id="r")
            for p in (1, 6)]
    fields = ["job", "op", "object_name", "status", "file_name", "row_count", "reasons"]
    one, six = ([tuple(r) for r in x.select(*fields).collect()] for x in logs)
    assert one == six and len(one) == 16 * 2 + 4
    assert read_run_log(spark, f"{tmp_dir}/log6").count() == len(one)


def test_imports_of_two_objects_side_by_side_keep_their_order(spark, tmp_dir):
    def changes(base, file):
        return spark.createDataFrame([("1", file, None), (file, "new", "s")], ORG)
    tables = {"a__c": spark.createDataFrame([("1", "A", "s")], ORG), "b__c": spark.createDataFrame([("1", "B", "s")], ORG)}
    imports = [{"name": "same", "params": f"-upsert {o} -csv {o}_{k}.csv"} for k in range(3) for o in tables]
    imports.append({"name": "bad", "params": "-create a__c -csv again.csv"})
    write_config(tmp_dir, {"imports": imports})
    configs = read_job_configs(spark, f"{tmp_dir}/cfg")
    stores = {o: VersionStore(spark, f"{tmp_dir}/store/{o}") for o in tables}
    for o, t in tables.items():
        stores[o].create(t, buckets=5)
    logs = []
    for p, store in ((1, None), (4, None), (4, stores.get)):
        out = f"{tmp_dir}/out{p}{store is None}"
        log = run_imports(spark, configs, changes, tables.get, out, "2024-01-01 00:00:00", parallel=p, store_of=store)
        logs.append([tuple(r)[1:-1] for r in log.collect()])
        # Each import has an outcome folder of its own, each version stays.
        assert len(os.listdir(f"{out}/outcomes/job.json")) == 7
    assert logs[0] == logs[1] == logs[2] and [r[3] for r in logs[0]] == ["SUCCESS"] * 6 + ["FAILED"]
    for o in tables:
        last = spark.read.parquet(f"{tmp_dir}/out4True/tables/{o}/same_2")
        assert {r["id"]: r["name__v"] for r in last.collect()}["1"] == f"{o}_2.csv"
        assert spark.read.parquet(f"{tmp_dir}/out4True/tables/{o}/same").count() == 2
        assert {r["id"]: r["name__v"] for r in stores[o].read().collect()}["1"] == f"{o}_2.csv"


def test_bounded_lists_of_a_summary(spark):
    st = spark.createDataFrame([("r", "SUCCESS", f"f{i}") for i in range(9)] + [("r", "FAILED", None), (None, "FAILED", "x"), ("s", "SKIPPED", None)],
                               "run string, status string, file_name string")
    got = rows(outcome_counts(st, by=["run"], most_items=3))
    assert got == sorted([("r", 9, 1, 0, ["f0", "f1", "f2"], []), (None, 0, 1, 0, [], ["x"]), ("s", 0, 0, 1, [], [])], key=repr)
