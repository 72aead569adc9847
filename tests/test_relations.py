"""Relation paths in export definitions, against plain Python."""

import json
import os

import pytest

from shiftkit.plans.relations import Relation, relations_of, resolve_export

RELATIONS = {"order__c": [Relation("customer__c", "customer__c"), Relation("agent__c", "person", "pid", "agent")],
             "customer__c": [Relation("nation__c", "nation__c"), Relation("head__c", "person", "pid")]}
ORDERS = [(i, [1, 2, 3, None, 99][i % 5], [7, None, 8][i % 3], "OFP"[i % 3], i * 10.0) for i in range(30)]
CUSTOMERS = [(1, "Ann", 10, 7), (2, "Bob", None, 8), (3, "Cyd", 11, None), (4, "Dan", 10, 7)]
NATIONS = [(10, "N10"), (11, None)]
PERSONS = [(7, "Seven"), (8, "Eight")]


@pytest.fixture(scope="module")
def objects(spark):
    return {"order__c": spark.createDataFrame(ORDERS, "id int, customer__c int, agent__c int, state__v string, total__c double"),
            "customer__c": spark.createDataFrame(CUSTOMERS, "id int, name__v string, nation__c int, head__c int"),
            "nation__c": spark.createDataFrame(NATIONS, "id int, name__v string"),
            "person": spark.createDataFrame(PERSONS, "pid int, name__v string")}


def model():
    cust, nat, per = ({r[0]: r for r in t} for t in (CUSTOMERS, NATIONS, PERSONS))
    for o in ORDERS:
        c = cust.get(o[1], (None,) * 4)
        n, h, a = nat.get(c[2], (None,) * 2), per.get(c[3], (None,) * 2), per.get(o[2], (None,) * 2)
        yield {"id": o[0], "state": o[3], "total": o[4], "customer": o[1], "cname": c[1], "nname": n[1], "hname": h[1], "aname": a[1]}


CASES = [
    (None, lambda m: True),
    ("customer__cr.name__v = 'Ann'", lambda m: m["cname"] == "Ann"),
    ("customer__cr.nation__cr.name__v = 'N10' AND state__v = 'O'", lambda m: m["nname"] == "N10" and m["state"] == "O"),
    ("customer__cr.nation__cr.name__v IS NULL", lambda m: m["nname"] is None),
    ("coalesce(customer__cr.name__v, 'x') = 'x'", lambda m: m["cname"] is None),
    ("customer__cr.head__cr.name__v = 'Seven' AND agent.name__v = 'Eight'", lambda m: m["hname"] == "Seven" and m["aname"] == "Eight"),
    ("customer__cr.name__v = 'Ann' OR agent.name__v = 'Eight'", lambda m: m["cname"] == "Ann" or m["aname"] == "Eight"),
    ("customer__c.name__v IN ('Ann', 'a.b AND c.d') AND total__c >= 50", lambda m: m["cname"] == "Ann" and m["total"] >= 50),
    ("customer__cr.name__v = 'Bob' AND customer__cr.nation__cr.name__v IS NULL", lambda m: m["cname"] == "Bob" and m["nname"] is None),
    ("total__c < 100 AND agent.name__v LIKE 'Sev%'", lambda m: m["total"] < 100 and m["aname"] == "Seven"),
]


@pytest.mark.parametrize("where,keeps", CASES)
@pytest.mark.parametrize("columns,want", [
    (["id"], lambda m: (m["id"],)),
    (["customer__cr.nation__cr.name__v", "id", "customer__c", "customer__c.name__v", "customer__cr.head__cr.name__v"],
     lambda m: (m["nname"], m["id"], m["customer"], m["cname"], m["hname"])),
    (["agent.name__v", "id"], lambda m: (m["aname"], m["id"]))])
def test_paths_in_columns_and_filters(objects, where, keeps, columns, want):
    got = resolve_export(objects["order__c"], "order__c", objects.__getitem__, RELATIONS, where, columns, ["id"])
    assert got.columns == ["ignore.id" if c == "id" else c for c in columns]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((want(m) for m in model() if keeps(m)), key=repr)


def test_only_filtered_relations_are_semi_joins_and_parents_are_pruned(spark, tmp_dir):
    paths = {}
    for name, rows, schema in (("order__c", ORDERS, "id int, customer__c int, agent__c int, state__v string, total__c double"),
                               ("customer__c", CUSTOMERS, "id int, name__v string, nation__c int, head__c int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}")
        paths[name] = f"{tmp_dir}/{name}"
    read = lambda o: spark.read.parquet(paths[o])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    semi = plan(resolve_export(read("order__c"), "order__c", read, RELATIONS, "customer__cr.name__v = 'Ann'", ["id"]))
    assert "LeftSemi" in semi and "EqualTo(name__v,Ann)" in semi and "head__c" not in semi and "total__c" not in semi
    once = plan(resolve_export(read("order__c"), "order__c", read, RELATIONS, "customer__cr.name__v = 'Ann'",
                               ["id", "customer__cr.head__c", "customer__c.name__v"]))
    assert once.count("Join") == 1 and "EqualTo(name__v,Ann)" in once and "nation__c" not in once


def test_unknown_names_raise(objects):
    table, read = objects["order__c"], objects.__getitem__
    for where, columns, text in ((None, ["supplier__cr.name__v"], "unknown relationship supplier__cr"), (None, ["nothing"], "nothing"),
                                 ("customer__cr.nothing__cr.x = 1", ["id"], "unknown relationship nothing__cr"),
                                 (None, ["customer__cr.nothing"], "no field"), ("customer__c = 1 AND customer__c.name__v = 'Ann'", ["customer__cr.name__v"], "both a column")):
        with pytest.raises(ValueError, match=text):
            resolve_export(table, "order__c", read, RELATIONS, where, columns)


def test_flattened_columns_and_structs_are_taken_as_they_are(spark):
    df = spark.createDataFrame([(1, "A", (5,)), (2, "B", (6,))], "id int, `x__cr.name__v` string, s struct<n: int>")
    got = resolve_export(df, "t", None, {}, "s.n = 5", ["x__cr.name__v", "id"])
    assert [tuple(r) for r in got.collect()] == [("A", 1)]


def test_run_exports_with_relations_from_a_catalogue(spark, objects, tmp_dir):
    from shiftkit.plans.runs import run_exports
    from shiftkit.sources.config import read_job_configs
    os.makedirs(f"{tmp_dir}/cfg")
    exports = [{"name": "good", "params": "-export order__c -csv a.csv", "where": "customer__cr.nation__cr.name__v = 'N10'",
                "columns": ["id", "customer__cr.name__v"], "active": 1},
               {"name": "bad", "params": "-export order__c -csv b.csv", "columns": ["id", "nowhere__cr.name__v"], "active": 1}]
    with open(f"{tmp_dir}/cfg/job.json", "w") as fh:
        json.dump({"export_settings": {"dns": "https://x"}, "exports": exports}, fh)
    catalogue = spark.createDataFrame([("order__c", "customer__c", "customer__c"), ("customer__c", "nation__c", "nation__c")],
                                      "object string, fk string, parent string")
    log = run_exports(spark, read_job_configs(spark, f"{tmp_dir}/cfg"), objects.__getitem__, f"{tmp_dir}/out", "2024-01-01 00:00:00",
                      relations=relations_of(catalogue))
    got = {r.job: (r.status, r.row_count) for r in log.collect()}
    assert got == {"good": ("SUCCESS", sum(m["nname"] == "N10" for m in model())), "bad": ("FAILED", None)}
