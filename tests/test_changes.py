from pyspark.sql import functions as F

from shiftkit.plans.changes import apply_change_set, change_results, derive_archive_set
from tests.conftest import rows


def table(spark):
    return spark.createDataFrame(
        [("A", "Acme", "active"), ("B", "Beta", "active"), ("C", "Gamma", "initiated")],
        "id string, name__v string, state__v string")


def changes(spark):
    return spark.createDataFrame(
        [("A", "Acme", "ZZ_Acme", "archived"), ("B", None, "ZZ_Beta", "archived"),
         ("B", None, "ZZ_Beta2", "archived"), ("X", None, "New X", None), (None, None, "No id", "s")],
        "id string, `ignore.current_name` string, name__v string, state__v string")


def test_update(spark):
    res = change_results(table(spark), changes(spark), "update")
    got = {(r["id"], r["name__v"]): (r["status"], r["errors"]) for r in res.collect()}
    assert got[("A", "ZZ_Acme")] == ("success", None)
    assert got[("B", "ZZ_Beta")] == ("failure", "duplicate id in change set")
    assert got[("X", "New X")] == ("failure", "record not found")
    assert got[(None, "No id")] == ("failure", "id is missing")
    new = apply_change_set(table(spark), changes(spark), "update")
    assert new.columns == ["id", "name__v", "state__v"]
    assert rows(new) == sorted([("A", "ZZ_Acme", "archived"), ("B", "Beta", "active"),
                                ("C", "Gamma", "initiated")], key=repr)


def test_create_and_upsert(spark):
    new = apply_change_set(table(spark), changes(spark), "create")
    assert ("X", "New X", None) in rows(new) and ("A", "Acme", "active") in rows(new)
    assert (None, "No id", "s") in rows(new)
    up = apply_change_set(table(spark), changes(spark), "upsert")
    got = rows(up)
    assert ("A", "ZZ_Acme", "archived") in got and ("X", "New X", None) in got
    assert ("B", "Beta", "active") in got


def test_derive_archive_set(spark):
    orgs = spark.createDataFrame(
        [("o1", "Acme-like AG", "initiated", "t1"), ("o2", "OTHER", "initiated", "t1"),
         ("o3", "the acme-like unit", "active", "t2"), ("o4", "ACME-LIKE x", "active", "t9")],
        "id string, name__v string, state__v string, object_type__v string")
    types = spark.createDataFrame([("t1", "External Site"), ("t2", "Internal")], "id string, name__v string")
    out = derive_archive_set(orgs, types, name_token="acme-like", type_value="External Site",
                             name_prefix="ZZ_", new_state="retired_state__c")
    assert out.columns == ["id", "ignore.current_name", "name__v", "ignore.current_state__v", "state__v"]
    assert rows(out) == [("o1", "Acme-like AG", "ZZ_Acme-like AG", "initiated", "retired_state__c")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan   # the right-side filter makes the join inner
