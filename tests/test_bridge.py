import pytest

from shiftkit.functions.names import ColumnResolutionError, resolve_columns
from shiftkit.plans.bridge import bridge_denormalize, bridge_rekey, rekey_coverage
from tests.conftest import rows


def src(spark):
    tags = spark.createDataFrame(
        [("k1", "alpha", "type_a", "active"), ("k2", "alpha", "type_b", "active"),
         ("k3", "NA", "type_a", "active"), ("k4", "007", "type_a", None),
         ("k5", None, "type_a", "active"), ("k6", "a_b", "c", "active")],
        "`ignore.id` string, name__v string, keyword_type__c string, state__v string")
    owners = spark.createDataFrame(
        [("u1", "Unit One", "true", "active"), ("u2", " Unit Two ", "true", "active"),
         ("u3", "Unit Three", "false", "active")],
        "`ignore.id` string, name__v string, is_valid__c string, state__v string")
    bridge = spark.createDataFrame(
        [("b1", "u1", "k1"), ("b2", "u1", "k2"), ("b3", "u2", "k3"), ("b4", "u2", "k4"),
         ("b5", "u1", "k1"), ("b6", "u9", "k1"), ("b7", None, "k2"), ("b8", "u1", "k6")],
        "`ignore.id` string, qms_unit__c string, keyword__c string")
    return bridge, owners, tags


def test_denormalize_keeps_bridge_rows(spark):
    bridge, owners, tags = src(spark)
    bp = bridge_denormalize(bridge, owners, tags)
    assert bp.columns == ["qms_unit__c.name__v", "keyword__c.name__v", "keyword_type__c"]
    assert rows(bp) == sorted([
        ("Unit One", "alpha", "type_a"), ("Unit One", "alpha", "type_b"),
        (" Unit Two ", "NA", "type_a"), (" Unit Two ", "007", "type_a"),
        ("Unit One", "alpha", "type_a"),          # duplicate pair kept
        (None, "alpha", "type_a"),                # dangling owner
        (None, "alpha", "type_b"),                # null owner
        ("Unit One", "a_b", "c"),
    ], key=repr)


def target(spark):
    owners = spark.createDataFrame(
        [("T1", "Unit One", "x", "s"), ("T2", "Unit Two", "x", "s"), ("T4", "Unit Four", "x", "s")],
        "id string, name__v string, is_valid__c string, state__v string")
    tags = spark.createDataFrame(
        [("K1", "alpha", "type_a", "s", "extra1"), ("K3", " NA ", "type_a", "s", "extra3"),
         ("K6", "a", "b_c", "s", "extra6")],
        "id string, name__v string, keyword_type__c string, state__v string, other string")
    return owners, tags


def test_rekey(spark):
    bridge, owners, tags = src(spark)
    bp = bridge_denormalize(bridge, owners, tags)
    t_owners, t_tags = target(spark)
    out = bridge_rekey(bp, t_owners, t_tags)
    assert out.columns == ["qms_unit__c", "ignore.qms_unit__c.name__v", "ignore.keyword_helper",
                           "keyword__c", "other"]
    # " Unit Two " does not equal "Unit Two" (names are compared as they are);
    # alpha/type_b has no target tag; a_b/c must not match a/b_c.
    assert rows(out) == sorted([
        ("T1", "Unit One", "alpha_type_a", "K1", "extra1"),
        ("T1", "Unit One", "alpha_type_a", "K1", "extra1"),
    ], key=repr)


def test_rekey_text_key_is_ambiguous(spark):
    bridge, owners, tags = src(spark)
    bp = bridge_denormalize(bridge, owners, tags)
    t_owners, t_tags = target(spark)
    out = bridge_rekey(bp, t_owners, t_tags, key="concat")
    assert ("T1", "Unit One", "a_b_c", "K6", "extra6") in rows(out)


def test_rekey_coverage(spark):
    bridge, owners, tags = src(spark)
    bp = bridge_denormalize(bridge, owners, tags)
    t_owners, t_tags = target(spark)
    cov = rekey_coverage(bp, t_owners, t_tags).first()
    # T1 has 4 blueprint rows (2 match), T2 and T4 none (one row each).
    assert (cov["matched"], cov["total"]) == (2, 6)


def test_resolve_columns(spark):
    df = spark.createDataFrame([("1", "n", "t")], "`Keyword__C.ID` string, `Name__V` string, kt string")
    out = resolve_columns(df, "x", [{"expected": "keyword__c.id", "aliases": ["id"]}, "name__v"])
    assert out.columns == ["keyword__c.id", "name__v", "kt"]
    out = resolve_columns(df, "x", ["keyword_type__c"], mapping={"keyword_type__c": "kt"})
    assert "keyword_type__c" in out.columns
    with pytest.raises(ColumnResolutionError):
        resolve_columns(df, "x", ["missing"])
    amb = spark.createDataFrame([("1", "2")], "`name-v` string, `name.v` string")
    with pytest.raises(ColumnResolutionError, match="ambiguous"):
        resolve_columns(amb, "x", ["name_v"])


def test_dotted_names_are_literal(spark):
    from shiftkit.operators.project import drop_if_present, mark_ignored, project_final
    df = spark.createDataFrame([("1", "a", "b")], "`qms_unit__c.id` string, name__v string, x string")
    assert drop_if_present(df, ["qms_unit__c.id", "absent"]).columns == ["name__v", "x"]
    assert mark_ignored(df, ["name__v", "absent"]).columns == ["qms_unit__c.id", "ignore.name__v", "x"]
    assert project_final(df, ["x", "zz"], strict=False).columns == ["x", "zz"]
    import pytest
    with pytest.raises(ValueError):
        project_final(df, ["zz"])


def test_transfer_equals_two_step(spark):
    from shiftkit.plans.bridge import bridge_transfer
    bridge, owners, tags = src(spark)
    t_owners, t_tags = target(spark)
    for key in ("columns", "concat"):
        two = bridge_rekey(bridge_denormalize(bridge, owners, tags), t_owners, t_tags, key=key)
        one = bridge_transfer(bridge, owners, tags, t_owners, t_tags, key=key)
        assert one.columns == two.columns
        assert rows(one) == rows(two)
