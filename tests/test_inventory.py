import os

from pyspark.sql import functions as F

from shiftkit.operators.aggregate import headers_by_type_intent
from shiftkit.plans.inventory import by_type_wide, header_inventory, load_mapping
from shiftkit.sources.files import read_header


def write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def test_read_header_variants(tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    write(p, "﻿id,Name,name,id,\n1,2,3,4,5\n".encode("utf-8"))
    assert read_header(p)[0] == ["id", "Name", "name", "id.1", "Unnamed: 4"]
    write(p, "na\xefve,b\n".encode("latin-1"))
    h, enc, err = read_header(p)
    assert h == ["naïve", "b"] and enc == "latin-1"
    write(p, b'"multi\nline",b\n1,2\n')
    assert read_header(p)[0] == ["multi\nline", "b"]
    write(p, b"")
    assert read_header(p)[2] is not None


def test_header_inventory(spark, tmp_dir):
    root = os.path.join(tmp_dir, "data")
    write(f"{root}/10_unit_add_1.csv", b"id,name__v, state__v ,ignore.id\n1,a,b,c\n")
    write(f"{root}/sub/10_unit_upd_2.csv", b"id,Name__v,ignore_x\n")
    write(f"{root}/sub/20_kw_ups_1.csv", b"id,kw,Verketten\n")
    write(f"{root}/sub/deep/30_x.csv", "﻿Id,zeta,Alpha\n".encode("utf-8"))
    write(f"{root}/40_empty.csv", b"")
    write(f"{root}/50_drop.csv", b"a,b\n")
    write(f"{root}/60_blank.csv", b"c\n")
    mapping = spark.createDataFrame(
        [(" . ", "10_unit_add_1.csv", "Unit"), ("sub", "10_unit_upd_2.csv", "unit"),
         ("sub", "10_unit_upd_2.csv", "ignored second"), ("sub", "20_kw_ups_1.csv", "Keyword"),
         ("sub/deep", "30_x.csv", "X"), (".", "50_drop.csv", "DROP_ROW"), (".", "60_blank.csv", " ")],
        "relative_path string, filename string, object_type string")
    out = header_inventory(spark, root, mapping.withColumn("ord", F.monotonically_increasing_id()),
                           ordinal="ord")
    by_type = {(r["object_type"], r["file_intent"]): list(r["headers"]) for r in out["by_type"].collect()}
    assert by_type == {("Unit", "addition"): ["id", "name__v", "state__v"],
                       ("unit", "update"): ["id", "Name__v"],
                       ("X", "addition"): ["Alpha", "Id", "zeta"]}
    failed = [r["path"] for r in out["failed"].collect()]
    assert len(failed) == 1 and failed[0].endswith("40_empty.csv")
    joined = {r["filename"]: r["object_type"] for r in out["joined"].collect()}
    assert joined["10_unit_upd_2.csv"] == "unit"
    wide = by_type_wide(out["by_type"]).collect()
    assert [r["object_type"] for r in wide] == ["Unit", "unit", "X"] or \
        [r["object_type"] for r in wide] == ["unit", "Unit", "X"]
    assert "HEAD3" in wide[0].asDict()


def test_group_left_empty_is_kept(spark):
    long = spark.createDataFrame([("T", "addition", "ignore.a"), ("T", "addition", " ")],
                                 "object_type string, file_intent string, header string")
    got = headers_by_type_intent(long).collect()
    assert [(r["object_type"], list(r["headers"])) for r in got] == [("T", [])]


def test_mapping_requires_columns(spark):
    import pytest
    with pytest.raises(ValueError, match="has no column"):
        load_mapping(spark.createDataFrame([("a", "b")], "relative_path string, filename string"))


def test_inventory_to_config_check(spark, tmp_dir):
    import json
    from shiftkit.plans.sync import check_export_config
    from shiftkit.sources.config import read_job_configs
    root = os.path.join(tmp_dir, "data")
    write(f"{root}/10_unit_add_1.csv", b"id,name__v,state__v\n")
    write(f"{root}/20_kw_add_1.csv", b"id,kw\n")
    mapping = spark.createDataFrame([(".", "10_unit_add_1.csv", "qms_unit__c"),
                                     (".", "20_kw_add_1.csv", "keyword__c")],
                                    "relative_path string, filename string, object_type string")
    inv = header_inventory(spark, root, mapping)
    os.makedirs(f"{tmp_dir}/cfg")
    with open(f"{tmp_dir}/cfg/job.json", "w") as fh:
        json.dump({"exports": [{"name": "10", "params": "-export qms_unit__c -csv 10.csv",
                                "columns": ["id", "name__v", "extra__c"]}]}, fh)
    res = check_export_config(inv["by_type"], read_job_configs(spark, f"{tmp_dir}/cfg"),
                              out_dir=f"{tmp_dir}/report")
    assert [tuple(r) for r in res["unmatched"].collect()] == [(2, "keyword__c", "addition")]
    s = res["sync"].first()
    assert (list(s["added_to_config"]), list(s["added_to_row"])) == (["state__v"], ["extra__c"])
    assert [list(r["added"]) for r in res["config_additions"].collect()] == [["state__v"]]
    assert os.path.isdir(f"{tmp_dir}/report/sync")


def test_wide_heads_numeric_order(spark):
    from shiftkit.functions.names import head_columns
    from shiftkit.operators.aggregate import wide_heads
    df = spark.createDataFrame([("T", [f"h{i:02d}" for i in range(12)]), ("U", ["x"])],
                               "object_type string, headers array<string>")
    wide = wide_heads(df)
    assert head_columns(wide.columns) == [f"HEAD{i}" for i in range(1, 13)]
    assert head_columns(["HEAD10", "HEAD2", "HEAD1", "other", "HEADx"]) == ["HEAD1", "HEAD2", "HEAD10"]
    row = {r["object_type"]: r for r in wide.collect()}
    assert row["T"]["HEAD10"] == "h09" and row["U"]["HEAD2"] is None
