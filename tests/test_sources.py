import json
import os

from pyspark.sql import functions as F

from shiftkit.plans.catalog import export_catalog, import_catalog, load_order_sheet
from shiftkit.sources.config import (
    config_exports, config_imports, config_sources, read_job_configs, read_pages,
)
from shiftkit.sources.files import latest_file, list_files, read_object_csv
from tests.conftest import rows

CFG_OBJECT = {
    "general": {"java_exe": "java", "vault_loader": "loader.jar"},
    "export_settings": {"dns": "https://src.example.com", "username": "u"},
    "import_settings": {"dns": "tgt.example.com", "username": "u", "time_out": 1800,
                        "import_path": "/in"},
    "exports": [
        {"name": "10_unit", "params": "-export qms_unit__c -csv 10_unit.csv",
         "where": "state__v = 'active__v'", "columns": ["id", "name__v"], "ignore_column": ["id"],
         "status": "ok"},
        {"name": "tmpl", "params": "-export  -csv ", "where": "", "columns": [], "ignore_column": [],
         "active": 0, "status": ""},
    ],
    "imports": [
        {"name": "a", "params": "-create kw__c -recordmigrationmode -csv a.csv", "active": 1, "status": "s"},
        {"name": "b", "params": "-update org__v -csv b.csv -idParam id", "active": 0},
    ],
}
CFG_ARRAY = {
    "export_settings": [{"dns": "https://a.example.com", "username": "x"},
                        {"dns": "https://b.example.com", "username": "y"}],
    "exports": [{"name": "only", "params": "-export x__c -csv only.csv", "columns": ["id"]}],
}


def test_job_configs(spark, tmp_dir):
    for name, cfg in (("one.json", CFG_OBJECT), ("two.json", CFG_ARRAY)):
        with open(os.path.join(tmp_dir, name), "w") as fh:
            json.dump(cfg, fh, indent=4)
    c = read_job_configs(spark, tmp_dir)
    src = rows(config_sources(c), "loader_config", "dns")
    assert src == [("one.json", "https://src.example.com"), ("two.json", "https://a.example.com"),
                   ("two.json", "https://b.example.com")]
    ex = export_catalog(config_exports(c))
    got = {r["name"]: (r["active"], r["object"], r["columns"]) for r in ex.collect()}
    assert got == {"10_unit": (1, "qms_unit__c", "id,name__v"), "tmpl": (0, "", ""),
                   "only": (1, "x__c", "id")}
    im = import_catalog(config_imports(c))
    assert rows(im, "name", "active", "file_path") == [("a", 1, "a.csv"), ("b", 0, "b.csv")]
    lo = load_order_sheet(config_imports(c)).collect()
    assert [(r["LoadOrderNr"], r["LoaderFileName"], r["ObjectType"]) for r in lo] == \
        [(1, "a.csv", "kw__c"), (2, "b.csv", "org__v")]


def test_pages(spark, tmp_dir):
    pages = [{"responseDetails": {"total": 5}, "data": [{"id": i, "user": {"name": f"n{i}"}}
                                                        for i in range(s, min(s + 2, 5))]}
             for s in (0, 2, 4)]
    for i, p in enumerate(pages):
        with open(os.path.join(tmp_dir, f"page_{i}.json"), "w") as fh:
            json.dump(p, fh, indent=2)
    data, comp = read_pages(spark, tmp_dir)
    assert sorted(data.columns) == ["id", "user.name"]
    assert data.count() == 5
    c = comp.first()
    assert (c["received"], c["total"], c["pages"], c["complete"]) == (5, 5, 3, True)


def test_object_csv_roundtrip(spark, tmp_dir):
    from shiftkit.operators.sinks import write_csv
    df = spark.createDataFrame(
        [("007", "A, Inc", ' "quoted" '), ("NA", "multi\nline", "Müller"), ("3", None, "")],
        "id string, name__v string, note string")
    write_csv(df, f"{tmp_dir}/out")
    back = read_object_csv(spark, f"{tmp_dir}/out")
    # An empty field reads as null, quoted or not (as pandas reads it).
    assert rows(back) == sorted([("007", "A, Inc", ' "quoted" '), ("NA", "multi\nline", "Müller"),
                                 ("3", None, None)], key=repr)
    assert dict(back.dtypes) == {"id": "string", "name__v": "string", "note": "string"}
    pandas_na = read_object_csv(spark, f"{tmp_dir}/out", na="pandas")
    assert (None, "multi\nline", "Müller") in rows(pandas_na)


def test_listing_and_latest(spark, tmp_dir):
    for i, name in enumerate(["x_1.csv", "x_2.csv", "y.txt"]):
        p = os.path.join(tmp_dir, name)
        with open(p, "w") as fh:
            fh.write("a\n")
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    listing = list_files(spark, tmp_dir, "*.csv")
    assert listing.count() == 2
    assert latest_file(listing).first()["path"].endswith("x_2.csv")


def test_run_exports(spark, tmp_dir):
    from shiftkit.plans.runs import run_exports
    cfg = {
        "export_settings": [{"dns": "https://a.example.com"}, {"dns": "https://b.example.com/v"}],
        "exports": [
            {"name": "10_unit", "params": "-export unit__c -csv 10_unit.csv", "where": "state = 'on'",
             "columns": ["id", "name", "state"], "ignore_column": ["id"]},
            {"name": "20_off", "params": "-export unit__c -csv 20.csv", "active": 0},
            {"name": "30_bad", "params": "-export unit__c -csv 30.csv", "where": "no_such_col = 1"},
        ],
    }
    os.makedirs(f"{tmp_dir}/cfg")
    with open(f"{tmp_dir}/cfg/job.json", "w") as fh:
        json.dump(cfg, fh)
    units = spark.createDataFrame([("1", "A", "on"), ("2", "B", "off"), ("3", "C", "on")],
                                  "id string, name string, state string")
    log = run_exports(spark, read_job_configs(spark, f"{tmp_dir}/cfg"), lambda obj: units,
                      f"{tmp_dir}/out", "2024-05-01 10:00:00", log_path=f"{tmp_dir}/log")
    got = sorted((r["job"], r["status"], r["row_count"]) for r in log.collect())
    assert got == [("10_unit", "SUCCESS", 2), ("10_unit", "SUCCESS", 2), ("20_off", "SKIPPED", None),
                   ("30_bad", "FAILED", None), ("30_bad", "FAILED", None)]
    back = read_object_csv(spark, f"{tmp_dir}/out/source_key=a.example.com/job.json/10_unit")
    assert back.columns == ["ignore.id", "name", "state"] and back.count() == 2
    assert spark.read.parquet(f"{tmp_dir}/log").count() == 5


def test_run_imports_and_analysis(spark, tmp_dir):
    from shiftkit.plans.failures import analyse_folder
    from shiftkit.plans.runs import run_imports
    from shiftkit.operators.sinks import write_csv
    cfg = {"import_settings": {"import_path": f"{tmp_dir}/in"},
           "imports": [
               {"name": "a_upd", "params": "-update org__v -recordmigrationmode -csv a_upd.csv -idParam id"},
               {"name": "b_off", "params": "-create org__v -csv b.csv", "active": 0},
               {"name": "c_bad", "params": "-import org__v -csv c.csv"}]}
    os.makedirs(f"{tmp_dir}/cfg")
    with open(f"{tmp_dir}/cfg/job.json", "w") as fh:
        json.dump(cfg, fh)
    orgs = spark.createDataFrame([("1", "A", "s"), ("2", "B", "s")], "id string, name__v string, state__v string")
    changes = spark.createDataFrame([("1", "ZZ_A", "archived"), ("9", "ZZ_X", "archived")],
                                    "id string, name__v string, state__v string")
    write_csv(changes, f"{tmp_dir}/in/a_upd.csv")
    log = run_imports(spark, read_job_configs(spark, f"{tmp_dir}/cfg"),
                      lambda base, f: read_object_csv(spark, f"{base}/{f}"), lambda obj: orgs,
                      f"{tmp_dir}/out", "2024-05-01 10:00:00")
    got = {r["job"]: (r["status"], r["reasons"]) for r in log.collect()}
    assert got["a_upd"] == ("FAILED", ["1 rows failed"])
    assert got["b_off"][0] == "SKIPPED" and got["c_bad"][0] == "FAILED"
    new = {r["id"]: r["name__v"] for r in spark.read.parquet(f"{tmp_dir}/out/tables/org__v/a_upd").collect()}
    assert new == {"1": "ZZ_A", "2": "B"}
    totals, counts, missing = analyse_folder(spark, f"{tmp_dir}/out/outcomes")
    assert [tuple(r) for r in totals.collect()] == [("a_upd", 2, 1, "paired")]
    assert [tuple(r) for r in counts.collect()] == [("a_upd", "record not found", 1)]
    assert missing.count() == 0


def test_imports_follow_each_other_by_their_own_key(spark, tmp_dir):
    from shiftkit.operators.sinks import write_csv
    from shiftkit.plans.runs import run_imports
    cfg = {"import_settings": {"import_path": f"{tmp_dir}/in"},
           "imports": [{"name": "one", "params": "-upsert org__v -csv one.csv -idParam code__v"},
                       {"name": "two", "params": "-update org__v -csv two.csv -idParam code__v"},
                       {"name": "three", "params": "-update org__v -csv three.csv"}]}
    os.makedirs(f"{tmp_dir}/cfg")
    with open(f"{tmp_dir}/cfg/job.json", "w") as fh:
        json.dump(cfg, fh)
    orgs = spark.createDataFrame([("1", "k1", "A")], "id string, code__v string, name__v string")
    fields = "code__v string, name__v string"
    write_csv(spark.createDataFrame([("k1", "A1"), ("k2", "B1")], fields), f"{tmp_dir}/in/one.csv")
    write_csv(spark.createDataFrame([("k2", "B2")], fields), f"{tmp_dir}/in/two.csv")
    listing = spark.createDataFrame([(f"{tmp_dir}/in/{n}.csv",) for n in ("one", "two")], "path string")
    log = run_imports(spark, read_job_configs(spark, f"{tmp_dir}/cfg"), lambda base, f: read_object_csv(spark, f"{base}/{f}"),
                      lambda obj: orgs, f"{tmp_dir}/out", "2024-05-01 10:00:00", listing=listing)
    got = {r["job"]: (r["status"], r["reasons"]) for r in log.collect()}
    assert got == {"one": ("SUCCESS", []), "two": ("SUCCESS", []), "three": ("FAILED", ["input file three.csv is missing"])}
    left = spark.read.parquet(f"{tmp_dir}/out/tables/org__v/two").collect()
    assert sorted((r["code__v"], r["name__v"], r["id"]) for r in left) == [("k1", "A1", "1"), ("k2", "B2", None)]
